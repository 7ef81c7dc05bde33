"""The driver contract holds without the optional training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(blocked: str) -> list[str]:
    """Registered queries in a fresh interpreter where ``blocked`` cannot be imported."""
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as E; print(*E.queries(), sep='\\n')"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


def test_core_queries_survive_a_missing_library():
    from tillcube import registry
    for blocked in ("zstandard", "tillcube.llm"):
        assert names(blocked) == list(registry.QUERIES)
