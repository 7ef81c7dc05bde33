"""Tables that grow by batches: retry-safe appends that readers see whole.

A batch is written to a folder of its own and becomes visible by a commit: a
new version of a small manifest (the batches' folders and whatever else the
table keeps in step with them).  Readers follow the newest version, so a
half-written batch is never read; a batch id that is committed already is
skipped, so a retried job adds nothing twice.  A version file is created only
if it does not exist; whoever comes second starts again from the new state.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LOST = 25               # looks, 0.2 s apart, at a version that is open
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class Manifest:
    """Versioned small JSON state in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.path = self._hadoop.Path(path)
        self._fs = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def read(self) -> tuple[int, dict]:
        """(version, state) of the newest whole version; (0, {}) before the first."""
        names = [f.getPath().getName() for f in self._fs.listStatus(self.path)] if self._fs.exists(self.path) else []
        for name in sorted((n for n in names if n.isdigit()), reverse=True):
            file = self._fs.open(self._hadoop.Path(self.path, name))
            try:
                return int(name), json.loads(file.readUTF())
            except Exception:           # its writer has not closed it yet, or was lost
                continue
            finally:
                file.close()
        return 0, {}

    def commit(self, version: int, state: dict) -> bool:
        """Create ``version``; False if another writer has it."""
        name = self._hadoop.Path(self.path, f"{version:09d}")
        if self._fs.exists(name):
            return False
        try:
            file = self._fs.create(name, False)
        except Exception:               # created since
            return False
        file.writeUTF(json.dumps(state))
        file.close()
        return True

    def update(self, change: Callable[[dict], dict | None]) -> dict:
        """Commit ``change`` of the newest state, again if another writer came
        first; None as the changed state means that nothing is to be done."""
        while True:
            version, state = self.read()
            new = change(state)
            if new is None:
                return state
            ahead, waited = 1, 0
            while not self.commit(version + ahead, new):
                if self.read()[0] > version:        # another writer came first
                    break
                time.sleep(0.2)                     # it is open; if it does not close, its writer was lost
                waited += 1
                if waited % LOST == 0:
                    ahead += 1
            else:
                return new


class BatchTable:
    """A table of batches (S4).  ``schema`` lets it be read before the first one."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.fmt = spark, path, schema, fmt
        self.manifest = Manifest(spark, f"{path}/versions")

    def write_folder(self, df: DataFrame, batch_id: str) -> str:
        """The rows in a new folder of this attempt, not visible yet."""
        if not _ID.fullmatch(batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits, '.', '_' and '-' only")
        folder = f"{self.path}/batches/{batch_id}-{uuid.uuid4().hex[:12]}"
        writer = df.write.format(self.fmt)
        (writer.option("compression", "gzip") if self.fmt == "json" else writer).save(folder)      # Parquet is compressed by itself
        return folder

    def batches(self) -> dict[str, str]:
        """Folder of every committed batch, in commit order."""
        return self.manifest.read()[1].get("batches", {})

    def append(self, df: DataFrame, batch_id: str) -> bool:
        """Add the rows as one batch; False (and nothing written) if the id is known."""
        if batch_id in self.batches():
            return False
        folder = self.write_folder(df, batch_id)
        state = self.manifest.update(lambda s: None if batch_id in s.get("batches", {}) else s | {"batches": {**s.get("batches", {}), batch_id: folder}})
        return state["batches"][batch_id] == folder

    def read(self) -> DataFrame:
        """The rows of all committed batches."""
        folders = list(self.batches().values())
        if not folders:
            if self.schema is None:
                raise ValueError(f"{self.path}: no batch and no schema")
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.format(self.fmt)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(folders)
