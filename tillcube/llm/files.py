"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import sys

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..session import new_table_path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder (a URI) in the folder that all executors share."""
    path = new_table_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of ours that every later step has been written without."""
    for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        jvm = tables[0].sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(tables[0].sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: the lineage ends there."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str):
    """(filesystem, path) of a folder URI, on any task."""
    uri = uri if "://" in uri else uri.replace("file:", "file://", 1)
    return fs.FileSystem.from_uri(uri)


def once(key, make):
    """An object that the tasks of one worker process share (task functions
    travel by value, so a module variable would not outlive a task)."""
    held = vars(sys).setdefault("_tillcube_llm", {})
    if key not in held:
        held.clear()                     # one model at a time
        held[key] = make()
    return held[key]


def publish(store, path: str, temporary: str) -> None:
    """A finished file appears under its name at once; another attempt of the
    same task writes the same bytes and may replace it."""
    store.move(temporary, path)
