"""Shared working folder: lineage cuts and hand-over files between steps.

Everything written here must be readable by every executor, also by one that
replaces a lost one, so the folder comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local session without it
    gets one in its warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/tidemark-checkpoints")
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: The fresh folders of the block of ``passing_folders`` that runs, each thread having its own.
passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    if (block := passing.get()) is not None:
        block.append(path)
    return path


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Removes the fresh folders of the block when it ends; what is read from them must be written by then.

    Folders made by other threads meanwhile stay.
    """
    token = passing.set([])
    try:
        yield
    finally:
        for path in passing.get():
            Folder(spark, path).remove("")
        passing.reset(token)


def written(df: DataFrame, path: str, **options) -> DataFrame:
    """Write ``df`` to ``path`` in the shared folder, with options of the writer, and return the written table.

    Cuts the lineage like a reliable checkpoint but computes ``df`` only once,
    and later steps can prune columns and read row counts from the footers.
    """
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint; batch numbers count within it."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


#: The file that marks a finished write.
DONE = "_SUCCESS"
#: The name of the folder of rows without a value, as Spark writes it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Folder:
    """Directory listing and removal on whatever file system holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.path = path

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name) if name else self._root

    def has(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names of the direct children; empty if the folder is missing."""
        if not self.has(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
