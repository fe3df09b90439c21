"""Lists a store by tasks: each round lists the folders that the round before found."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workspace import fresh_folder, written

FIELDS = "path string, length long, modificationTime timestamp, folder boolean"
#: Rows sent from a task to Spark at once.
ROWS = 10_000


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named as Spark names it, and the folder's name there."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        name = rest if colon else path
        return fs.LocalFileSystem(), "/" + name.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + rest)


def children(path: str, opened: Callable[[str], tuple[fs.FileSystem, str]]) -> Iterator[tuple]:
    """(path, length, modificationTime, whether a folder) of what a folder holds; nothing if it is gone."""
    store, name = opened(path)
    for found in store.get_file_info(fs.FileSelector(name, recursive=False, allow_not_found=True)):
        folder = found.type == fs.FileType.Directory
        yield f"{path.rstrip('/')}/{found.base_name}", None if folder else found.size, found.mtime, folder


def list_objects(
    spark: SparkSession, path: str, glob: str | None = None,
    opened: Callable[[str], tuple[fs.FileSystem, str]] = open_folder,
) -> DataFrame:
    """path, length and modificationTime of every object below ``path``, whatever its name; ``glob`` keeps those whose
    last name fits. Contents are not read.

    Folders are a table, dealt to tasks that list them with the store's own client; a round for each
    level. The driver learns only whether a level has folders, so the number of objects and folders is not bounded by its
    memory; the children of one folder are listed by one task. A missing folder has no rows. ``opened`` gives client and name
    for a path, where the environment of the executors does not say how to reach the store.
    """
    work = fresh_folder(spark, "listing")
    schema = pa.schema([("path", pa.string()), ("length", pa.int64()),
                        ("modificationTime", pa.timestamp("us", tz="UTC")), ("folder", pa.bool_())])

    def listed(batches):
        rows: list[tuple] = []
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for child in children(name, opened):
                    if child[3] or glob is None or fnmatchcase(child[0].rsplit("/", 1)[1], glob):
                        rows.append(child)
                    if len(rows) == ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders, level = spark.createDataFrame([(path,)], "path string"), 0
    while True:
        found = written(folders.repartition(tasks, "path").mapInArrow(listed, FIELDS), f"{work}/level={level}")
        folders, level = found.where("folder").select("path"), level + 1
        if folders.isEmpty():
            break
    every = spark.read.schema(FIELDS).option("basePath", work).parquet(work)
    return every.where(~F.col("folder")).select("path", "length", "modificationTime")
