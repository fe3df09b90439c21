"""What the operators of this folder share: tables, splits and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that are worked on at once, and rows that Spark sends to Python at once.
BATCH_CHARS, BATCH_ROWS = 500_000, 1_000

ARROW = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32(),
         "boolean": pa.bool_(), "binary": pa.binary()}


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind])
    return ARROW[kind.simpleString()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(docs: DataFrame, *known: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` whose other columns than the known ones have names that no operator uses, and what takes such
    documents, with whatever columns were added to them, back to the columns and names of ``docs``."""
    names = docs.columns
    others = [c if c in known else f"column {i}\ufdd0" for i, c in enumerate(names)]
    return docs.toDF(*others), lambda df: df.select(*[F.col(f"`{c}`") for c in others]).toDF(*names)


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text, modulo ``parts``, is ``part``. A null key is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(True))


def share_of(key: str) -> Column:
    """A pseudorandom number in [0, 1) fixed by the key, independent of ``held_out``."""
    return (F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))).cast("double")


def with_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose session now sends texts to Python in batches of at most ``BATCH_ROWS`` rows.

    Texts are long and a batch is held several times on its way, by the JVM and by Python.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(docs.sparkSession.conf.get(name)) not in range(1, BATCH_ROWS + 1):
        docs.sparkSession.conf.set(name, BATCH_ROWS)
    return docs


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run in the block send at most so many rows to Python at once; the setting is put back after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces(batch: pa.RecordBatch, text: str, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``chars`` characters (or list items), or one longer text."""
    if not batch.num_rows:
        return
    column = batch.column(text)
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.utf8_length
    sizes = pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    yield batch.slice(start)


def add_columns(docs: DataFrame, text: str, fields: str, make: Callable[[], Callable], arrow=False) -> DataFrame:
    """``docs`` with columns computed from one text column, in Arrow batches.

    ``fields`` names the new columns as DDL; columns of ``docs`` with these names are
    replaced, all others pass unchanged. ``make`` runs once per task and returns the
    function from a list of texts (null as None), or with ``arrow`` the Arrow array of
    the column, to one list or Arrow array per new column.
    """
    new = T.StructType.fromDDL(fields)
    docs = with_small_batches(docs).drop(*new.names)
    types = [arrow_type(f.dataType) for f in new]

    def run(batches):
        work = make()
        for batch in batches:
            for piece in pieces(batch, text):
                given = piece.column(text)
                columns = work(given if arrow else given.to_pylist())
                made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *made], [*piece.schema.names, *new.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new.fields]))
