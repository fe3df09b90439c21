"""Publish unsent outbox rows, at least once.

The ledger holds the ids sent as ranges, in folders ``v=V``: runs append their ranges to the newest finished one,
and ``merge_ledger`` joins the ranges of all runs in the next. One publisher works on a ledger at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.outbox import as_ranges, merged_ranges, to_messages, unsent
from tidemark.workspace import DONE, Folder, fresh_folder, written

RANGES = "bucket long, first long, last long"


def _newest(spark: SparkSession, path: str) -> int | None:
    folder = Folder(spark, path)
    done = [int(v.removeprefix("v=")) for v in folder.names() if folder.has(f"{v}/{DONE}")]
    return max(done, default=None)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """Ranges of ids already published, or None before the first run."""
    version = _newest(spark, path)
    return None if version is None else spark.read.schema(RANGES).parquet(f"{path}/v={version}")


def publish_outbox(rows: DataFrame, ledger: str, send: Callable[[DataFrame], None]) -> None:
    """Send the messages of all unsent rows, then record their ids.

    The run is first written to the shared folder, so the ids recorded are
    the ids sent even if the source changes meanwhile. If the run fails before
    the ids are recorded, the next one sends the rows again. Of the ledger only
    ranges among the ids that are still flagged unsent are read.
    """
    spark, folder = rows.sparkSession, fresh_folder(rows.sparkSession, "outbox")
    sent = read_ledger(spark, ledger)
    if sent is not None:
        least, most = unsent(rows).agg(F.min("id"), F.max("id")).first()
        sent = sent.where((F.col("last") >= least) & (F.col("first") <= most))
    run = written(to_messages(unsent(rows, sent)), folder)
    send(run)
    ranges = as_ranges(run).sortWithinPartitions("first")
    ranges.write.mode("append").parquet(f"{ledger}/v={_newest(spark, ledger) or 0}")
    Folder(spark, folder).remove("")


def merge_ledger(spark: SparkSession, path: str) -> None:
    """Join the ranges of all runs; what they replace is removed."""
    version, ranges = _newest(spark, path), read_ledger(spark, path)
    if ranges is None:
        return
    merged = merged_ranges(ranges).sortWithinPartitions("first")
    merged.write.mode("overwrite").parquet(f"{path}/v={version + 1}")
    for name in Folder(spark, path).names():
        if int(name.removeprefix("v=")) <= version:
            Folder(spark, path).remove(name)
