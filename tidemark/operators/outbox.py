"""Rows waiting to be published and their messages; sent ids as ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import epoch_seconds

#: Ids that share a bucket; a range lies in one, so no task meets more ids than these.
BUCKET_BITS = 16


def bucket(name: str = "id"):
    return F.shiftright(F.col(name), BUCKET_BITS).alias("bucket")


def as_ranges(ids: DataFrame) -> DataFrame:
    """``bucket``, ``first``, ``last`` of the ranges that ids (column id) make, each within a bucket of ids."""
    return merged_ranges(ids.where("id IS NOT NULL").select(bucket(), F.col("id").alias("first"), F.col("id").alias("last")))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Fewest ranges for the same ids: those that overlap or touch become one."""
    before = Window.partitionBy("bucket").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("bucket").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    # An island starts behind a gap: more than one after all that came before.
    starts = ranges.distinct().withColumn("reach", F.max("last").over(before)).withColumn(
        "starts", (F.col("reach").isNull() | (F.col("first") > F.col("reach") + 1)).cast("int"))
    islands = starts.withColumn("island", F.sum("starts").over(upto))
    return islands.groupBy("bucket", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def ids_of(ranges: DataFrame) -> DataFrame:
    """The ids of ranges."""
    return ranges.select(F.explode(F.sequence("first", "last")).alias("id"))


def unsent(rows: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Rows flagged false, minus the ids of the ledger (ranges, or a column id); a null flag is not false, a null id not sent.

    Ids and ranges of a bucket are walked together in order, so each id is compared once, however many ranges there are.
    """
    waiting = rows.where(~F.col("sent_to_kafka"))
    if ledger is None:
        return waiting
    if "first" not in ledger.columns:
        ledger = as_ranges(ledger)
    both = waiting.select(bucket(), F.col("id").alias("at"), F.lit(1).alias("turn"), F.lit(None).cast("long").alias("last"),
                          F.struct("*").alias("row"))
    both = both.unionByName(
        ledger.select("bucket", F.col("first").alias("at"), F.lit(0).alias("turn"), "last"), allowMissingColumns=True)
    walked = both.withColumn("reach", F.max("last").over(Window.partitionBy("bucket").orderBy("at", "turn")))
    left = F.col("reach").isNull() | (F.col("at") > F.col("reach")) | F.col("at").isNull()
    return walked.where((F.col("turn") == 1) & left).select("row.*")


def to_messages(rows: DataFrame) -> DataFrame:
    """id and the JSON text ``{"user", "event", "timestamp"}``; null values keep their key."""
    body = F.struct(
        F.col("username").alias("user"),
        F.col("event_type").alias("event"),
        epoch_seconds(F.col("event_time")).alias("timestamp"),
    )
    return rows.select("id", F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))
