"""Daily event aggregates, kept as mergeable states, and retention periods.

Events have user_id, event_type, points_spent, event_time. States merge over any
split of the input. Distinct users are exact: a state row holds, for a bucket of 64 neighbouring
user ids, those seen as the bits of one number. Numbered ids share rows, 64 to a row; sparse ids, such as
random 64-bit ones, take a short row each. Every step is a hash aggregation of numbers that combines before it
shuffles, and a group with many users spreads over its buckets. The ``hll`` kind is one
sketch per group, always an estimate. One table of states holds one kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import day, days_before, moment

BITS, HLL = "bits", "hll"
HLL_SIZE = 14
FAN_IN = 64
MAX_SLICES = 1024
GROUP = ["event_date", "event_type"]
SUMS = ["total_points", "event_count"]


def by_day(events: DataFrame) -> DataFrame:
    """Add the calendar day of the event, unless the table is laid out by it."""
    if "event_date" in events.columns:
        return events
    return events.withColumn("event_date", F.to_date("event_time"))


def event_states(events: DataFrame, fan_in: int = FAN_IN, kind: str = BITS) -> DataFrame:
    """Partial state per (day, type) and bucket of users: users, points, number of events.

    A row has no user id: its bucket is null. Sketches are merged ``fan_in`` partitions at a time and then
    once more, so no single task merges the sketches of all partitions of a large day.
    """
    sums = [F.sum("points_spent").alias("total_points"), F.count(F.lit(1)).alias("event_count")]
    if kind == HLL:
        sliced = by_day(events).withColumns({
            "slice": F.floor(F.spark_partition_id() / fan_in) % MAX_SLICES, "user_bucket": F.lit(None).cast("long")})
        partial = sliced.groupBy(*GROUP, "user_bucket", "slice").agg(F.hll_sketch_agg("user_id", HLL_SIZE).alias("users"), *sums)
        return combine_states(partial, kind=kind)
    user = F.col("user_id").cast("long")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(user, F.lit(64)).cast("int"))
    bucketed = by_day(events).select(*GROUP, F.shiftright(user, 6).alias("user_bucket"), one.alias("user"), "points_spent")
    return bucketed.groupBy(*GROUP, "user_bucket").agg(F.bit_or("user").alias("users"), *sums)


def combine_states(states: DataFrame, keys: list[str] | None = None, kind: str = BITS) -> DataFrame:
    """Fewer state rows with the same meaning: one per key and bucket, still mergeable."""
    merge = F.bit_or if kind == BITS else F.hll_union_agg
    return states.groupBy(*(GROUP if keys is None else keys), "user_bucket").agg(
        merge("users").alias("users"), *[F.sum(c).alias(c) for c in SUMS]
    )


def merge_states(states: DataFrame, keys: list[str] | None = None, kind: str = BITS) -> DataFrame:
    """Finished numbers per (day, type), or per any subset of these keys."""
    keys = GROUP if keys is None else keys
    users = F.bit_count("users") if kind == BITS else F.hll_sketch_estimate("users")
    return combine_states(states, keys, kind).groupBy(*keys).agg(
        F.coalesce(F.sum(users), F.lit(0)).cast("long").alias("unique_users"),
        F.sum("total_points").alias("total_points"),
        F.sum("event_count").alias("total_actions"),
    )


def daily_report(states: DataFrame) -> DataFrame:
    return merge_states(states).orderBy(*GROUP)


def daily_exact(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The same numbers in one pass over raw events, with an exact distinct count."""
    return by_day(events).groupBy(*(GROUP if keys is None else keys)).agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("points_spent").alias("total_points"),
        F.count(F.lit(1)).alias("total_actions"),
    )


def live_events(events: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Raw events still inside their retention period at ``as_of``."""
    limit = days_before(moment(as_of), days)
    live = events.where(F.col("event_time") > limit)
    if "event_date" in events.columns:
        live = live.where(F.col("event_date") >= F.to_date(limit))
    return live


def live_aggregates(states: DataFrame, as_of, days: int = 180) -> DataFrame:
    return states.where(F.col("event_date") > F.date_sub(day(as_of), days))
