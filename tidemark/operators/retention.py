"""First event per user and seven-day cohort retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import day, percent
from tidemark.operators.events import by_day, live_events


def first_events(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.min("event_time").alias("event_time"))


BLOCK = 63  # days whose activity fits the bits of one long


def lowest_day(days: Column) -> Column:
    """Date of the lowest bit set in ``days``, the active days of ``block``."""
    below_lowest = days.bitwiseAND(-days) - 1
    return F.date_from_unix_date((F.col("block") * BLOCK + F.bit_count(below_lowest)).cast("int"))


def user_cohorts(events: DataFrame, days: int = 7) -> DataFrame:
    """One row per user: first day, and whether they came back within ``days`` days.

    Events shrink to one row per user and block of 63 days, the active days as
    bits, before anything is grouped by user. The second active day
    decides: if it is too late, all later ones are too.
    """
    number = F.unix_date("event_date")
    active = (
        by_day(events)
        .where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
        .select("user_id", F.floor(number / BLOCK).alias("block"), F.pmod(number, F.lit(BLOCK)).alias("place"))
        .groupBy("user_id", "block")
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("active"))
    )
    later = F.col("active").bitwiseAND(F.col("active") - 1)
    by_user = Window.partitionBy("user_id").orderBy("block")
    next_day = F.coalesce(
        F.when(later != 0, lowest_day(later)), F.lead(lowest_day(F.col("active"))).over(by_user)
    )
    return (
        active.withColumns({"nth": F.row_number().over(by_user), "next_day": next_day})
        .where(F.col("nth") == 1)
        .select(
            "user_id",
            lowest_day(F.col("active")).alias("day_0"),
            F.coalesce(F.col("next_day") <= F.date_add(lowest_day(F.col("active")), days), F.lit(False))
            .alias("returned"),
        )
    )


def counts():
    return [
        F.count(F.lit(1)).alias("total_users_day_0"),
        F.count_if("returned").alias("returned_in_7_days"),
    ]


def rate():
    return percent(F.col("returned_in_7_days"), F.col("total_users_day_0")).alias("retention_7d_percent")


def retention_7d(events: DataFrame, as_of=None, complete_at=None) -> DataFrame:
    """Users, returned users and percent per cohort day.

    ``as_of`` first removes events past raw retention. ``complete_at`` adds a
    flag telling whether the seven days of a cohort had passed by that date.
    """
    kept = events if as_of is None else live_events(events, as_of)
    cohorts = user_cohorts(kept).groupBy("day_0").agg(*counts()).select("*", rate())
    if complete_at is not None:
        cohorts = cohorts.withColumn("complete", F.date_add("day_0", 7) < day(complete_at))
    return cohorts.orderBy("day_0")


def retention_7d_total(events: DataFrame, as_of=None) -> DataFrame:
    """All cohorts in one row; no row for no users."""
    kept = events if as_of is None else live_events(events, as_of)
    total = user_cohorts(kept).agg(*counts()).where(F.col("total_users_day_0") > 0)
    return total.select("*", rate())
