"""Inactive users and their documents: archive set, remainder, run report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import days_before, moment
from tidemark.operators.joins import HOT_ROWS, ROWS, lookup_join

REGISTERED = "user_info.registration_date"


def past_both(registered: Column, active: Column, as_of, registered_days: int, idle_days: int) -> Column:
    """Both moments at or before their limits. A missing one is not past."""
    now = moment(as_of)
    return (registered <= days_before(now, registered_days)) & (active <= days_before(now, idle_days))


def split_documents(docs: DataFrame, as_of, registered_days: int = 30, idle_days: int = 14):
    """(archived, remaining) by document: each document is judged on its own."""
    past = past_both(F.col(REGISTERED), F.col("event_time"), as_of, registered_days, idle_days)
    return docs.where(past), docs.where(~F.coalesce(past, F.lit(False)))


def users(docs: DataFrame, as_of, registered_days: int = 30, idle_days: int = 14) -> DataFrame:
    """One row per user: registration, last activity, number of documents, ``inactive`` or not."""
    past = past_both(F.col("registration_date"), F.col("last_event_time"), as_of, registered_days, idle_days)
    return (
        docs.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min(REGISTERED).alias("registration_date"),
            F.max("event_time").alias("last_event_time"),
            F.count(F.lit(1)).alias("documents"),
        )
        .withColumn("inactive", F.coalesce(past, F.lit(False)))
    )


def inactive_users(docs: DataFrame, as_of, registered_days: int = 30, idle_days: int = 14) -> DataFrame:
    """Users registered long ago whose latest activity is past, one row each."""
    return users(docs, as_of, registered_days, idle_days).where("inactive").drop("inactive")


def split_inactive(
    docs: DataFrame, as_of, registered_days: int = 30, idle_days: int = 14, hot_rows: int = HOT_ROWS
):
    """(archived, active) by user: all documents of a user go the same way.

    Documents without a user stay active.
    """
    judged = users(docs, as_of, registered_days, idle_days).select(
        "user_id", F.col("documents").alias(ROWS), F.col("inactive").alias("_inactive")
    )
    flagged = lookup_join(docs, judged, ["user_id"], hot_rows)
    archived, active = flagged.where("_inactive"), flagged.where(~F.col("_inactive"))
    return (
        archived.select(docs.columns),
        active.select(docs.columns).unionByName(docs.where(F.col("user_id").isNull())),
    )


def archive_report(archived: DataFrame, date) -> DataFrame:
    """Date and number of archived rows; one row also when nothing was archived."""
    return archived.agg(F.count(F.lit(1)).alias("archived_users_count")).select(
        F.lit(str(date)).alias("date"), "archived_users_count"
    )


def archived_ids(archived: DataFrame) -> DataFrame:
    """The ids as a dataset of their own; by document an id may repeat."""
    return archived.select("user_id")
