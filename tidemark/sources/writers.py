"""Sinks: event tables by day, dated CSV exports, archives, reports, messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.archive import archive_report, archived_ids
from tidemark.operators.audit import audit_day
from tidemark.operators.events import by_day


# Fixed formats: without them text files keep only milliseconds.
EXACT_TIMES = {
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX",
}


def laid_out(df: DataFrame, order: list[str], by: str = "event_date") -> DataFrame:
    """Rows of a day kept together and sorted, a large day spread over many files.

    ``rebalance`` lets the adaptive planner split an oversized day and merge
    small ones, so no task writes a whole hot day.
    """
    return df.hint("rebalance", by).sortWithinPartitions(by, *order)


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    laid_out(by_day(events), ["event_time", "user_id"]).write.mode(mode).partitionBy("event_date").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 with a header; a quote inside a value is doubled, outer spaces are kept."""
    options = {
        "header": "true",
        "escape": '"',
        **EXACT_TIMES,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    df.write.mode(mode).options(**options).csv(path)


def write_records(records: DataFrame, path: str) -> None:
    write_csv(records.select("quote_text", "author", "tags"), path)


def write_version(users: DataFrame, name: str, path: str, buckets: int, key: str = "id") -> None:
    """A version of a keyed table, bucketed by its key.

    Each version is compared twice, with the one before and the one after;
    versions with the same number of buckets join without a shuffle.
    """
    (
        users.repartition(buckets, key)
        .write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    )


def append_audit(log: DataFrame, path: str) -> None:
    """Append changes to the audit log, stored by the day of the change."""
    dated = log.withColumn("changed_date", F.to_date("changed_at"))
    laid_out(dated, ["changed_at"], "changed_date").write.mode("append").partitionBy("changed_date").parquet(path)


def export_audit(log: DataFrame, date, folder: str, single_file: bool = False) -> str:
    """Changes of one day, in order, under a dated name; returns the path.

    Part files are in order. The sort goes on after the time so that many
    changes of the same moment still spread over tasks. ``single_file`` is for
    a day known to be small.
    """
    path = f"{folder}/users_audit_export_{date}"
    ordered = audit_day(log, date).orderBy("changed_at", "user_id", "field_changed")
    write_csv(ordered.coalesce(1) if single_file else ordered, path)
    return path


def write_documents(docs: DataFrame, path: str, mode: str = "append") -> None:
    """Nested documents as JSON lines; null fields are left out."""
    docs.write.mode(mode).options(**EXACT_TIMES).json(path)


def archive(archived: DataFrame, path: str) -> None:
    """Append documents to the archive, without the key of the store they came from."""
    archived.drop("_id").write.mode("append").parquet(path)


def write_archive_report(archived: DataFrame, date, folder: str) -> None:
    """One JSON row with date and count, and the ids as their own dataset, per date."""
    archive_report(archived, date).write.mode("overwrite").json(f"{folder}/report/date={date}")
    archived_ids(archived).write.mode("overwrite").json(f"{folder}/ids/date={date}")


def write_messages(messages: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """Write the ``value`` column to a topic (option ``topic``) or to files (option ``path``)."""
    messages.select("value").write.format(fmt).mode("append").options(**options).save()


def create_table(
    spark: SparkSession, name: str, columns: str, partitioned_by: str | None = None, path: str | None = None
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for a Parquet table, at ``path`` if given."""
    layout = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}{place}")
