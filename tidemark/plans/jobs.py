"""Whole runs that read, compute and write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.archive import split_documents, split_inactive
from tidemark.sources.writers import write_archive_report


def archive_inactive(
    docs: DataFrame, as_of, date, archive_path: str, report_folder: str, by_user: bool = True,
    registered_days: int = 30, idle_days: int = 14,
) -> tuple[DataFrame, DataFrame]:
    """Archive the documents of one run and report it; returns (archived, remaining).

    A run owns the folder of its date, so running it again replaces its
    result instead of adding copies. The report is made from the written archive; by user it
    counts users and lists each once.
    """
    archived, remaining = (split_inactive if by_user else split_documents)(docs, as_of, registered_days, idle_days)
    run = f"{archive_path}/archive_date={date}"
    archived.drop("_id").write.mode("overwrite").parquet(run)
    written = docs.sparkSession.read.schema(docs.drop("_id").schema).parquet(run)
    reported = written.select("user_id").distinct() if by_user else written
    write_archive_report(reported, date, report_folder)
    return written, remaining
