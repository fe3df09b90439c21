"""Archiving by document and by user, and the run report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import archive as ar
from tidemark.plans.inputs import USER_DOCS_SQL, user_documents
from tidemark.plans.jobs import archive_inactive
from tidemark.plans.registry import query
from tidemark.sources import writers
from tidemark.sources.readers import read_documents
from tidemark.workspace import fresh_folder

AS_OF = "2024-02-12 00:00:00"
RUN_DATE = "2024-02-12"
WITH_DOCS = f"WITH user_docs AS ({USER_DOCS_SQL})"
PAST = f"""registration_date <= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY
    AND event_time <= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY"""
IDLE = f"""SELECT user_id, min(registration_date) AS registration_date, max(event_time) AS last_event_time,
    count(*) AS documents FROM user_docs GROUP BY user_id
    HAVING min(registration_date) <= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY
       AND max(event_time) <= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY"""
PURCHASE_DOCS = f"WITH user_docs AS (SELECT * FROM ({USER_DOCS_SQL}) WHERE event_type = 'purchase')"


def flat(docs):
    return docs.select("*", "user_info.registration_date").drop("user_info")


def purchases(spark, sf_dir):
    return user_documents(spark, sf_dir).where("event_type = 'purchase'")


@query("archive_documents", f"{WITH_DOCS} SELECT * FROM user_docs WHERE {PAST}")
def archive_documents(spark, sf_dir):
    return flat(ar.split_documents(user_documents(spark, sf_dir), AS_OF)[0])


@query("remaining_documents", f"{WITH_DOCS} SELECT * FROM user_docs WHERE NOT ({PAST})")
def remaining_documents(spark, sf_dir):
    return flat(ar.split_documents(user_documents(spark, sf_dir), AS_OF)[1])


@query("archive_users", f"{WITH_DOCS} {IDLE}")
def archive_users(spark, sf_dir):
    return ar.inactive_users(user_documents(spark, sf_dir), AS_OF)


@query("archive_users_purchases", f"{PURCHASE_DOCS} {IDLE}")
def archive_users_purchases(spark, sf_dir):
    return ar.inactive_users(purchases(spark, sf_dir), AS_OF)


# Over all events few users are idle for long, so the limits are short.
SHORT = {"registered_days": 10, "idle_days": 1}
SHORT_AS_OF = "2024-01-31 00:00:00"
SHORT_IDLE = f"""SELECT user_id FROM user_docs GROUP BY user_id
    HAVING min(registration_date) <= TIMESTAMP '{SHORT_AS_OF}' - INTERVAL 10 DAY
       AND max(event_time) <= TIMESTAMP '{SHORT_AS_OF}' - INTERVAL 1 DAY"""
WITH_SHORT = f"{WITH_DOCS}, idle AS ({SHORT_IDLE})"


@query("archived_user_documents", f"{WITH_SHORT} SELECT * FROM user_docs WHERE user_id IN (SELECT user_id FROM idle)")
def archived_user_documents(spark, sf_dir):
    return flat(ar.split_inactive(user_documents(spark, sf_dir), SHORT_AS_OF, **SHORT)[0])


@query("active_users", f"{WITH_SHORT} SELECT * FROM user_docs WHERE user_id NOT IN (SELECT user_id FROM idle)")
def active_users(spark, sf_dir):
    return flat(ar.split_inactive(user_documents(spark, sf_dir), SHORT_AS_OF, **SHORT)[1])


def archive_run(spark, sf_dir):
    """A run by user over all documents: its folder, and the archived and remaining documents."""
    folder = fresh_folder(spark, "archive-run")
    return folder, *archive_inactive(
        user_documents(spark, sf_dir), SHORT_AS_OF, RUN_DATE, f"{folder}/archive", f"{folder}/reports", **SHORT)


@query("archive_run", f"""{WITH_SHORT} SELECT *, user_id IN (SELECT user_id FROM idle) AS archived FROM user_docs""")
def archived_and_remaining(spark, sf_dir):
    _, archived, remaining = archive_run(spark, sf_dir)
    return flat(archived).withColumn("archived", F.lit(True)).unionByName(
        flat(remaining).withColumn("archived", F.lit(False)))


@query("archive_run_report", f"{WITH_SHORT} SELECT '{RUN_DATE}' AS date, count(*) AS archived_users_count FROM idle")
def archive_run_report(spark, sf_dir):
    folder, *_ = archive_run(spark, sf_dir)
    return spark.read.schema("date string, archived_users_count long").json(f"{folder}/reports/report/date={RUN_DATE}")


@query("archive_run_ids", f"{WITH_SHORT} SELECT user_id FROM idle")
def archive_run_ids(spark, sf_dir):
    folder, *_ = archive_run(spark, sf_dir)
    return spark.read.schema("user_id long").json(f"{folder}/reports/ids/date={RUN_DATE}")


@query("archive_collection", f"{WITH_DOCS} SELECT * FROM user_docs WHERE {PAST}")
def archive_collection(spark, sf_dir):
    """Nested JSON documents with a storage key, archived, and the archive read back."""
    source, target = fresh_folder(spark, "documents"), fresh_folder(spark, "archived-users")
    writers.write_documents(user_documents(spark, sf_dir).withColumn("_id", F.expr("uuid()")), source)
    docs = read_documents(spark, source)
    writers.archive(ar.split_documents(docs, AS_OF)[0], target)
    return flat(read_documents(spark, target, fmt="parquet"))


@query("archive_report", f"""{WITH_DOCS}
SELECT '{RUN_DATE}' AS date, count(*) AS archived_users_count FROM user_docs WHERE {PAST}""")
def archive_report(spark, sf_dir):
    """The JSON report of a run, read back."""
    folder = fresh_folder(spark, "archive-report")
    writers.write_archive_report(ar.split_documents(user_documents(spark, sf_dir), AS_OF)[0], RUN_DATE, folder)
    return spark.read.schema("date string, archived_users_count long").json(f"{folder}/report/date={RUN_DATE}")


@query("archive_report_ids", f"{WITH_DOCS} SELECT user_id FROM user_docs WHERE {PAST}")
def archive_report_ids(spark, sf_dir):
    folder = fresh_folder(spark, "archive-report")
    writers.write_archive_report(ar.split_documents(user_documents(spark, sf_dir), AS_OF)[0], RUN_DATE, folder)
    return spark.read.schema("user_id long").json(f"{folder}/ids/date={RUN_DATE}")
