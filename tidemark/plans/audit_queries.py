"""Field-level change log and its export."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.audit import audit_day as changes_of_day
from tidemark.operators.audit import change_history as log_history
from tidemark.operators.audit import change_log as log_changes
from tidemark.operators.audit import pair_versions
from tidemark.plans.inputs import USER_HISTORY_SQL, USERS_NEW_SQL, USERS_OLD_SQL, user_history, user_versions
from tidemark.plans.registry import query
from tidemark.schemas import AUDIT
from tidemark.sources.readers import read_audit, read_csv
from tidemark.sources.writers import append_audit, export_audit, write_version
from tidemark.streaming.history import ChangeHistory
from tidemark.workspace import fresh_folder

FIELDS = ["name", "email", "role"]
DAY = "2024-01-03"
EDITOR = "nightly load"

CHANGES = f"""WITH users_old AS ({USERS_OLD_SQL}), users_new AS ({USERS_NEW_SQL}), changes AS (""" + " UNION ALL ".join(
    f"""SELECT n.id AS user_id, updated_at AS changed_at, '{f}' AS field_changed,
    o.{f} AS old_value, n.{f} AS new_value, '{EDITOR}' AS changed_by
    FROM users_old o JOIN users_new n ON o.id = n.id WHERE o.{f} IS DISTINCT FROM n.{f}"""
    for f in FIELDS
) + ")"
ONE_DAY = f"WHERE CAST(changed_at AS date) = DATE '{DAY}'"


def all_changes(spark, sf_dir):
    old, new = user_versions(spark, sf_dir)
    return log_changes(old, new, FIELDS, F.col("new.updated_at"), EDITOR)


@query("user_pairs", f"""WITH users_old AS ({USERS_OLD_SQL}), users_new AS ({USERS_NEW_SQL})
SELECT n.id, o.name AS old_name, n.name AS new_name FROM users_old o JOIN users_new n ON o.id = n.id""")
def user_pairs(spark, sf_dir):
    old, new = user_versions(spark, sf_dir)
    return pair_versions(old, new, FIELDS).select(
        "id", F.col("old.name").alias("old_name"), F.col("new.name").alias("new_name")
    )


@query("change_log", f"{CHANGES} SELECT * FROM changes")
def change_log(spark, sf_dir):
    return all_changes(spark, sf_dir)


@query("change_log_bucketed", f"{CHANGES} SELECT * FROM changes")
def change_log_bucketed(spark, sf_dir):
    """The same log from two versions stored in buckets, so the join does not shuffle."""
    path = fresh_folder(spark, "versions")
    run = path.rsplit("-", 1)[1]
    names = [f"users_{side}_{run}" for side in ("old", "new")]
    for users, name in zip(user_versions(spark, sf_dir), names):
        write_version(users, name, f"{path}/{name}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    old, new = map(spark.table, names)
    log = log_changes(old, new, FIELDS, F.col("new.updated_at"), EDITOR)
    for name in names:  # their files stay
        spark.sql(f"DROP TABLE {name}")
    return log


@query("audit_day", f"{CHANGES} SELECT * FROM changes {ONE_DAY}")
def audit_day(spark, sf_dir):
    return changes_of_day(all_changes(spark, sf_dir), DAY)


@query("audit_export", f"{CHANGES} SELECT * FROM changes {ONE_DAY}")
def audit_export(spark, sf_dir):
    """The dated CSV of one day from the stored log, read back."""
    folder = fresh_folder(spark, "audit")
    append_audit(all_changes(spark, sf_dir), f"{folder}/log")
    path = export_audit(read_audit(spark, f"{folder}/log"), DAY, folder)
    return read_csv(spark, path, AUDIT)


HISTORY = f"""WITH versions AS (SELECT DISTINCT * FROM ({USER_HISTORY_SQL})), turns AS (
    SELECT *, row_number() OVER turn AS turn, {", ".join(f"lag({f}) OVER turn AS old_{f}" for f in FIELDS)}
    FROM versions WINDOW turn AS (PARTITION BY id ORDER BY updated_at, {", ".join(f"{f} NULLS FIRST" for f in FIELDS)}))
""" + " UNION ALL ".join(
    f"""SELECT id AS user_id, updated_at AS changed_at, '{f}' AS field_changed, CAST(old_{f} AS VARCHAR) AS old_value,
    CAST({f} AS VARCHAR) AS new_value, '{EDITOR}' AS changed_by FROM turns WHERE turn > 1 AND old_{f} IS DISTINCT FROM {f}"""
    for f in FIELDS
)


@query("change_history", HISTORY)
def change_history(spark, sf_dir):
    """The changes of every update along some ten versions of each user."""
    return log_history(user_history(spark, sf_dir), FIELDS, changed_by=EDITOR)


def streamed_history(spark, sf_dir) -> ChangeHistory:
    """The versions delivered in three parts, one after another, the kept ones merged after the second."""
    work, versions = fresh_folder(spark, "history"), user_history(spark, sf_dir)
    history = ChangeHistory(spark, f"{work}/history", versions.schema, FIELDS, changed_by=EDITOR)
    for number, years in enumerate(("< 1997", "BETWEEN 1997 AND 1998", "> 1998")):
        versions.where(f"year(updated_at) {years}").write.mode("append").parquet(f"{work}/versions")
        stream = spark.readStream.schema(versions.schema).parquet(f"{work}/versions")
        history.maintain(stream, f"{work}/checkpoint").awaitTermination()
        if number == 1:
            history.merge()
            history.retire()
    return history


@query("change_history_stream", HISTORY)
def change_history_stream(spark, sf_dir):
    return streamed_history(spark, sf_dir).log()


@query("users_latest", f"""SELECT id, name, email, role, updated_at FROM ({USER_HISTORY_SQL})
QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, {", ".join(f"{f} DESC NULLS LAST" for f in FIELDS)}) = 1""")
def users_latest(spark, sf_dir):
    """The last version of each user, as the stream keeps it."""
    return streamed_history(spark, sf_dir).latest()
