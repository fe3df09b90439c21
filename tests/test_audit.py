from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.audit import audit_day, change_log
from tidemark.schemas import AUDIT
from tidemark.sources.readers import read_audit, read_csv
from tidemark.sources.writers import append_audit, export_audit
from tidemark.workspace import fresh_folder

FIELDS = ["name", "email", "role"]
USERS = "id long, name string, email string, role string"


def test_one_row_per_changed_field(spark):
    old = spark.createDataFrame([
        (1, "a", "a@x", "r"), (2, "b", None, "r"), (3, "c", "c@x", None), (4, "d", "d@x", "r"), (5, None, None, None),
    ], USERS)
    new = spark.createDataFrame([
        (1, "A", "a@x", "s"), (2, "b", "b@x", "r"), (3, "c", None, None), (5, None, None, None), (6, "f", "f@x", "r"),
    ], USERS)
    log = change_log(old, new, FIELDS, "2024-01-02 03:04:05", "me")
    assert sorted((r.user_id, r.field_changed, r.old_value, r.new_value) for r in log.collect()) == [
        (1, "name", "a", "A"), (1, "role", "r", "s"), (2, "email", None, "b@x"), (3, "email", "c@x", None),
    ]
    assert {(r.changed_at, r.changed_by) for r in log.collect()} == {(datetime.datetime(2024, 1, 2, 3, 4, 5), "me")}
    assert log.columns == AUDIT.names


def test_author_and_time_may_come_from_the_row(spark):
    old = spark.createDataFrame([(1, "a", 0)], "id long, name string, n int")
    new = spark.createDataFrame([(1, "b", 7)], "id long, name string, n int")
    row = change_log(old, new, ["name", "n"], F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("new.n"), F.lit(0), F.lit(0), F.lit(0))).collect()
    assert {r.new_value for r in row} == {"b", "7"} and row[0].changed_at.day == 7 and row[0].changed_by


@pytest.fixture
def log(spark):
    def change(user, text, *moment):
        return (user, datetime.datetime(2024, 1, *moment), "me", "name", "", text)

    return spark.createDataFrame([
        change(1, 'say "hi", ok', 2, 23, 59, 59, 999999),
        change(2, "plain", 2),
        change(3, None, 3),
        change(4, " spaced ", 1, 23, 59, 59, 999999),
        change(5, " two words", 2, 12),
    ], AUDIT)


def test_stored_log_reads_one_day(spark, log):
    path = fresh_folder(spark, "audit-log")
    append_audit(log.where("user_id < 3"), path)
    append_audit(log.where("user_id >= 3"), path)
    stored = read_audit(spark, path)
    one_day = audit_day(stored, "2024-01-02")
    assert one_day.columns == AUDIT.names and sorted(r.user_id for r in one_day.collect()) == [1, 2, 5]
    assert "changed_date#" in re.search(r"PartitionFilters: \[([^]]*)\]", one_day._jdf.queryExecution().toString())[1]
    assert stored.count() == 5


def test_export_of_a_day(spark, log):
    assert sorted(r.user_id for r in audit_day(log, "2024-01-02").collect()) == [1, 2, 5]
    path = export_audit(log, "2024-01-02", fresh_folder(spark, "audit"), single_file=True)
    assert path.endswith("/users_audit_export_2024-01-02")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0] == "user_id,changed_at,changed_by,field_changed,old_value,new_value"
    assert [line.split(",")[0] for line in lines[1:]] == ["2", "5", "1"]
    assert lines[3] == '1,2024-01-02 23:59:59.999999,me,name,"","say ""hi"", ok"'
    back = read_csv(spark, path, AUDIT, keep_empty=True)
    assert sorted(back.collect(), key=str) == sorted(audit_day(log, "2024-01-02").collect(), key=str)
