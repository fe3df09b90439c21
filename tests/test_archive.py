from __future__ import annotations

import datetime

import pytest

from tidemark.operators.archive import archive_report, archived_ids, inactive_users, split_documents, split_inactive
from tidemark.plans.jobs import archive_inactive
from tidemark.schemas import USER_DOCUMENTS
from tidemark.sources.readers import read_documents
from tidemark.sources.writers import archive, write_documents
from tidemark.workspace import fresh_folder

AS_OF = datetime.datetime(2024, 3, 1)


def doc(user, registered, idle, kind="x"):
    def ago(days):
        return None if days is None else AS_OF - datetime.timedelta(days=days)

    return (user, kind, ago(idle), (ago(registered),))


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([
        doc(1, 30, 14),                    # both limits exactly
        doc(2, 40, 20), doc(2, 40, 2),     # old document of an active user
        doc(3, 29, 20),
        doc(4, 40, 13.99),
        doc(5, None, 20), doc(6, 40, None),
        doc(None, 40, 20),
        *[doc(7, 50, 15 + i) for i in range(30)],
        *[doc(8, 50, i) for i in range(30)],
    ], USER_DOCUMENTS)


def count_by_user(df):
    return {r.user_id: r["count"] for r in df.groupBy("user_id").count().collect()}


def test_by_document(docs):
    archived, remaining = split_documents(docs, AS_OF)
    assert count_by_user(archived) == {1: 1, 2: 1, 7: 30, 8: 16, None: 1}
    assert archived.count() + remaining.count() == docs.count()


@pytest.mark.parametrize("hot_rows", [1, 10, 1000])
def test_by_user(docs, hot_rows):
    archived, active = split_inactive(docs, AS_OF, hot_rows=hot_rows)
    assert count_by_user(archived) == {1: 1, 7: 30}
    everything = archived.unionByName(active)
    assert sorted(everything.collect(), key=str) == sorted(docs.collect(), key=str)
    assert {r.user_id for r in inactive_users(docs, AS_OF).collect()} == {1, 7}


def test_report_of_an_empty_run(docs):
    nothing = split_documents(docs, datetime.datetime(2000, 1, 1))[0]
    assert [tuple(r) for r in archive_report(nothing, "2000-01-01").collect()] == [("2000-01-01", 0)]
    assert archived_ids(nothing).count() == 0


def test_documents_round_trip_and_archive(spark, docs):
    source, target = fresh_folder(spark, "docs"), fresh_folder(spark, "archive")
    write_documents(docs.selectExpr("uuid() AS _id", "*"), source)
    back = read_documents(spark, source)
    assert sorted(back.collect(), key=str) == sorted(docs.collect(), key=str)
    archive(spark.read.schema("_id string, user_id long").json(source), target)
    archive(docs.where("false").select("user_id"), target)
    assert spark.read.parquet(target).columns == ["user_id"] and spark.read.parquet(target).count() == docs.count()


def test_a_run_can_be_repeated(spark, docs):
    folder = fresh_folder(spark, "archive-run")
    for _ in range(2):
        archived, remaining = archive_inactive(docs, AS_OF, "2024-03-01", f"{folder}/archive", f"{folder}/reports")
    assert spark.read.parquet(f"{folder}/archive").count() == archived.count() == 31
    assert archived.count() + remaining.count() == docs.count()
    report = spark.read.json(f"{folder}/reports/report")
    assert [(str(r.date), r.archived_users_count) for r in report.collect()] == [("2024-03-01", 2)]
    ids = [r.user_id for r in spark.read.json(f"{folder}/reports/ids").collect()]
    assert len(ids) == len(set(ids)) == 2
