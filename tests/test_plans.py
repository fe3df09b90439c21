"""What the physical plans of the queries may and may not contain."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import sales
from tidemark.operators.audit import change_log
from tidemark.operators.joins import ROWS, lookup_join
from tidemark.operators.messages import decode_logins, good_logins, quarantined
from tidemark.operators.retention import retention_7d
from tidemark.plans import QUERIES
from tidemark.schemas import SALES
from tidemark.workspace import fresh_folder

SF_DIR = "/root/testdata/sf0.001"
WRITES = re.compile(r"stream|backfill|replays|compacted|export|expiry|from_csv|collection|report|published|ledger|bucketed|two_checkpoints|archive_run|_csv|chain|chain_records|inventory")


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    text = plan(df)
    return text[: text.index("== Initial Plan")]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not WRITES.search(n)))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"MapIn\w+|\w*EvalPython|InPandas|PythonUDF", text)
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["top_categories", "top_customers"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


@pytest.fixture
def sales_table(spark):
    path = fresh_folder(spark, "sales-table")
    spark.createDataFrame([], SALES).write.parquet(path)
    return spark.read.parquet(path)


def test_report_reads_only_its_columns_and_pushes_null_tests(sales_table):
    text = plan(sales.avg_by(sales.clean_sales(sales_table), "location"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "category", "price_per_unit", "quantity", "total_spent", "location"
    }
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text)[1]
    assert {"IsNotNull(category)", "IsNotNull(total_spent)", "IsNotNull(location)"} <= set(pushed.split(", "))


def test_summary_scans_and_shuffles_once(sales_table):
    text = plan(sales.sales_summary(sales.clean_sales(sales_table)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_dictionary_does_not_sort_the_sales(sales_table):
    text = plan(sales.product_dictionary(sales_table))
    below_first_shuffle = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle and "Sort" not in below_first_shuffle


def test_retention_has_one_scan_and_no_join(spark):
    text = plan(retention_7d(ev_table(spark)))
    assert text.count("FileScan") == 1 and "Join" not in text and "Expand" not in text


def ev_table(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet").selectExpr(
        "user_id", "event_type", "value AS points_spent", "ts AS event_time"
    )


def test_retention_period_reaches_the_scan(spark):
    assert "GreaterThan(ts,2024-01-11T00:00)" in plan(ev.live_events(ev_table(spark), "2024-02-10 00:00:00"))


def test_states_are_combined_before_each_shuffle(spark):
    text = plan(ev.event_states(ev_table(spark)))
    assert "partial_bit_or" in text and text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    merged = plan(ev.merge_states(ev.combine_states(ev.event_states(ev_table(spark)))))
    assert "ObjectHashAggregate" not in merged and "SortAggregate" not in merged


def test_each_message_is_parsed_once(spark):
    path = fresh_folder(spark, "messages")
    spark.sql("SELECT '{}' AS value").write.parquet(path)
    decoded = decode_logins(spark.read.parquet(path))
    for part in (good_logins(decoded), quarantined(decoded)):
        assert plan(part).count("from_json(") == 1


def test_change_log_joins_once(spark):
    users = spark.range(5).selectExpr("id", "CAST(id AS string) AS name")
    text = plan(change_log(users, users, ["name"], "2024-01-01"))
    assert text.count("Join") == 1


def test_versions_in_buckets_join_without_a_shuffle(spark):
    with settings(spark, **NO_BROADCAST):
        assert "Exchange" not in plan(QUERIES["change_log_bucketed"](spark, SF_DIR))


def test_without_hot_keys_the_lookup_is_one_shuffle_join(spark):
    facts = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_partkey", "l_quantity")
    lookup = facts.groupBy("l_partkey").agg(F.count("*").alias(ROWS), F.max("l_quantity").alias("m"))
    with settings(spark, **NO_BROADCAST):
        cold = final_plan(lookup_join(facts, lookup, ["l_partkey"]))
        assert cold.count("SortMergeJoin") == 1 and "Broadcast" not in cold and "Union" not in cold
        hot = final_plan(lookup_join(facts, lookup, ["l_partkey"], hot_rows=40))
        assert "BroadcastHashJoin" in hot and "SortMergeJoin" in hot and "TakeOrderedAndProject" in hot


def test_adaptive_join_splits_a_hot_page(spark):
    """Joins without known row counts leave hot keys to the adaptive planner."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    with settings(spark, **NO_BROADCAST, **small):
        reached = spark.range(0, 60_000, 1, 8).selectExpr("id AS seed", "IF(id % 3 = 0, 1, id) AS page", "id AS depth")
        jumps = spark.range(60_000).selectExpr("id AS page", "id + 1 AS next_page")
        text = final_plan(reached.join(jumps, "page").groupBy("seed", "next_page").agg(F.min("depth")))
        assert "skew=true" in text
