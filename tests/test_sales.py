from __future__ import annotations

import datetime

import pytest

from tidemark.operators import sales
from tidemark.operators.joins import lookup_join
from tidemark.schemas import SALES

D = datetime.date(2024, 1, 1)


def sale(id, category="c", item="i", price=2.0, quantity=3.0, total=6.0, customer=1, pay="card", loc="web", date=D):
    return (id, customer, category, item, price, quantity, total, pay, loc, date)


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SALES)


def by_id(df, *columns):
    return {r["transaction_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_fill_quantity_and_price(frame):
    df = sales.fill_quantity_price(frame(
        sale("q", quantity=None, total=7.0, price=2.0),
        sale("p", price=None, total=10.0, quantity=3.0),
        sale("zero_price", quantity=None, price=0.0),
        sale("zero_quantity", price=None, quantity=0.0),
        sale("both", price=None, quantity=None),
        sale("huge", quantity=None, price=1e-9, total=1e9),
    ))
    assert by_id(df, "quantity", "price_per_unit") == {
        "q": (4.0, 2.0),
        "p": (3.0, 3.33),
        "zero_price": (None, 0.0),
        "zero_quantity": (0.0, None),
        "both": (None, None),
        "huge": (1e18, 1e-9),
    }


def test_recalc_total_modes(frame):
    df = frame(sale("wrong", total=1.0), sale("missing", total=None), sale("no_price", price=None, total=9.0))
    assert by_id(sales.recalc_total(df), "total_spent") == {
        "wrong": (6.0,), "missing": (6.0,), "no_price": (None,)
    }
    assert by_id(sales.recalc_total(df, fill_only=True), "total_spent") == {
        "wrong": (1.0,), "missing": (6.0,), "no_price": (9.0,)
    }


def test_dictionary_marks_ambiguous_keys(frame):
    df = sales.product_dictionary(frame(
        sale("1", item="b"), sale("2", item="a"), sale("3", item="a"), sale("4", "d", "x"), sale("5", "e", None)
    ))
    assert {(r.category, r.item_ref, r.ambiguous) for r in df.collect()} == {("c", "a", True), ("d", "x", False)}


@pytest.mark.parametrize("hot_rows", [1, 3, 1000])
def test_restored_items_do_not_depend_on_hot_keys(frame, hot_rows):
    rows = [sale("known", item="pen"), sale("known2", "d", "cup", price=5.0)]
    rows += [sale(f"hot{i}", item=None) for i in range(50)]
    rows += [sale("cold", "d", None, price=5.0), sale("unknown", "x", None), sale("no_price", item=None, price=None)]
    rows += [sale(f"unknown_hot{i}", "y", None) for i in range(20)]
    df = frame(*rows)
    restored = by_id(sales.restore_items(df, hot_rows), "item_before", "item_restored")
    assert restored == {**{f"hot{i}": (None, "pen") for i in range(50)}, "cold": (None, "cup")}
    merged = by_id(sales.with_restored_items(df, df, hot_rows), "item")
    assert len(merged) == len(rows)
    assert merged["hot7"] == ("pen",) and merged["unknown"] == (None,) and merged["no_price"] == (None,)
    assert merged["unknown_hot3"] == (None,) and merged["known"] == ("pen",)


def test_hot_keys_beyond_the_broadcast_bound_are_still_joined(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.joins.MAX_HOT_KEYS", 2)
    facts = spark.range(100).selectExpr("id % 10 AS k", "id AS v")
    lookup = facts.groupBy("k").count().selectExpr("k", "k * 2 AS double", "count AS _rows")
    joined = lookup_join(facts, lookup, ["k"], hot_rows=1)
    assert sorted(map(tuple, joined.collect())) == sorted((v % 10, v, v % 10 * 2) for v in range(100))


def test_clean_needs_four_columns(frame):
    df = frame(
        sale("ok"), sale("no_item", item=None), sale("no_category", category=None),
        sale("no_total", total=None), sale("no_quantity", quantity=None), sale("two", quantity=None, price=None),
    )
    assert set(by_id(sales.clean_sales(df), "item")) == {"ok", "no_item", "no_quantity"}
    intent = by_id(sales.clean_sales(df, intent=True), "item", "total_spent")
    assert set(intent) == {"ok", "no_item", "no_total", "no_quantity"}
    assert intent["no_item"] == ("i", 6.0) and intent["no_total"] == ("i", 6.0)


def test_rows_are_kept_exactly_if_the_fills_complete_them(spark, frame):
    values = [None, 0.0, -1.0, 3.0, 1e-9, 1e10, float("nan"), float("inf")]
    df = frame(*[
        sale(f"{c}/{p}/{q}/{t}", c, price=p, quantity=q, total=t)
        for c in ("c", None) for p in values for q in values for t in values
    ])
    filled = sales.require(sales.fill_quantity_price(df), sales.REQUIRED)
    assert set(by_id(sales.clean_sales(df), "item")) == set(by_id(filled, "item"))
    with_totals = sales.fill_quantity_price(df).withColumn("total_spent", sales.computed_total())
    complete = sales.require(with_totals, sales.REQUIRED).unionByName(filled)
    kept = df.where(sales.completable(fill_totals=True))
    assert set(by_id(kept, "item")) == set(by_id(complete, "item"))
    assert sales.require(sales.clean_sales(df, intent=True), sales.REQUIRED).count() == kept.count()


def test_reports(frame):
    sunday, monday = datetime.date(2024, 1, 7), datetime.date(2024, 1, 8)
    df = frame(
        sale("1", "b", quantity=5.0, total=1.0, date=sunday, customer=None, pay=None),
        sale("2", "a", quantity=5.0, total=2.0, date=monday, customer=2),
        sale("3", "z", quantity=9.0, total=2.0, date=datetime.date(2024, 2, 5), customer=1),
    )
    assert [tuple(r) for r in sales.top_categories(df, 2).collect()] == [("z", 9.0), ("a", 5.0)]
    assert [tuple(r) for r in sales.avg_by(df, "payment_method").collect()] == [("card", 2.0)]
    assert [tuple(r) for r in sales.avg_by_weekday(df).collect()] == [("Monday", 2.0), ("Sunday", 1.0)]
    assert [tuple(r) for r in sales.avg_by_month(df).collect()] == [("2024-01", 1.5), ("2024-02", 2.0)]
    assert [tuple(r) for r in sales.top_customers(df).collect()] == [(1, 2.0), (2, 2.0), (None, 1.0)]
    summary = {(r.report, r.key): r.value for r in sales.sales_summary(df).collect()}
    assert summary[("customer", None)] == 1.0 and summary[("weekday", "Monday")] == 2.0
    assert ("payment_method", None) not in summary and summary[("category", "z")] == 9.0


def test_any_number_of_units_is_kept(spark):
    row = dict.fromkeys(SALES.names) | {
        "transaction_id": "t", "category": "c", "price_per_unit": 0.01, "total_spent": 5e7,
        "transaction_date": datetime.date(2024, 1, 1),
    }
    clean = sales.clean_sales(spark.createDataFrame([tuple(row[n] for n in SALES.names)], SALES))
    assert [r.quantity for r in clean.collect()] == [5e9]
