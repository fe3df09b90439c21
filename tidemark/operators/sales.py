"""Retail sales: repair missing values, drop incomplete rows, report.

Columns as in ``schemas.SALES``. The fills always read the original columns,
so their order does not matter: each needs the two values it computes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import present, ratio, weekday_name
from tidemark.operators.joins import HOT_ROWS, ROWS, lookup_join

REQUIRED = ["category", "quantity", "total_spent", "price_per_unit"]
ITEM_KEY = ["category", "price_per_unit"]


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(present(*columns))


def items_by_key(sales: DataFrame) -> DataFrame:
    """Distinct items per key with their row count.

    Comes before any ``min(item)``: a minimum of text would sort all sales,
    while counting by text is a hash aggregation that combines before the shuffle.
    """
    return sales.groupBy(*ITEM_KEY, "item").agg(F.count(F.lit(1)).alias("sold"))


def product_dictionary(sales: DataFrame) -> DataFrame:
    """One item per (category, price); ``ambiguous`` marks keys with several items."""
    return (
        items_by_key(sales.where(F.col("item").isNotNull()))
        .groupBy(*ITEM_KEY)
        .agg(F.min("item").alias("item_ref"), (F.count("item") > 1).alias("ambiguous"))
    )


def repairable_items(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("item").isNull() & present(*ITEM_KEY))


def with_looked_up_item(sales: DataFrame, to_fix: DataFrame, hot_rows: int) -> DataFrame:
    """``to_fix`` with ``item_restored``, null where no row of the key has an item."""
    lookup = (
        items_by_key(sales)
        .groupBy(*ITEM_KEY)
        .agg(
            F.min("item").alias("item_restored"),
            F.sum(F.when(F.col("item").isNull(), F.col("sold"))).alias(ROWS),
        )
        .where(F.col(ROWS).isNotNull())
    )
    return lookup_join(to_fix, lookup, ITEM_KEY, hot_rows)


def restore_items(sales: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows whose missing item is known from another row of the same key."""
    to_fix = repairable_items(sales).select("transaction_id", *ITEM_KEY, F.col("item").alias("item_before"))
    return with_looked_up_item(sales, to_fix, hot_rows).where(F.col("item_restored").isNotNull()).select(
        "transaction_id", *ITEM_KEY, "item_before", "item_restored"
    )


def with_restored_items(rows: DataFrame, known: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All ``rows``, missing items filled from ``known``; only repairable rows are joined."""
    fixed = with_looked_up_item(known, repairable_items(rows), hot_rows)
    untouched = rows.where(F.col("item").isNotNull() | ~present(*ITEM_KEY))
    return untouched.unionByName(fixed.withColumn("item", F.col("item_restored")).select(*rows.columns))


def computed_total() -> Column:
    return F.round(F.col("quantity") * F.col("price_per_unit"), 2)


def recalc_total(sales: DataFrame, fill_only: bool = False) -> DataFrame:
    """Totals as quantity × price: for every row, or only where missing."""
    total = F.coalesce("total_spent", computed_total()) if fill_only else computed_total()
    return sales.withColumn("total_spent", total)


def filled_quantity() -> Column:
    return F.coalesce("quantity", ratio(F.col("total_spent"), F.col("price_per_unit"), 0))


def filled_price() -> Column:
    return F.coalesce("price_per_unit", ratio(F.col("total_spent"), F.col("quantity"), 2))


def fill_quantity_price(sales: DataFrame) -> DataFrame:
    return sales.withColumns({"quantity": filled_quantity(), "price_per_unit": filled_price()})


def completable(fill_totals: bool = False) -> Column:
    """Whether a row has all required columns once the gaps are filled.

    Tests the raw columns: nothing is computed for rows that are dropped, and
    the plain null tests reach the file scan.
    """
    total = F.col("total_spent").isNotNull()
    computable = F.when(
        F.col("quantity").isNull(), total & (F.col("price_per_unit") != 0)
    ).otherwise(F.col("price_per_unit").isNotNull() | (total & (F.col("quantity") != 0)))
    complete = F.col("category").isNotNull() & F.coalesce(computable, F.lit(False))
    return complete if fill_totals else complete & total


def clean_sales(sales: DataFrame, intent: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fill quantity and price, keep complete rows.

    ``intent`` also merges restored items back and fills missing totals.
    """
    rows = sales.where(completable(fill_totals=intent))
    if not intent:
        return fill_quantity_price(rows)
    return with_restored_items(rows, sales, hot_rows).withColumns({
        "quantity": filled_quantity(),
        "price_per_unit": filled_price(),
        "total_spent": F.coalesce("total_spent", computed_total()),
    })


def with_calendar(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "day_of_week_num": F.dayofweek("transaction_date"),
        "day_of_week": F.date_format("transaction_date", "EEEE"),
        "transaction_month": F.date_format("transaction_date", "yyyy-MM"),
    })


def mean_spend() -> Column:
    return F.round(F.avg("total_spent"), 2).alias("avg_total_spent")


def top_categories(clean: DataFrame, n: int = 5) -> DataFrame:
    return (
        clean.groupBy("category")
        .agg(F.sum("quantity").alias("total_units"))
        .orderBy(F.desc("total_units"), F.asc("category"))
        .limit(n)
    )


def avg_by(clean: DataFrame, key: str) -> DataFrame:
    """Mean spend per value of ``key``, rows without a value left out."""
    return (
        clean.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(mean_spend())
        .orderBy(F.desc("avg_total_spent"), F.asc(key))
    )


def avg_by_weekday(clean: DataFrame) -> DataFrame:
    """Monday first. Groups by the day number; names are made for the seven results."""
    return (
        clean.groupBy(F.weekday("transaction_date").alias("day_number"))
        .agg(mean_spend())
        .orderBy("day_number")
        .select(weekday_name(F.col("day_number")).alias("day_of_week"), "avg_total_spent")
    )


def avg_by_month(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy(F.trunc("transaction_date", "month").alias("month"))
        .agg(mean_spend())
        .orderBy("month")
        .select(F.date_format("month", "yyyy-MM").alias("transaction_month"), "avg_total_spent")
    )


def customer_value(clean: DataFrame) -> DataFrame:
    """Lifetime value per customer; rows without a customer form one group."""
    return clean.groupBy("customer_id").agg(F.round(F.sum("total_spent"), 2).alias("clv"))


def top_customers(clean: DataFrame, n: int = 10) -> DataFrame:
    return customer_value(clean).orderBy(F.desc("clv"), F.asc("customer_id")).limit(n)


def sales_summary(clean: DataFrame) -> DataFrame:
    """All six reports from a single scan and a single shuffle.

    One row per (report, key). ``value`` is units for categories, the sum of
    spend for customers and the mean spend for all others.
    """
    keys = {
        "category": F.col("category"),
        "payment_method": F.col("payment_method"),
        "location": F.col("location"),
        "weekday": F.weekday("transaction_date"),
        "month": F.trunc("transaction_date", "month"),
        "customer": F.col("customer_id"),
    }
    keyed = clean.select(*[c.alias(n) for n, c in keys.items()], "quantity", "total_spent")
    grouped = keyed.groupingSets([[F.col(n)] for n in keys], *[F.col(n) for n in keys]).agg(
        *[(F.grouping(n) == 0).alias(f"by_{n}") for n in keys],
        F.sum("quantity").alias("units"),
        F.sum("total_spent").alias("spent"),
        F.avg("total_spent").alias("mean"),
    )
    text = {n: F.col(n).cast("string") for n in keys}
    text["weekday"] = weekday_name(F.col("weekday"))
    text["month"] = F.date_format("month", "yyyy-MM")
    return grouped.select(
        F.coalesce(*[F.when(F.col(f"by_{n}"), F.lit(n)) for n in keys]).alias("report"),
        F.coalesce(*[F.when(F.col(f"by_{n}"), text[n]) for n in keys]).alias("key"),
        F.when(F.col("by_category"), F.col("units"))
        .when(F.col("by_customer"), F.round("spent", 2))
        .otherwise(F.round("mean", 2))
        .alias("value"),
    ).where((F.col("report").isin("category", "weekday", "month", "customer")) | F.col("key").isNotNull())
