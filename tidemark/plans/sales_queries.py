"""Retail cleaning and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.names import normalize_columns
from tidemark.operators import sales
from tidemark.plans.inputs import RETAIL_SQL, retail, table
from tidemark.plans.registry import query
from tidemark.schemas import SALES
from tidemark.sources.readers import csv_rejects, read_csv, reject_counts
from tidemark.sources.writers import write_csv
from tidemark.workspace import fresh_folder

FILLED_QUANTITY = """coalesce(quantity, CASE WHEN price_per_unit <> 0
    THEN CAST(CAST(round(total_spent / price_per_unit, 0) AS int) AS double) END)"""
FILLED_PRICE = "coalesce(price_per_unit, CASE WHEN quantity <> 0 THEN round(total_spent / quantity, 2) END)"
COMPLETE = """category IS NOT NULL AND quantity IS NOT NULL
    AND total_spent IS NOT NULL AND price_per_unit IS NOT NULL"""

WITH_RETAIL = f"WITH retail AS ({RETAIL_SQL})"
WITH_FILLED = f"""{WITH_RETAIL}, filled AS (
    SELECT * REPLACE ({FILLED_QUANTITY} AS quantity, {FILLED_PRICE} AS price_per_unit) FROM retail)"""
WITH_CLEAN = f"{WITH_FILLED}, clean AS (SELECT * FROM filled WHERE {COMPLETE})"
WITH_DICTIONARY = f"""{WITH_RETAIL}, dictionary AS (
    SELECT category, price_per_unit, min(item) AS item_ref, count(DISTINCT item) > 1 AS ambiguous
    FROM retail WHERE item IS NOT NULL GROUP BY category, price_per_unit)"""


@query("top_categories", f"""{WITH_CLEAN}
SELECT category, sum(quantity) AS total_units FROM clean
GROUP BY category ORDER BY total_units DESC, category LIMIT 5""")
def top_categories(spark, sf_dir):
    return sales.top_categories(sales.clean_sales(retail(spark, sf_dir)))


@query("normalize_columns", """
SELECT p_partkey AS part_key, p_name AS part_key_2, p_brand AS http_brand, p_type AS part_type,
       p_size AS col, p_retailprice AS col_2 FROM part""")
def normalized(spark, sf_dir):
    return normalize_columns(
        table(spark, sf_dir, "part").toDF("Part Key", "part.key", "HTTPBrand", "partType", "Размер", "%")
    )


@query("fill_quantity_price", f"{WITH_FILLED} SELECT * FROM filled")
def fill_quantity_price(spark, sf_dir):
    return sales.fill_quantity_price(retail(spark, sf_dir))


@query("recalc_total_literal", f"""{WITH_RETAIL}
SELECT * REPLACE (round(quantity * price_per_unit, 2) AS total_spent) FROM retail""")
def recalc_total_literal(spark, sf_dir):
    return sales.recalc_total(retail(spark, sf_dir))


@query("recalc_total_intent", f"""{WITH_RETAIL}
SELECT * REPLACE (coalesce(total_spent, round(quantity * price_per_unit, 2)) AS total_spent) FROM retail""")
def recalc_total_intent(spark, sf_dir):
    return sales.recalc_total(retail(spark, sf_dir), fill_only=True)


@query("product_dictionary", f"{WITH_DICTIONARY} SELECT * FROM dictionary")
def product_dictionary(spark, sf_dir):
    return sales.product_dictionary(retail(spark, sf_dir))


@query("repairable_items", f"""{WITH_RETAIL}
SELECT * FROM retail WHERE item IS NULL AND category IS NOT NULL AND price_per_unit IS NOT NULL""")
def repairable_items(spark, sf_dir):
    return sales.repairable_items(retail(spark, sf_dir))


@query("restore_items", f"""{WITH_DICTIONARY}
SELECT transaction_id, category, price_per_unit, item AS item_before, item_ref AS item_restored
FROM retail JOIN dictionary USING (category, price_per_unit) WHERE item IS NULL""")
def restore_items(spark, sf_dir):
    return sales.restore_items(retail(spark, sf_dir))


@query("clean_sales", f"{WITH_CLEAN} SELECT * FROM clean")
def clean_sales(spark, sf_dir):
    return sales.clean_sales(retail(spark, sf_dir))


@query("clean_sales_intent", f"""{WITH_DICTIONARY}, filled AS (
    SELECT transaction_id, customer_id, category, coalesce(item, item_ref) AS item,
           {FILLED_PRICE} AS price_per_unit, {FILLED_QUANTITY} AS quantity,
           coalesce(total_spent, round(quantity * price_per_unit, 2)) AS total_spent,
           payment_method, location, transaction_date
    FROM retail LEFT JOIN dictionary USING (category, price_per_unit))
SELECT * FROM filled WHERE {COMPLETE}""")
def clean_sales_intent(spark, sf_dir):
    return sales.clean_sales(retail(spark, sf_dir), intent=True)


def mean_by(key: str) -> str:
    return f"""{WITH_CLEAN}
SELECT {key}, round(avg(total_spent), 2) AS avg_total_spent FROM clean
WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY avg_total_spent DESC, {key}"""


@query("avg_by_payment", mean_by("payment_method"))
def avg_by_payment(spark, sf_dir):
    return sales.avg_by(sales.clean_sales(retail(spark, sf_dir)), "payment_method")


@query("avg_by_location", mean_by("location"))
def avg_by_location(spark, sf_dir):
    return sales.avg_by(sales.clean_sales(retail(spark, sf_dir)), "location")


@query("avg_by_weekday", f"""{WITH_CLEAN}
SELECT dayname(transaction_date) AS day_of_week, round(avg(total_spent), 2) AS avg_total_spent
FROM clean GROUP BY day_of_week, isodow(transaction_date) ORDER BY isodow(transaction_date)""")
def avg_by_weekday(spark, sf_dir):
    return sales.avg_by_weekday(sales.clean_sales(retail(spark, sf_dir)))


@query("avg_by_month", f"""{WITH_CLEAN}
SELECT strftime(transaction_date, '%Y-%m') AS transaction_month, round(avg(total_spent), 2) AS avg_total_spent
FROM clean GROUP BY transaction_month ORDER BY transaction_month""")
def avg_by_month(spark, sf_dir):
    return sales.avg_by_month(sales.clean_sales(retail(spark, sf_dir)))


@query("customer_value", f"""{WITH_CLEAN}
SELECT customer_id, round(sum(total_spent), 2) AS clv FROM clean GROUP BY customer_id""")
def customer_value(spark, sf_dir):
    return sales.customer_value(sales.clean_sales(retail(spark, sf_dir)))


@query("top_customers", f"""{WITH_CLEAN}
SELECT customer_id, round(sum(total_spent), 2) AS clv FROM clean
GROUP BY customer_id ORDER BY clv DESC, customer_id LIMIT 10""")
def top_customers(spark, sf_dir):
    return sales.top_customers(sales.clean_sales(retail(spark, sf_dir)))


@query("sales_calendar", f"""{WITH_CLEAN}
SELECT transaction_id, CAST(dayofweek(transaction_date) + 1 AS int) AS day_of_week_num,
       dayname(transaction_date) AS day_of_week, strftime(transaction_date, '%Y-%m') AS transaction_month
FROM clean""")
def sales_calendar(spark, sf_dir):
    return sales.with_calendar(sales.clean_sales(retail(spark, sf_dir))).select(
        "transaction_id", "day_of_week_num", "day_of_week", "transaction_month"
    )


MEAN = "round(avg(total_spent), 2)"


def summary_of(report: str, key: str, value: str, rows: str = "true") -> str:
    return f"""SELECT '{report}' AS report, CAST({key} AS varchar) AS key, {value} AS value
    FROM clean WHERE {rows} GROUP BY {key}"""


@query("sales_summary", WITH_CLEAN + " UNION ALL ".join([
    summary_of("category", "category", "sum(quantity)"),
    summary_of("payment_method", "payment_method", MEAN, "payment_method IS NOT NULL"),
    summary_of("location", "location", MEAN, "location IS NOT NULL"),
    summary_of("weekday", "dayname(transaction_date)", MEAN),
    summary_of("month", "strftime(transaction_date, '%Y-%m')", MEAN),
    summary_of("customer", "customer_id", "round(sum(total_spent), 2)"),
]))
def sales_summary(spark, sf_dir):
    return sales.sales_summary(sales.clean_sales(retail(spark, sf_dir)))


@query("sales_from_csv", f"{WITH_CLEAN} SELECT * FROM clean")
def sales_from_csv(spark, sf_dir):
    """The whole job from a delimited file with spoken column names in another order and one more."""
    path = fresh_folder(spark, "sales-csv")
    sold = retail(spark, sf_dir)
    turned = sold.select(sold.columns[::-1]).withColumn("note", F.lit("x"))
    write_csv(turned.toDF(*[c.replace("_", " ").title() for c in turned.columns]), path)
    return sales.clean_sales(read_csv(spark, path, SALES))


# Cells that are damaged in the delimited file: which rows, the text of the cell.
DAMAGED = {
    "quantity": ("customer_id % 7 = 0", "concat('x', CAST(customer_id AS {text}))"),
    "price_per_unit": ("customer_id % 11 = 0", "'1,5'"),
    "transaction_date": ("customer_id % 13 = 0", "'2024-13-45'"),
}
DAMAGED_CELLS = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {cell.format(text='VARCHAR')} AS text FROM retail WHERE {rows}" for name, (rows, cell) in DAMAGED.items())
NULLED = ", ".join(f"CASE WHEN {rows} THEN NULL ELSE {name} END AS {name}" for name, (rows, _) in DAMAGED.items())


def damaged_csv(spark, sf_dir) -> str:
    """The sales as a delimited file with some cells of another type."""
    path, sold = fresh_folder(spark, "sales-csv"), retail(spark, sf_dir)
    cells = {name: F.when(F.expr(rows), F.expr(cell.format(text="STRING"))).otherwise(F.col(name).cast("string"))
             for name, (rows, cell) in DAMAGED.items()}
    write_csv(sold.withColumns(cells), path)
    return path


@query("sales_from_damaged_csv", f"""WITH given AS ({RETAIL_SQL}), retail AS (SELECT * REPLACE ({NULLED}) FROM given), filled AS (
    SELECT * REPLACE ({FILLED_QUANTITY} AS quantity, {FILLED_PRICE} AS price_per_unit) FROM retail)
SELECT * FROM filled WHERE {COMPLETE}""")
def sales_from_damaged_csv(spark, sf_dir):
    """The whole job where cells of another type become null."""
    return sales.clean_sales(read_csv(spark, damaged_csv(spark, sf_dir), SALES))


@query("sales_csv_rejects", f"{WITH_RETAIL}, cells AS ({DAMAGED_CELLS}) SELECT column_name, text FROM cells")
def sales_csv_rejects(spark, sf_dir):
    """Which cells these were."""
    return csv_rejects(spark, damaged_csv(spark, sf_dir), SALES).select("column_name", "text")


@query("sales_csv_reject_counts", f"{WITH_RETAIL}, cells AS ({DAMAGED_CELLS}) SELECT column_name, count(*) AS n FROM cells GROUP BY 1")
def sales_csv_reject_counts(spark, sf_dir):
    return reject_counts(csv_rejects(spark, damaged_csv(spark, sf_dir), SALES))
