"""The given tables in the shapes the jobs read, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.expressions import moment


known_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in known_schemas:
        known_schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(known_schemas[path]).parquet(path)


RETAIL_SQL = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
       o_custkey AS customer_id,
       CASE WHEN (l_partkey + l_suppkey) % 37 = 0 THEN NULL ELSE p_type END AS category,
       CASE WHEN (l_orderkey + l_suppkey) % 11 = 0 THEN NULL ELSE p_name END AS item,
       CASE WHEN (l_orderkey + l_partkey) % 17 = 0 THEN NULL ELSE p_retailprice END AS price_per_unit,
       CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN NULL ELSE l_quantity END AS quantity,
       CASE WHEN (l_orderkey + l_linenumber + l_suppkey) % 19 = 0 THEN NULL
            ELSE round(l_quantity * p_retailprice, 2) END AS total_spent,
       CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS payment_method,
       CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE o_orderstatus END AS location,
       CAST(o_orderdate AS date) AS transaction_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with missing values: every line item with its order and part."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )

    def missing(key: str, every: int, value) -> F.Column:
        return F.when(F.expr(f"({key}) % {every} != 0"), value)

    return joined.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
        .alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        missing("l_partkey + l_suppkey", 37, F.col("p_type")).alias("category"),
        missing("l_orderkey + l_suppkey", 11, F.col("p_name")).alias("item"),
        missing("l_orderkey + l_partkey", 17, F.col("p_retailprice")).alias("price_per_unit"),
        missing("l_orderkey + l_linenumber", 13, F.col("l_quantity")).alias("quantity"),
        missing("l_orderkey + l_linenumber + l_suppkey", 19, F.round(F.col("l_quantity") * F.col("p_retailprice"), 2))
        .alias("total_spent"),
        missing("l_orderkey", 23, F.col("o_orderpriority")).alias("payment_method"),
        missing("l_orderkey", 29, F.col("o_orderstatus")).alias("location"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )


USER_EVENTS_SQL = "SELECT user_id, event_type, value AS points_spent, ts AS event_time FROM events"


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("value").alias("points_spent"), F.col("ts").alias("event_time")
    )


USERS_OLD_SQL = """
SELECT CASE WHEN c_custkey % 31 = 0 THEN -2 * c_custkey - 1 ELSE c_custkey END AS id,
       c_name AS name, concat('user', c_custkey, '@example.com') AS email, c_mktsegment AS role
FROM customer
"""
USERS_NEW_SQL = """
SELECT CASE WHEN c_custkey % 29 = 0 THEN -2 * c_custkey - 2 ELSE c_custkey END AS id,
       CASE WHEN c_custkey % 5 = 0 THEN concat(c_name, '-renamed') ELSE c_name END AS name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('user', c_custkey, '@example.com') END AS email,
       CASE WHEN c_custkey % 11 = 0 THEN 'ADMIN' ELSE c_mktsegment END AS role,
       TIMESTAMP '2024-01-01 06:00:00' + c_nationkey * INTERVAL '5' HOUR AS updated_at
FROM customer
"""


def user_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(old, new) users: every customer in both, some under an id only one side has."""
    customers = table(spark, sf_dir, "customer")
    email = F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    old = customers.select(
        F.expr("CASE WHEN c_custkey % 31 = 0 THEN -2 * c_custkey - 1 ELSE c_custkey END").alias("id"),
        F.col("c_name").alias("name"),
        email.alias("email"),
        F.col("c_mktsegment").alias("role"),
    )
    new = customers.select(
        F.expr("CASE WHEN c_custkey % 29 = 0 THEN -2 * c_custkey - 2 ELSE c_custkey END").alias("id"),
        F.expr("CASE WHEN c_custkey % 5 = 0 THEN concat(c_name, '-renamed') ELSE c_name END").alias("name"),
        F.when(F.col("c_custkey") % 7 != 0, email).alias("email"),
        F.expr("CASE WHEN c_custkey % 11 = 0 THEN 'ADMIN' ELSE c_mktsegment END").alias("role"),
        (moment("2024-01-01 06:00:00") + F.make_dt_interval(hours=F.col("c_nationkey") * 5)).alias("updated_at"),
    )
    return old, new


USER_HISTORY_SQL = """
SELECT o_custkey AS id, CAST(round(o_totalprice / 1000) AS BIGINT) AS name, o_orderpriority AS email,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS role, o_orderdate AS updated_at FROM orders
"""


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of users: what each of their orders says."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.round(F.col("o_totalprice") / 1000).cast("long").alias("name"),
        F.col("o_orderpriority").alias("email"), F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END").alias("role"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"))


USER_DOCS_SQL = """
SELECT user_id, event_type, ts AS event_time, r.registration_date
FROM events JOIN (SELECT user_id, min(ts) AS registration_date FROM events GROUP BY user_id) r USING (user_id)
"""


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity documents; the first event of a user counts as the registration."""
    events = table(spark, sf_dir, "events")
    registered = events.groupBy("user_id").agg(F.min("ts").alias("registration_date"))
    return events.join(registered, "user_id").select(
        "user_id", "event_type", F.col("ts").alias("event_time"), F.struct("registration_date").alias("user_info")
    )


USER_LOGINS_SQL = """
SELECT event_id AS id, concat('user_', user_id) AS username, event_type, ts AS event_time,
       event_id % 3 = 0 AS sent_to_kafka FROM events
"""


def user_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        "event_type",
        F.col("ts").alias("event_time"),
        (F.col("event_id") % 3 == 0).alias("sent_to_kafka"),
    )


def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, each but the last of a run of seven with a next link to the following one."""
    pages = table(spark, sf_dir, "pages")
    following = pages.select(
        (F.col("page_id") - 1).alias("page_id"), F.replace("url", F.lit("&"), F.lit("&amp;")).alias("next")
    )
    link = F.when(
        (F.col("page_id") + 1) % 7 != 0, F.concat(F.lit('<a rel="next" href="'), "next", F.lit('">next</a>'))
    )
    return pages.join(following, "page_id", "left").select(
        "page_id", "url", F.concat("html", F.coalesce(link, F.lit(""))).alias("html")
    )


def page_chain_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in runs of seven, each but the last of a run linking to the next."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("page"),
        F.when((F.col("page_id") + 1) % 7 != 0, F.col("page_id") + 1).alias("next_page"),
    )
