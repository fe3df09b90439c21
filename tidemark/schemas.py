"""Explicit schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

SALES = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("price_per_unit", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("total_spent", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
])

EVENTS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("points_spent", T.DoubleType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
])

EVENT_STATES = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_bucket", T.LongType()),
    T.StructField("users", T.LongType()),
    T.StructField("total_points", T.DoubleType()),
    T.StructField("event_count", T.LongType()),
])

AUDIT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("changed_at", T.TimestampNTZType()),
    T.StructField("changed_by", T.StringType()),
    T.StructField("field_changed", T.StringType()),
    T.StructField("old_value", T.StringType()),
    T.StructField("new_value", T.StringType()),
])

USER_DOCUMENTS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("user_info", T.StructType([
        T.StructField("registration_date", T.TimestampNTZType()),
    ])),
])

LOGINS = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])

LOGIN_MESSAGE = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])

RECORDS = T.StructType([
    T.StructField("quote_text", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("tags", T.StringType()),
])
