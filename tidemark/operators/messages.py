"""Decode login messages; keep what cannot be decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions.expressions import from_epoch

FIRST_UNSUPPORTED_SECOND = 2**32  # the target column holds unsigned 32-bit seconds


def decode_logins(messages: DataFrame) -> DataFrame:
    """username, event_type, event_time and the message text for every message.

    ``complete`` is false for text that is not such a JSON object, for missing
    fields and for times the target cannot hold.
    """
    schema = StructType([*schemas.LOGIN_MESSAGE.fields, StructField("unreadable", StringType())])
    message = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unreadable"})
    # Unfolding a one-element array keeps the planner from parsing the text once per use of a field.
    decoded = messages.select("value", F.inline(F.array(message)))
    seconds = F.when(
        (F.col("timestamp") >= 0) & (F.col("timestamp") < F.lit(FIRST_UNSUPPORTED_SECOND)), F.col("timestamp")
    )
    complete = (
        F.col("unreadable").isNull() & F.col("user").isNotNull() & F.col("event").isNotNull() & seconds.isNotNull()
    )
    return decoded.select(
        F.col("user").alias("username"),
        F.col("event").alias("event_type"),
        from_epoch(seconds).alias("event_time"),
        "value",
        F.coalesce(complete, F.lit(False)).alias("complete"),
    )


def good_logins(decoded: DataFrame) -> DataFrame:
    return decoded.where("complete").select("username", "event_type", "event_time")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("complete")).select("value")
