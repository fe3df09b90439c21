"""Outbox, messages and their ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.expressions import epoch_seconds
from tidemark.operators.messages import decode_logins, good_logins, quarantined
from tidemark.operators.outbox import ids_of, to_messages, unsent
from tidemark.plans.inputs import USER_LOGINS_SQL, user_logins
from tidemark.plans.registry import query
from tidemark.schemas import LOGIN_MESSAGE
from tidemark.sources.readers import read_topic
from tidemark.sources.writers import create_table, write_messages
from tidemark.streaming.ingest import append_once, ingest_logins, read_logins, read_quarantine
from tidemark.streaming.publish import merge_ledger, publish_outbox, read_ledger
from tidemark.workspace import fresh_folder

WITH_LOGINS = f"WITH user_logins AS ({USER_LOGINS_SQL})"
EPOCH = "epoch_us(event_time) / 1000000.0"
AS_MESSAGE = f'username AS "user", event_type AS "event", {EPOCH} AS "timestamp"'
BROKEN = "id % 97 = 0"

GOOD = f"""{WITH_LOGINS} SELECT username, event_type, date_trunc('second', event_time) AS event_time
FROM user_logins WHERE NOT ({BROKEN})"""
BAD = f"{WITH_LOGINS} SELECT {AS_MESSAGE} FROM user_logins WHERE {BROKEN}"


def fields(text):
    return F.from_json(text, LOGIN_MESSAGE).alias("m")


def topic(spark, sf_dir, which="true"):
    """A message per login; some are damaged by turning the text around."""
    messages = to_messages(user_logins(spark, sf_dir).where(which))
    return messages.select(F.when(F.expr(BROKEN), F.reverse("value")).otherwise(F.col("value")).alias("value"))


def with_plain_time(logins):
    return logins.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def repaired(damaged):
    """The fields of a damaged message, the text turned back."""
    return damaged.select(fields(F.reverse("value"))).select("m.*")


@query("outbox_unsent", f"""{WITH_LOGINS}
SELECT id, username, event_type, {EPOCH} AS epoch FROM user_logins WHERE sent_to_kafka = FALSE""")
def outbox_unsent(spark, sf_dir):
    return unsent(user_logins(spark, sf_dir)).select(
        "id", "username", "event_type", epoch_seconds(F.col("event_time")).alias("epoch")
    )


@query("outbox_messages", f"{WITH_LOGINS} SELECT id, {AS_MESSAGE} FROM user_logins WHERE sent_to_kafka = FALSE")
def outbox_messages(spark, sf_dir):
    return to_messages(unsent(user_logins(spark, sf_dir))).select("id", fields("value")).select("id", "m.*")


def publish_runs(spark, sf_dir):
    """Three runs: over some rows, over all, and again, which finds every row in the merged ledger."""
    folder = fresh_folder(spark, "publish")
    rows = user_logins(spark, sf_dir)
    for some in (rows.where("id % 7 < 3"), rows, rows):
        publish_outbox(
            some, f"{folder}/ledger", lambda m: write_messages(m, {"path": f"{folder}/topic"}, "text")
        )
        merge_ledger(spark, f"{folder}/ledger")
    return folder


@query("outbox_published", f"{WITH_LOGINS} SELECT {AS_MESSAGE} FROM user_logins WHERE sent_to_kafka = FALSE")
def outbox_published(spark, sf_dir):
    sent = spark.read.text(f"{publish_runs(spark, sf_dir)}/topic")
    return sent.select(fields("value")).select("m.*")


@query("outbox_ledger", f"{WITH_LOGINS} SELECT id FROM user_logins WHERE sent_to_kafka = FALSE")
def outbox_ledger(spark, sf_dir):
    return ids_of(read_ledger(spark, f"{publish_runs(spark, sf_dir)}/ledger"))


@query("ingest_good", GOOD)
def ingest_good(spark, sf_dir):
    return with_plain_time(good_logins(decode_logins(topic(spark, sf_dir))))


@query("ingest_quarantine", BAD)
def ingest_quarantine(spark, sf_dir):
    return repaired(quarantined(decode_logins(topic(spark, sf_dir))))


@query("replays_suppressed", f"{WITH_LOGINS} SELECT id, username, event_type, event_time FROM user_logins")
def replays_suppressed(spark, sf_dir):
    """Logins delivered twice in different micro-batches, some for the first time only after much later ones."""
    folder = fresh_folder(spark, "replays")
    logins = user_logins(spark, sf_dir).drop("sent_to_kafka")
    for delivery in (logins.where("id % 5 <> 0"), logins):
        delivery.write.mode("append").parquet(f"{folder}/topic")
        stream = spark.readStream.schema(logins.schema).parquet(f"{folder}/topic")
        append_once(stream, ["id"], "event_time", f"{folder}/logins", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/logins").select(logins.columns)


@query("ingest_two_checkpoints", GOOD)
def ingest_two_checkpoints(spark, sf_dir):
    """Two halves of the topic, each read with a checkpoint of its own into the same table."""
    folder = fresh_folder(spark, "ingest")
    for half in (0, 1):
        write_messages(topic(spark, sf_dir, f"id % 2 = {half}"), {"path": f"{folder}/topic-{half}"}, "text")
        stream = read_topic(spark, {"path": f"{folder}/topic-{half}"}, "text")
        ingest_logins(stream, folder, f"{folder}/checkpoint-{half}").awaitTermination()
    return with_plain_time(read_logins(spark, folder).select("username", "event_type", "event_time"))


def ingested(spark, sf_dir) -> str:
    """The topic as text files, delivered in three parts that are ingested one after another."""
    folder = fresh_folder(spark, "ingest")
    for part in range(3):
        write_messages(topic(spark, sf_dir, f"id % 3 = {part}"), {"path": f"{folder}/topic"}, "text")
        stream = read_topic(spark, {"path": f"{folder}/topic"}, "text")
        ingest_logins(stream, folder, f"{folder}/checkpoint").awaitTermination()
    return folder


@query("ingest_stream", GOOD)
def ingest_stream(spark, sf_dir):
    """Ingested, and loaded into a table that is created if it is not there."""
    folder = ingested(spark, sf_dir)
    name = f"logins_{folder.rsplit('-', 1)[1]}"
    for _ in range(2):
        create_table(spark, name, "username string, event_type string, event_time timestamp", path=f"{folder}/table")
    read_logins(spark, folder).select("username", "event_type", "event_time").write.insertInto(name)
    logins = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    return with_plain_time(logins)


@query("ingest_stream_quarantine", BAD)
def ingest_stream_quarantine(spark, sf_dir):
    return repaired(read_quarantine(spark, ingested(spark, sf_dir)))
