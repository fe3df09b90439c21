"""Messages of a topic into the login table, unusable ones into quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, DateType, LongType, StringType, StructField, StructType

from tidemark.operators.messages import decode_logins, good_logins, quarantined
from tidemark.schemas import LOGINS
from tidemark.sources.writers import laid_out
from tidemark.workspace import NO_DAY, Folder, fresh_folder, run_of, written

#: Batch numbers start again with a new checkpoint, so folders are named by query and batch.
FOLDERS = [StructField("run", StringType()), StructField("batch_id", LongType()), StructField("event_date", DateType())]

#: Bits of the filter of a folder and day; a filter that is too small for its keys only spares less reading.
FILTER_BITS = 1 << 22
FILTER = [StructField("bitmap", LongType()), StructField("bits", BinaryType())]


def store_batch(messages: DataFrame, batch_id: int, path: str, run: str) -> None:
    """Write one micro-batch of a run; a replay of the same number replaces its folders."""
    decoded = decode_logins(messages).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        logins = good_logins(decoded).withColumn("event_date", F.to_date("event_time"))
        (
            laid_out(logins, ["event_time"])
            .write.mode("overwrite").partitionBy("event_date")
            .parquet(f"{path}/logins/run={run}/batch_id={batch_id}")
        )
        quarantined(decoded).write.mode("overwrite").parquet(f"{path}/quarantine/run={run}/batch_id={batch_id}")
    finally:
        decoded.unpersist()


def ingest_logins(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start the ingest; the checkpoint takes the place of consumer group offsets."""
    spark = messages.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, path, run_of(spark, checkpoint))

    return (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_once(
    rows: DataFrame, keys: list[str], time: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream without rows whose keys are stored already, however late they come.

    A message delivered again has the same time, so a micro-batch is compared with the
    stored days that it touches and no state is kept; a null key equals a null key. Of these days only the folders
    are read whose Bloom filter holds a key of the micro-batch.
    """
    spark = rows.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        store_once(batch, keys, time, path, f"run={run_of(spark, checkpoint)}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def store_once(batch: DataFrame, keys: list[str], time: str, path: str, name: str) -> None:
    """Write the rows of one micro-batch that are not stored yet; a replay of the same name replaces its folders.

    The filter is written first, so what is stored is always found; a filter may hold keys that were not stored.
    """
    spark = batch.sparkSession
    work = fresh_folder(spark, "once")
    fresh = written(batch.dropDuplicates(keys).withColumn("event_date", F.to_date(time)), f"{work}/batch")
    known = stored_like(fresh, keys, path, name)
    bits = fresh.groupBy("event_date", *places_of(keys)[:1]).agg(F.bitmap_construct_agg(places_of(keys)[1]).alias("bits"))
    bits.write.mode("overwrite").partitionBy("event_date").parquet(f"{filters_of(path)}/{name}")
    if known is not None:
        known = known.select(*[F.col(k).alias(f"known_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in keys]
        fresh = fresh.join(known, reduce(lambda a, b: a & b, same), "left_anti")
    laid_out(fresh, [time]).write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/{name}")
    Folder(spark, work).remove("")


def filters_of(path: str) -> str:
    """Beside the table: per folder and day the Bloom filter of its keys, in bitmaps."""
    return f"{path.rstrip('/')}-filters"


def places_of(keys: list[str]) -> tuple[Column, Column]:
    """The bitmap of a key in a filter, and its place there."""
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    return F.bitmap_bucket_number(place).alias("bitmap"), F.bitmap_bit_position(place)


def stored_like(fresh: DataFrame, keys: list[str], path: str, name: str) -> DataFrame | None:
    """The rows of stored folders that may share keys with ``fresh``, which has ``event_date``; None if there are none.

    What an earlier try of the batch ``name`` wrote is left out. Only names of folders reach the driver.
    """
    spark, table = fresh.sparkSession, Folder(fresh.sparkSession, path)
    if not Folder(spark, filters_of(path)).has():
        return None
    days = [r[0] for r in fresh.select("event_date").distinct().collect()]
    filters = spark.read.schema(StructType([*FILTER, *FOLDERS])).parquet(filters_of(path))
    touched = F.col("event_date").isin([d for d in days if d is not None])
    filters = filters.where(touched | F.col("event_date").isNull() if None in days else touched)
    filters = filters.where(F.concat(F.lit("run="), "run", F.lit("/batch_id="), "batch_id") != name)
    bitmap, place = places_of(keys)
    asked = fresh.select(F.col("event_date").alias("day"), bitmap.alias("asked"), place.alias("place")).distinct()
    met = filters.join(asked, F.col("event_date").eqNullSafe(F.col("day")) & (F.col("bitmap") == F.col("asked")))
    byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    held = F.getbit(byte, (F.col("place") % 8).cast("int")) == 1
    found = met.where(held).select("run", "batch_id", "event_date").distinct().collect()
    folders = [f"run={r['run']}/batch_id={r['batch_id']}/event_date={r['event_date'] or NO_DAY}" for r in found]
    folders = [f"{path}/{f}" for f in folders if table.has(f)]
    if not folders:
        return None
    fields = StructType([f for f in fresh.schema if f.name != "event_date"])
    return spark.read.schema(fields).parquet(*folders)


def read_logins(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType([*LOGINS.fields, *FOLDERS])).parquet(f"{path}/logins")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, run string, batch_id long").parquet(f"{path}/quarantine")
