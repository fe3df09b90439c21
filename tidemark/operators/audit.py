"""Field-level change log between two versions of a keyed table, or along a history of versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import day, moment
from tidemark.workspace import fresh_folder, written


def pair_versions(old: DataFrame, new: DataFrame, fields: list[str], key: str = "id") -> DataFrame:
    """Key with the ``old`` and ``new`` structs of rows present in both versions."""
    before = old.select(key, F.struct(*fields).alias("old"))
    after = new.select(key, F.struct(*[c for c in new.columns if c != key]).alias("new"))
    return before.join(after, key, "inner")


def changed(field: str) -> Column:
    return ~F.col(f"old.{field}").eqNullSafe(F.col(f"new.{field}"))


def field_changes(pairs: DataFrame, fields: list[str], changed_at, changed_by=None, key: str = "id") -> DataFrame:
    """One row per changed field of each pair; a change to or from null counts.

    Rows without any change are dropped before the fields are unfolded.
    ``changed_at`` may be a column of the pair, such as ``new.updated_at``.
    """
    author = changed_by if isinstance(changed_by, Column) else (
        F.current_user() if changed_by is None else F.lit(changed_by)
    )
    one_per_field = F.array(*[
        F.struct(
            F.lit(f).alias("field_changed"),
            F.col(f"old.{f}").cast("string").alias("old_value"),
            F.col(f"new.{f}").cast("string").alias("new_value"),
            changed(f).alias("differs"),
        )
        for f in fields
    ])
    return (
        pairs.where(reduce(lambda a, b: a | b, map(changed, fields)))
        .select(
            F.col(key).alias("user_id"),
            moment(changed_at).alias("changed_at"),
            author.alias("changed_by"),
            F.explode(one_per_field).alias("change"),
        )
        .where("change.differs")
        .select("user_id", "changed_at", "changed_by", "change.field_changed", "change.old_value", "change.new_value")
    )


def change_log(old: DataFrame, new: DataFrame, fields: list[str], changed_at, changed_by=None, key: str = "id") -> DataFrame:
    return field_changes(pair_versions(old, new, fields, key), fields, changed_at, changed_by, key)


def versions_of(rows: DataFrame, at: str, key: str = "id") -> DataFrame:
    """``id``, ``turn`` and the row as struct ``now``, each version once; rows without a key are left out.

    Versions of a key follow each other by time, those of one time by their values.
    """
    others = F.struct(*[c for c in rows.columns if c != key]).alias("now")
    return rows.where(F.col(key).isNotNull()).select(
        F.col(key).alias("id"), F.struct(F.lit(1).alias("kind"), F.col(at).alias("at")).alias("turn"), others).distinct()


def consecutive(versions: DataFrame) -> DataFrame:
    """``id``, ``old``, ``new`` of versions (id, turn, now) that follow each other; the first of an id has none before it.

    The versions are dealt to tasks by ranges of id and turn, so an id with any number of versions spreads over many
    tasks, and are looked back on within a range. Only an id at the edge of its range can go on in the next:
    the last versions of these ids, at most two a range, are broadcast to the ranges that follow.
    """
    spark = versions.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = versions.repartitionByRange(parts, "id", "turn", "now").withColumn("range", F.spark_partition_id())
    ranged = written(ranged, f"{fresh_folder(spark, 'versions')}/ranged")
    edges = ranged.groupBy("range").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    edges = edges.select(F.explode(F.array("first", "last")).alias("id")).distinct()
    ends = ranged.join(F.broadcast(edges), "id", "left_semi").groupBy("range", "id").agg(
        F.max_by("now", F.struct("turn", "now")).alias("now"))
    earlier = ends.select("range", "id", F.lag("now").over(Window.partitionBy("id").orderBy("range")).alias("earlier"))
    within = Window.partitionBy("range", "id").orderBy("turn", "now")
    looked = ranged.select("range", "id", F.lag("now").over(within).alias("old"), F.col("now").alias("new"))
    back = F.coalesce("old", "earlier")
    found = looked.join(F.broadcast(earlier.where("earlier IS NOT NULL")), ["range", "id"], "left")
    return found.select("id", back.alias("old"), "new").where("old IS NOT NULL")


def change_history(versions: DataFrame, fields: list[str], at: str = "updated_at", changed_by=None, key: str = "id") -> DataFrame:
    """The changes of every update along all versions of each key, as a trigger would log them.

    A first version is an insert and logs nothing; a version without any change neither. A version that is
    given twice counts once. ``changed_by`` may be a column of the new version, such as ``new.editor``.
    """
    pairs = consecutive(versions_of(versions, at, key)).withColumnRenamed("id", key)
    return field_changes(pairs, fields, F.col(f"new.{at}"), changed_by, key)


def audit_day(log: DataFrame, date) -> DataFrame:
    """The changes of one calendar day; of a log stored by day only that day is read."""
    start = day(date)
    if "changed_date" in log.columns:
        log = log.where(F.col("changed_date") == start).drop("changed_date")
    return log.where(
        (F.col("changed_at") >= start.cast("timestamp_ntz"))
        & (F.col("changed_at") < F.date_add(start, 1).cast("timestamp_ntz"))
    )
