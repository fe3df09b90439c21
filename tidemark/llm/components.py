"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Folder, fresh_folder, written


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (columns a, b of one type) that is not its own root.

    The root is the smallest node of the component. Loops and repeated edges do no harm; no
    edges give no rows. Each round hangs every node under smaller ones and all edges are kept
    in one table in the shared folder, so a node with any number of neighbours is only ever
    aggregated or joined, never gathered.
    """
    spark = edges.sparkSession
    folder = fresh_folder(spark, "components")
    tidy = edges.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
    current = written(tidy.where("child != parent").distinct(), f"{folder}/0")
    number, before = 0, None
    while True:
        now = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first())
        if now == before:
            return current.select(F.col("child").alias("node"), F.col("parent").alias("root"))
        before, number = now, number + 1
        lowest = current.groupBy("child").agg(F.min("parent").alias("low"))
        up = current.join(lowest.select(F.col("child").alias("parent"), "low"), "parent", "left").select(
            "child", F.coalesce("low", "parent").alias("parent"))
        up = written(up.distinct(), f"{folder}/{number}-up")
        lowest = up.groupBy("child").agg(F.min("parent").alias("low"))
        pairs = up.join(lowest, "child").select(
            F.explode(F.array(F.struct("child", F.col("low").alias("parent")),
                              F.struct(F.col("parent").alias("child"), F.col("low").alias("parent")))).alias("e"))
        down = pairs.select("e.*").where("child != parent").distinct()
        current = written(down, f"{folder}/{number}")
        Folder(spark, folder).remove(f"{number}-up")
        Folder(spark, folder).remove(str(number - 1))
