"""Which objects exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exists_in(keys: DataFrame, inventory: DataFrame, key: str = "key") -> DataFrame:
    """Each asked key once, with whether the inventory lists it; null is not listed.

    Both sides are reduced to distinct keys first, so a key asked for over
    and over, or holding many objects, is one row in the join.
    """
    listed = inventory.select(key).distinct().withColumn("listed", F.lit(True))
    return keys.select(key).distinct().join(listed, key, "left").select(
        key, F.col("listed").isNotNull().alias("found")
    )
