"""Joins against a keyed table that stay balanced when few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import present
from tidemark.workspace import fresh_folder, written

HOT_ROWS = 5_000_000
MAX_HOT_KEYS = 10_000
ROWS = "_rows"


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``facts`` with ``lookup``, which has one row for every key of ``facts``.

    ``lookup[ROWS]`` is the number of fact rows of the key, counted in the
    same aggregation that built the lookup, which is written once and read from there.
    Keys with at least ``hot_rows`` rows never shuffle their rows: their lookup
    rows, at most ``MAX_HOT_KEYS``, are broadcast. All other rows, whatever their
    key, meet in an ordinary shuffle join, which is all there is without hot
    keys. Rows with a null key match nothing.
    """
    facts = facts.where(present(*on))
    lookup = written(lookup.where(present(*on)), fresh_folder(facts.sparkSession, "lookup"))
    hot = lookup.where(F.col(ROWS) >= hot_rows).orderBy(F.desc(ROWS), *on).limit(MAX_HOT_KEYS)
    if hot.isEmpty():
        return facts.join(lookup, on).drop(ROWS)
    spread = facts.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return spread.join(lookup, on).unionByName(facts.join(F.broadcast(hot), on)).drop(ROWS)
