"""Walks along links of which each page has at most one: lists, trees that run together, circles.

Every page is placed once, on one path. Where several pages link to one, its path goes on from
the page that most pages lead to, so a walk changes its path at most log2(pages) times. Walks are rows of paths,
(path, first place, place to stop before), and become pages only in the result: what is stored on the way is a
few rows per page and per seed, however many walks share their pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Folder, fresh_folder, written

#: Places of a path that meet the walks passing them in one group of a join.
BLOCK = 1024


def weighed(nodes: DataFrame, links: DataFrame, total: int, folder: str) -> DataFrame:
    """Per page that links: how many pages lead to it (``size``, itself counted), and whether it is on a ``circle``.

    Each round doubles the length of the jumps. A page that still jumps after as many steps as there are
    pages runs into a circle, and its jump ends on it; sizes on a circle mean nothing.
    """
    spark, step = nodes.sparkSession, 1
    start = nodes.join(links, "page", "left").select("page", F.col("next_page").alias("jump"), F.lit(1.0).alias("size"))
    state = written(start, f"{folder}/1")
    while step < total and not (going := state.where("jump IS NOT NULL")).isEmpty():
        more = going.groupBy(F.col("jump").alias("page")).agg(F.sum("size").alias("more"))
        far = state.select(F.col("page").alias("jump"), F.col("jump").alias("far"))
        longer = state.join(more, "page", "left").join(far, "jump", "left").select(
            "page", F.col("far").alias("jump"), (F.col("size") + F.coalesce("more", F.lit(0.0))).alias("size"))
        step *= 2
        state = written(longer, f"{folder}/{step}")
        Folder(spark, folder).remove(str(step // 2))
    circles = state.select(F.col("jump").alias("page")).where("page IS NOT NULL").distinct().withColumn("circle", F.lit(True))
    return state.join(circles, "page", "left").select("page", "size", F.coalesce("circle", F.lit(False)).alias("circle"))


def ranked(nodes: DataFrame, links: DataFrame, total: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Places (page, path, place) on lists: links in which no page is linked twice. A path is named by its first page.

    Also (page, low) of the pages on circles, which have no first page; ``low`` is the smallest of the circle.
    """
    spark, step = nodes.sparkSession, 1
    before = links.select(F.col("next_page").alias("page"), F.col("page").alias("before"))
    state = written(nodes.join(before, "page", "left").select(
        "page", F.coalesce("before", "page").alias("path"), F.col("before").isNotNull().cast("long").alias("place"),
        F.col("before").isNull().alias("done"), F.col("page").alias("low")), f"{folder}/1")
    while step < total and not (going := state.where("NOT done")).isEmpty():
        far = state.select(F.col("page").alias("path"), F.col("path").alias("far"), F.col("place").alias("farther"),
                           F.col("done").alias("ends"), F.col("low").alias("lower"))
        moved = going.join(far, "path").select(
            "page", F.col("far").alias("path"), (F.col("place") + F.col("farther")).alias("place"),
            F.col("ends").alias("done"), F.least("low", "lower").alias("low"))
        step *= 2
        state = written(state.where("done").unionByName(moved), f"{folder}/{step}")
        Folder(spark, folder).remove(str(step // 2))
    return state.where("done").select("page", "path", "place"), state.where("NOT done").select("page", "low")


def placed(nodes: DataFrame, links: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Places (page, path, place) of all pages, and where paths lead on: path, to_path, to_place.

    A path that leads to its own first page is a circle, cut before its smallest page.
    """
    total = nodes.count()
    merged = links.groupBy("next_page").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chosen = links
    if not merged.isEmpty():
        weights = weighed(nodes, links, total, f"{folder}/weights")
        first = F.min(F.struct((~F.col("circle")).alias("off"), (-F.col("size")).alias("less"), "page"))
        chosen = links.join(weights, "page").groupBy("next_page").agg(first.alias("best")).select(
            F.col("best.page").alias("page"), "next_page")
        chosen = written(chosen, f"{folder}/chosen")
    places, rounds = ranked(nodes, chosen, total, f"{folder}/lists")
    if not rounds.isEmpty():
        cut = chosen.join(rounds.where("page = low").select(F.col("page").alias("next_page")), "next_page", "left_semi")
        chosen = written(chosen.join(cut, "page", "left_anti"), f"{folder}/uncircled")
        turning = rounds.select("page")
        inside = chosen.join(turning, "page", "left_semi").select("page", "next_page")
        inside = inside.join(turning.withColumnRenamed("page", "next_page"), "next_page", "left_semi")
        places = places.unionByName(ranked(turning, inside, total, f"{folder}/circles")[0])
    places = written(places, f"{folder}/places")
    target = places.select(F.col("page").alias("next_page"), F.col("path").alias("to_path"), F.col("place").alias("to_place"))
    ways = links.join(chosen.select("page"), "page", "left_anti").join(places, "page").join(target, "next_page")
    return places, written(ways.select("path", "to_path", "to_place"), f"{folder}/ways")


def stretches(seeds: DataFrame, places: DataFrame, ways: DataFrame, folder: str) -> DataFrame:
    """The walk from each seed as rows of paths: seed, path, ``first`` place, place to ``stop`` before, depth of the first."""
    lengths = written(places.groupBy("path").agg(F.count(F.lit(1)).alias("length")), f"{folder}/lengths")
    here = seeds.select(F.col("page").alias("seed"), "page").join(places, "page").join(lengths, "path").select(
        "seed", "path", F.col("place").alias("first"), F.col("length").alias("stop"), F.lit(0).cast("long").alias("depth"))
    found = here = written(here, f"{folder}/stretches-0")
    schema, number = here.schema, 0
    onward = ways.join(lengths.select(F.col("path").alias("to_path"), "length"), "to_path")
    while not here.isEmpty():
        number += 1
        around = F.col("to_path") == F.col("path")
        after = here.join(onward, "path").where(~around | (F.col("first") > 0)).select(
            "seed", F.col("to_path").alias("path"), F.col("to_place").alias("first"),
            F.when(around, F.col("first")).otherwise(F.col("length")).alias("stop"),
            (F.col("depth") + F.col("stop") - F.col("first")).alias("depth"), around.alias("around"))
        after = written(after, f"{folder}/stretches-{number}")
        found = found.unionByName(after.select(schema.names))
        here = after.where("NOT around").select(schema.names)
    return found


def follow_chain(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """seed, page and depth of every page a walk from each seed passes.

    ``seeds`` has page; ``links`` has page and next_page; of several links of a page the smallest counts,
    null leads nowhere. A seed without a link is a walk of one page, repeated seeds are one. A walk that runs
    into a circle ends at the first page it has seen before. Rounds are tables in the shared folder: log2(longest
    walk) of them place the pages, log2(pages) at most follow the walks; what is stored grows with pages plus seeds.
    """
    folder = fresh_folder(seeds.sparkSession, "chain")
    links = links.where("page IS NOT NULL AND next_page IS NOT NULL").groupBy("page").agg(F.min("next_page").alias("next_page"))
    links = written(links, f"{folder}/links")
    seeds = written(seeds.where("page IS NOT NULL").select("page").distinct(), f"{folder}/seeds")
    nodes = links.select(F.explode(F.array("page", "next_page")).alias("page")).unionByName(seeds).distinct()
    places, ways = placed(written(nodes, f"{folder}/nodes"), links, folder)
    walks = stretches(seeds, places, ways, folder)
    blocks = F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("stop") - 1) / BLOCK))
    passed = walks.withColumn("block", F.explode(blocks)).join(
        places.withColumn("block", F.floor(F.col("place") / BLOCK)), ["path", "block"])
    return passed.where("place >= first AND place < stop").select(
        "seed", "page", (F.col("depth") + F.col("place") - F.col("first")).alias("depth"))
