"""Mix sources to target weights, in blocks of words.

1. Every source's words are one stream: documents in an order fixed by a hash of
   their id, cut into blocks of ``BLOCK`` words. A document's place in the stream is
   a sum over buckets plus a sum within its bucket, so a hot source is spread.
2. Targets: sources in code point order, null last, get repeating weights and share
   all words; no source gets more than ``LIMIT`` times its size, the excess goes to
   the others by weight until none is above.
3. A source gets as many slots as its target holds blocks. Each output shard draws how many
   of its slots go to each source: a multinomial draw by the slots of the sources. A source that has
   been drawn for all its slots gets no more in later shards, and the places this leaves go to the
   sources that were drawn too rarely, so that every total is met.
4. The counts of a source in the shards number its slots. Slot ``t`` takes block ``permutation(t mod blocks)`` in
   pass ``t div blocks``; slots and blocks meet in a join by source and block index.

Running sums go over chunks first, then within a chunk, so no source, and not the list of sources, is one task.

Everything is DataFrame expressions. Permutations are swap-or-not shuffles, which
permute any range exactly.

Defined results: null texts have no words; documents without words and sources
without words take nothing; an empty table gives no rows; repeated rows (also with
null ids) are separate documents, ordered by hash; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.tables import apart
from tidemark.workspace import fresh_folder, written

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK = 64
#: Slots in an output shard, slots that one row stands for before they are listed, and shards summed in one group.
SHARD, RUN, CHUNK = 4096, 8192, 4096
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 24


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def permuted(value: Column, size: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 … size-1 that depends on ``key``: each round pairs
    the values by a sum and swaps a pair or not, as a hash of its greater value says."""
    def swap(x, r):
        other = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        swaps = F.xxhash64(*key, r, F.greatest(x, other)) > 0
        return F.when(swaps, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), value, swap)


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_order(rows: DataFrame, folder: str, *order: Column) -> DataFrame:
    """``rows`` in chunks of one range each, by number."""
    spread = rows.repartitionByRange(tasks(rows), *order).withColumn("chunk", F.spark_partition_id())
    return written(spread, folder)


def running(rows: DataFrame, keys: list[str], order: list[Column], **sums: Column) -> DataFrame:
    """``rows``, which have ``chunk``, with the sums over all earlier rows of the same keys; those of a chunk follow ``order``."""
    totals = rows.groupBy(*keys, "chunk").agg(*[F.sum(c).alias(f"{n}_sum") for n, c in sums.items()])
    ahead = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "chunk", *[F.coalesce(F.sum(f"{n}_sum").over(ahead), F.lit(0)).alias(f"{n}_base") for n in sums])
    within = Window.partitionBy(*keys, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumns({f"{n}_inner": F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()})
    joined = found.join(bases, [*keys, "chunk"])
    return joined.select(*rows.columns, *[(F.col(f"{n}_base") + F.col(f"{n}_inner")).alias(n) for n in sums])


def targets(sizes: DataFrame, weights=WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with ``ix`` and ``target``.

    The level at which all targets add up to all words is the greatest of the levels
    found by taking the sources with the smallest limits as full, one after another.
    """
    folder, name = fresh_folder(sizes.sparkSession, "mixing-targets"), F.col("source").asc_nulls_last()
    numbered = running(in_order(sizes.select("source", "source_size"), f"{folder}/sources", name), [], [name], ix=F.lit(1))
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("ix") % len(weights)).cast("int")).cast("double")
    limits = numbered.select(
        "source", "source_size", F.col("ix").cast("long").alias("ix"), weight.alias("weight"),
        (F.col("source_size") * F.lit(limit)).cast("double").alias("cap"))
    by_limit = [F.col("cap") / F.col("weight"), F.col("ix")]
    limits = in_order(limits, f"{folder}/limits", *by_limit)
    whole = limits.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    full = running(limits, [], by_limit, full=F.col("cap"), used=F.col("weight"))
    at = (F.lit(whole["words"] or 0) - F.col("full")) / (F.lit(whole["weights"] or 0.0) - F.col("used"))
    level = full.agg(F.max(at)).first()[0] or 0.0
    return limits.select("source", "source_size", "ix", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def placed(docs: DataFrame, weights=WEIGHTS, limit: float = LIMIT, block: int = BLOCK,
           key: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Documents with size and place in their source's stream (``start``), and the table of sources."""
    spark = docs.sparkSession
    folder = fresh_folder(spark, "mixing")
    rows = written(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), words_in(text).alias("size"),
        F.xxhash64(F.col(text)).alias("text_hash")), f"{folder}/rows")
    buckets = max(16, int(rows.count() ** 0.5))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    n_blocks = F.ceil(F.col("source_size") / block)
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * n_blocks / F.col("source_size"))).otherwise(0)
    shares = targets(sizes, weights, limit).withColumn("blocks", n_blocks).withColumn("slots", slots.cast("long"))
    shares = in_order(shares, f"{folder}/shares", F.col("ix"))
    shares = written(running(shares, [], [F.col("ix")], first_slot=F.col("slots")), f"{folder}/sources")
    known = rows.join(shares.select(F.col("source").alias("name"), "ix"), F.col("source").eqNullSafe(F.col("name")))
    known = known.drop("name").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    starts = running(known.withColumnRenamed("bucket", "chunk"), ["ix"], [F.col("doc_id"), F.col("text_hash")], start=F.col("size"))
    return starts.select("doc_id", "source", "text_hash", "size", "ix", "start"), shares


def listed(rows: DataFrame, first: str, n: str, name: str) -> DataFrame:
    """Each row ``n`` times, numbered from ``first`` on as ``name``; runs spread over all tasks before they are listed."""
    runs = rows.where(F.col(n) > 0).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / RUN))))
    last = F.least(F.col(n), (F.col("run") + 1) * RUN) - 1
    return runs.repartition(tasks(rows), F.col(first), F.col("run")).withColumn(
        name, F.explode(F.sequence(F.col(first) + F.col("run") * RUN, F.col(first) + last))).drop("run")


def draws(shares: DataFrame, folder: str) -> DataFrame:
    """How many slots of each shard go to each source: shard, ix, ``n``; the counts of a source add up to its slots.

    Every place of a shard draws a slot of all sources, with repeats, so the sources of a shard are drawn by their
    share of the slots. What a source is drawn beyond its slots is left to the sources that lack some.
    """
    total = shares.agg(F.sum("slots")).first()[0] or 0
    owners = listed(shares.select("ix", "slots", "first_slot"), "first_slot", "slots", "picked").select("ix", "picked")
    places = shares.sparkSession.range(0, total, 1, tasks(shares)).select(
        F.floor(F.col("id") / SHARD).alias("shard"), F.pmod(F.xxhash64(F.lit(SEED), F.lit("draw"), "id"), F.lit(max(1, total))).alias("picked"))
    chunk = F.floor(F.col("shard") / CHUNK).alias("chunk")
    drawn_for = written(places.join(owners.hint("merge"), "picked").groupBy("shard", "ix").agg(F.count("*").alias("drawn")).select(
        "*", chunk), f"{folder}/drawn")
    so_far = running(drawn_for, ["ix"], [F.col("shard")], before=F.col("drawn")).join(shares.select("ix", "slots"), "ix")
    kept = F.greatest(F.lit(0), F.least(F.col("drawn"), F.col("slots") - F.col("before")))
    kept = written(so_far.select("shard", "chunk", "ix", "drawn", kept.alias("n")), f"{folder}/kept")
    free = kept.groupBy("chunk", "shard").agg(F.sum(F.col("drawn") - F.col("n")).alias("free")).where("free > 0")
    free = listed(running(free, [], [F.col("shard")], first=F.col("free")), "first", "free", "number").select("shard", "number")
    got = kept.groupBy("ix").agg(F.sum("n").alias("got"))
    lack = shares.join(got, "ix", "left").select("ix", "chunk", (F.col("slots") - F.coalesce("got", F.lit(0))).alias("lack")).where("lack > 0")
    lack = listed(running(lack, [], [F.col("ix")], first=F.col("lack")), "first", "lack", "number").select("ix", "number")
    given = free.join(lack.hint("merge"), "number").groupBy("shard", "ix").agg(F.count("*").alias("n"))
    every = kept.where("n > 0").select("shard", "ix", "n").unionByName(given).groupBy("shard", "ix").agg(F.sum("n").alias("n"))
    return written(every.select("*", chunk), f"{folder}/counts")


def drawn(shares: DataFrame) -> DataFrame:
    """All slots: ``ix``, ``block_ix``, ``pass``, and the ``shard`` and ``slot`` they go to, by the drawn counts.

    Their number does not show in the small table they come from, so what joins them
    names ``merge``; else they would be broadcast.
    """
    counts = draws(shares, fresh_folder(shares.sparkSession, "mixing-draws"))
    within = Window.partitionBy("shard").orderBy("ix")
    placed_in = counts.withColumn("inner", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).withColumn(
        "shard_slots", F.sum("n").over(Window.partitionBy("shard")))
    numbered = running(placed_in, ["ix"], [F.col("shard")], first=F.col("n")).join(shares.select("ix", "blocks"), "ix")
    # The sums leave a chunk of a source in one task; its slots are many times as many rows.
    slots = numbered.repartition(tasks(shares), "ix", "shard").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    t = F.col("first") + F.col("k")
    turn = F.floor(t / F.col("blocks"))
    return slots.select(
        "ix", permuted(F.pmod(t, F.col("blocks")), F.col("blocks"), F.lit(SEED), F.col("ix"), turn).alias("block_ix"),
        turn.alias("pass"), "shard",
        permuted(F.col("inner") + F.col("k"), F.col("shard_slots"), F.lit(SEED), F.lit("slot"), F.col("shard")).alias("slot"),
    )


def parts(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The blocks that each document with words reaches into: ``block_ix``, ``first`` word, ``words``."""
    end = F.col("start") + F.col("size")
    cut = rows.where("size > 0").withColumn(
        "block_ix", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    first = F.greatest(F.col("start"), F.col("block_ix") * block)
    return cut.withColumn("first", first - F.col("start")).withColumn(
        "words", F.least(end, (F.col("block_ix") + 1) * block) - first)


def mixture(docs: DataFrame, weights=WEIGHTS, limit: float = LIMIT, block: int = BLOCK, **columns) -> DataFrame:
    """What the output shards hold: shard, slot, pass, and the words of which document (doc_id,
    text_hash, ix, start) from ``first`` on. A slot that crosses documents has a row for each."""
    rows, shares = placed(docs, weights, limit, block, **columns)
    return parts(rows, block).join(drawn(shares).hint("merge"), ["ix", "block_ix"])


def taken_words(docs: DataFrame, weights=WEIGHTS, limit: float = LIMIT, block: int = BLOCK, **columns) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and words the mixture takes."""
    rows, shares = placed(docs, weights, limit, block, **columns)
    rows = written(rows, fresh_folder(docs.sparkSession, "mixing-rows"))
    times = drawn(shares).groupBy("ix", "block_ix").agg(F.count("*").alias("times"))
    each = parts(rows, block).join(times.hint("merge"), ["ix", "block_ix"], "left").groupBy("ix", "start", "doc_id", "size").agg(
        F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    none = rows.where("size = 0").select("ix", "start", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return each.unionByName(none).join(shares.select("ix", "source_size", "target"), "ix").select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, limit: float = LIMIT, block: int = BLOCK) -> DataFrame:
    """The columns of ``docs``, a row for each pass that takes words of a document: the whole text if
    the pass takes all of it, else the taken words with single spaces. ``n_chars``, if there, is recounted."""
    docs, named = apart(docs, "doc_id", "text", "source", "n_chars")
    mixed = mixture(docs, weights, limit, block)
    ranges = F.sort_array(F.collect_list(F.struct("first", "words")))
    rows = mixed.groupBy("ix", "start", "pass", "doc_id", "text_hash", "size").agg(
        ranges.alias("ranges"), F.sum("words").alias("taken"))
    rows = rows.select(F.col("doc_id").alias("_mix_id"), F.col("text_hash").alias("_mix_hash"),
                       F.col("ranges").alias("_mix_ranges"), (F.col("taken") == F.col("size")).alias("_mix_whole"))
    hashed = docs.withColumn("_mix_text", F.xxhash64("text"))
    ids = docs.select("doc_id", F.xxhash64("text").alias("h"))
    if not ids.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        hashed = hashed.dropDuplicates(["doc_id", "_mix_text"])
    both = hashed.join(rows, F.col("doc_id").eqNullSafe(F.col("_mix_id")) & (F.col("_mix_text") == F.col("_mix_hash")))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    some = F.array_join(F.flatten(F.transform("_mix_ranges", lambda r: F.slice(
        words, (r["first"] + 1).cast("int"), r["words"].cast("int")))), " ")
    text = F.when(F.col("_mix_whole"), F.col("text")).otherwise(some)
    out = both.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return named(out)
