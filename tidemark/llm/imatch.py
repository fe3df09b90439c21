"""I-Match fingerprints with randomised lexicons.

The lexicon is what lies in a band of inverse document frequency, counted for every word over
all documents. A term is a 61-bit hash of its word. Both ends of the band are shares of the
documents, so the lexicon has at most the mean number of distinct terms of a document, divided by
the smaller share, whatever the number of documents and of words. A text's
distinct terms in the lexicon, sorted, are hashed whole and once for each of several
random subsets of the lexicon. There are ``PER_SIZE`` subsets of each size; the largest share the
lexicon out among them, the next half of it, and so on: the small ones leave a long text
few terms and still agree after an edit.

A fingerprint is the hash of the whole (16 hex digits) and one of 12 bits, two characters, for each
subset; ``--`` where a subset leaves no term. Likeness is the share of equal hashes among small
subsets that leave a term in either, which estimates the share of common terms.

Defined results: null and empty texts have the fingerprint of no terms; a text whose
terms all lie outside the band uses all its terms; two fingerprints without terms are alike
(1.0), one without terms and one with are not (0.0); equal texts have equal fingerprints; an empty table
gives no rows; extra columns pass through ``fingerprinted`` and are dropped by ``edited``.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.tables import ARROW, add_columns, pieces, with_small_batches
from tidemark.workspace import fresh_folder

#: Terms in more than this share of the documents, in less than this share, or in fewer documents than this are outside the band.
MOST_SHARE, LEAST_SHARE, LEAST_DOCUMENTS = 0.1, 1e-5, 2
#: Terms with counts that a task holds before it adds them up.
HELD = 2_000_000
#: Counts travel in rows of one range of terms each, the first 13 bits: a term then takes 6 bytes and its count.
RANGES = 1 << 13
#: At each size a term is in one of the subsets or, but for the largest size, in none; ``PER_SIZE`` is a power of two.
SIZES, PER_SIZE = 10, 16
SEED = 42
#: Characters cut into words at once.
CUT_CHARS = 2_000_000
BETWEEN = r"[^\p{L}\p{N}_]+"
NO_TERM = "--"
DIGITS = len(NO_TERM)
CHARACTERS = string.ascii_letters + string.digits + "+/"
CODES = [a + b for a in CHARACTERS for b in CHARACTERS]


def terms_of(texts: list[str | None]) -> list[np.ndarray]:
    """Distinct terms of each text in ascending order. Only the distinct words of a batch reach Python."""
    low = pc.utf8_lower(pc.fill_null(pa.array(texts, pa.string()), ""))
    cut = pc.split_pattern_regex(low, BETWEEN)
    distinct = cut.flatten().dictionary_encode()
    digest = xxhash.xxh64_intdigest
    if not texts:
        return []
    words = distinct.dictionary.to_pylist()
    values, number = np.unique(np.array([digest(w.encode(), SEED) >> 3 for w in words], np.int64), return_inverse=True)
    at = distinct.indices.to_numpy()
    # Cutting leaves the empty word at the ends of a text.
    full = np.array([bool(w) for w in words])[at]
    counts = pc.list_value_length(cut).to_numpy()
    pairs = (np.repeat(np.arange(len(counts)), counts) * len(values) + number[at])[full]
    pairs.sort()
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    return np.split(values[pairs % len(values)], np.searchsorted(pairs, np.arange(1, len(counts)) * len(values)))


def _count(batches):
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added_up() -> tuple[np.ndarray, np.ndarray]:
        terms, place = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        return terms, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)

    def rows():
        terms, counts = held.pop()
        starts = np.searchsorted(terms, np.arange(RANGES + 1) << 48).astype(np.int32)
        (some,) = np.nonzero(np.diff(starts))
        offsets = pa.array([*starts[some], len(terms)], pa.int32())
        parts = (terms >> 32).astype(np.int16), terms.astype(np.int32), counts.astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(pa.ListArray.from_arrays(offsets, pa.array(p)) for p in parts)],
            ["range", "high", "low", "n"])

    for batch in batches:
        for piece in pieces(batch, "text", CUT_CHARS):
            held.append(np.unique(np.concatenate(terms_of(piece.column("text").to_pylist())), return_counts=True))
            if sum(len(t) for t, _ in held) > HELD:
                held[:] = [added_up()]
                if len(held[0][0]) > HELD // 2:
                    yield rows()
    if held:
        held[:] = [added_up()]
        yield rows()


class Lexicon:
    """The terms of the band in ascending order."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms

    def keep(self, terms: np.ndarray) -> np.ndarray:
        if not len(terms) or not len(self.terms):
            return terms
        place = np.searchsorted(self.terms, terms)
        place[place == len(self.terms)] = 0
        inside = terms[self.terms[place] == terms]
        return inside if len(inside) else terms


def lexicon(docs: DataFrame, text: str = "text", most_share: float = MOST_SHARE,
            least_share: float = LEAST_SHARE, least: int = LEAST_DOCUMENTS) -> Lexicon:
    """Count the documents of each term over all documents.

    What reaches the driver and the tasks are the terms of the band, 8 bytes each. As each lies in at least
    ``least_share`` of the documents, there are at most 1 / ``least_share`` times the mean number of terms of a document.
    """
    counted = with_small_batches(docs).select(F.col(text).alias("text")).mapInArrow(
        _count, "range int, high array<short>, low array<int>, n array<int>")
    # One shuffle: terms are grouped where their range is.
    single = counted.repartition("range").select("range", F.inline(F.arrays_zip("high", "low", "n")))
    total = docs.count()
    fewest = max(least, least_share * total)
    band = single.groupBy("range", "high", "low").agg(F.sum("n").alias("n")).where(
        F.col("n").between(fewest, max(fewest, most_share * total)))
    high, low = F.col("high").cast("long").bitwiseAND(F.lit(0xFFFF)), F.col("low").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    term = F.shiftleft(F.col("range").cast("long"), 48) + F.shiftleft(high, 32) + low
    return Lexicon(np.sort(band.select(term.alias("term")).toArrow()["term"].to_numpy()))


def mixed(values: np.ndarray) -> np.ndarray:
    """splitmix64"""
    x = (values + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def members(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(subset, place of the term), by subset and in the order of the terms. At size j a term's bits
    choose among PER_SIZE times 2^j places, of which the first PER_SIZE are subsets."""
    halves = [mixed(terms.astype(np.int64).view(np.uint64) * np.uint64(2) + np.uint64(i)) for i in (0, 1)]
    subsets, places, used = [], [], [0, 0]
    for size in range(SIZES):
        width = PER_SIZE.bit_length() - 1 + size
        half = size % 2
        choice = (halves[half] >> np.uint64(used[half])) & np.uint64((1 << width) - 1)
        used[half] += width
        (inside,) = np.nonzero(choice < PER_SIZE)
        subsets.append(choice[inside].astype(np.int64) + size * PER_SIZE)
        places.append(inside)
    subsets, places = np.concatenate(subsets), np.concatenate(places)
    order = np.argsort(subsets, kind="stable")
    return subsets[order], places[order]


def fingerprint(terms: np.ndarray) -> str:
    """Hashes of sorted distinct terms: of all, then of each subset, size by size."""
    terms = terms.astype("<i8")
    parts = [NO_TERM] * (SIZES * PER_SIZE)
    if len(terms):
        subset, place = members(terms)
        chosen, width = terms[place].tobytes(), terms.itemsize
        (cuts,) = np.nonzero(np.diff(subset, prepend=-1))
        for one, a, b in zip(subset[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(subset)]):
            parts[one] = CODES[xxhash.xxh32_intdigest(chosen[a * width : b * width], one) & 0xFFF]
    return xxhash.xxh64_hexdigest(terms.tobytes(), SEED) + "".join(parts)


def likeness(one: str, other: str) -> float:
    """From 0 to 1, by the subsets small enough that some leave no term, or by the smallest."""
    if one == other:
        return 1.0
    equal = held = 0
    for size in range(SIZES):
        start = 16 + size * PER_SIZE * DIGITS
        places = range(start, start + PER_SIZE * DIGITS, DIGITS)
        pairs = [(one[i : i + DIGITS], other[i : i + DIGITS]) for i in places]
        some = [p for p in pairs if p != (NO_TERM, NO_TERM)]
        if 8 * len(some) <= 7 * PER_SIZE or size == SIZES - 1 and not held:
            held += len(some)
            equal += sum(a == b for a, b in some)
    return equal / held if held else 0.0


def fingerprinted(docs: DataFrame, known: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with ``imatch``: the fingerprint of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def make():
        return lambda texts: [[fingerprint(shared.value.keep(t)) for t in terms_of(texts)]]

    return add_columns(docs, text, "imatch string", make)


RESULT = ("key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
#: kind 0: finished; 1: the last text of a task, which lacks the next one; 2: the first text of a task.
STEP = f"{RESULT}, kind int, part int, text string"


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Comparer:
    def __init__(self, known: Lexicon):
        self.known = known

    def prints(self, texts: list[str]) -> list[str]:
        return [fingerprint(self.known.keep(t)) for t in terms_of(texts)]

    def rows(self, keys: list, texts: list[str], own: list[str], following: list[str], followers: list[str]) -> list[tuple]:
        """Results for texts, each with the text that follows; ``own`` and ``followers`` are their fingerprints."""
        changed = [edit(t, f) for t, f in zip(texts, following)]
        found = []
        for key, text, mine, new, new_print, follower in zip(keys, texts, own, changed, self.prints(changed), followers):
            digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
            found.append((key, len(text), digest, mine, new_print, likeness(mine, new_print), likeness(mine, follower)))
        return found


STEP_TYPES = pa.schema([(name, ARROW[kind.replace("long", "bigint")]) for name, kind in (
    field.split() for field in STEP.split(", "))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), STEP_TYPES)], schema=STEP_TYPES)


def _in_order(shared):
    def run(batches):
        comparer, part, last = Comparer(shared.value), TaskContext.get().partitionId(), None
        empty = (None,) * 6
        for batch in batches:
            for piece in pieces(batch, "text", CUT_CHARS):
                keys, texts = piece.column("key").to_pylist(), piece.column("text").to_pylist()
                prints = comparer.prints(texts)
                if last is None:
                    yield _batch([(keys[0], *empty, 2, part, texts[0])])
                else:
                    keys, texts, prints = [last[0], *keys], [last[1], *texts], [last[2], *prints]
                rows = comparer.rows(keys[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
                if rows:
                    yield _batch([(*r, 0, None, None) for r in rows])
                last = keys[-1], texts[-1], prints[-1]
        if last is not None:
            yield _batch([(last[0], *empty, 1, part, last[1])])

    return run


def _across(shared):
    def run(batches):
        comparer = Comparer(shared.value)
        for batch in batches:
            keys, texts, following = (batch.column(c).to_pylist() for c in ("key", "text", "following"))
            for i in range(len(keys)):
                one, after = [texts[i]], [following[i]]
                rows = comparer.rows([keys[i]], one, comparer.prints(one), after, comparer.prints(after))
                yield _batch([(*r, 0, None, None) for r in rows])

    return run


def edited(docs: DataFrame, known: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against its edited text and the next text by key (equal keys by text; after the last the first).

    Tasks hold ranges of keys in order; only the first and last text of each are joined again.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)
    rows = with_small_batches(docs).select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    path = fresh_folder(spark, "imatch")
    # Digests are text of few different characters, which zstd stores in fewer bits.
    ordered.mapInArrow(_in_order(shared), STEP).write.option("compression", "zstd").parquet(path)
    step = spark.read.schema(STEP).parquet(path)
    firsts = step.where("kind = 2").select("part", F.col("text").alias("following"))
    turn = firsts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"))  # a row per task
    turn = turn.withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy())))
    ends = step.where("kind = 1").select("key", "text", "part").join(turn, "part").join(
        firsts.withColumnRenamed("part", "next"), "next").select("key", "text", "following")
    both = step.where("kind = 0").unionByName(ends.mapInArrow(_across(shared), STEP))
    return both.drop("kind", "part", "text").withColumnRenamed("key", key)
