"""Spelling variants grouped over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols, so many words share a reduced word. The full neighbourhood of one
edit of every distinct reduced word is generated and joined with the reduced vocabulary: words one edit apart have
reduced words that are equal or one edit apart, so none is lost. Words whose reduced words met are verified on
the words themselves inside the join, and only true neighbours leave it. Reduced words are carried as 64-bit
values of a polynomial.

A word's form is its most frequent neighbour if that is at least ``RATIO`` times as frequent. Counts so
double at least from form to form: a chain of forms is at most log2 of the largest count long, has no circle, and its
end is found by doubling jumps over written tables.

Defined results: null and empty texts have no words; a null key counts as empty text where it seeds the
deletions; a repeated row counts again; no words give no rows; extra columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import Folder, fresh_folder, written

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: A word has so many letters and occurrences at least, a form so many times the occurrences.
LETTERS, OCCURRENCES, RATIO = 5, 3, 2
#: One run in so many loses a letter.
DELETED = 97
RUN = "[a-zÀ-ÿ]+"
#: An odd base of the polynomial that keys are values of, and keys made at once.
BASE, CHUNK = 0x9E3779B97F4A7C15, 1_000_000


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", deleted: int = DELETED) -> DataFrame:
    """``word``, ``n`` of all words: runs of letters, A-Z in lower case, one in ``deleted`` short of a letter.

    The crc32 of key and run decides which run loses a letter, and which letter.
    """
    lower = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
                       F.explode_outer(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    # Without "outer" the planner tests whether there are runs before it finds them, by finding them.
    runs = runs.where(F.length("run") >= LETTERS)
    chosen = runs.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    found = chosen.select(F.when(F.col("h") % deleted == 0, shorter).otherwise(F.col("run")).alias("word"))
    return found.where(F.length("word") >= LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def by_length(texts: list[str]):
    """(rows, symbols) of the words of each length; symbols count from 1."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for size in np.unique(sizes).tolist():
        (rows,) = np.nonzero(sizes == size)
        letters = np.frombuffer("".join(texts[i] for i in rows).encode("utf-32-le"), np.uint32).reshape(-1, size)
        yield rows, letters.astype(np.uint64) % np.uint64(SYMBOLS) + np.uint64(1)


def powers(size: int) -> np.ndarray:
    made = np.full(size + 3, BASE, np.uint64)
    made[0] = 1
    return np.cumprod(made, dtype=np.uint64)


def own_keys(symbols: np.ndarray) -> np.ndarray:
    """The key of each reduced word."""
    size = symbols.shape[1]
    return (symbols * powers(size)[:size][::-1]).sum(1, dtype=np.uint64)


def neighbour_keys(symbols: np.ndarray):
    """(row, key) of the reduced words and of all that are one edit from them, each once.

    Of equal neighbours only the first edit that gives them is made: a symbol is neither deleted nor inserted
    behind one like it, nor replaced by itself.
    """
    count, size = symbols.shape
    power, every = powers(size), np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    before = np.zeros((count, size + 1), np.uint64)  # the key of the symbols before a place
    after = np.zeros((count, size + 2), np.uint64)  # what the symbols from a place on add to a key
    for i in range(size):
        before[:, i + 1] = before[:, i] * power[1] + symbols[:, i]
    for i in range(size - 1, -1, -1):
        after[:, i] = after[:, i + 1] + symbols[:, i] * power[size - 1 - i]
    yield np.arange(count), after[:, 0]
    previous = np.concatenate([np.zeros((count, 1), np.uint64), symbols], axis=1)
    step = max(1, CHUNK // (count * SYMBOLS))
    for i in range(0, size + 1, step):
        ends = np.arange(i, min(i + step, size + 1))
        kept = before[:, ends] * power[size + 1 - ends] + after[:, ends]
        longer = kept[:, :, None] + every * power[size - ends][:, None]
        new = every != previous[:, ends][:, :, None]
        yield np.nonzero(new)[0], longer[new]
        at = ends[ends < size]
        if not len(at):
            continue
        new = symbols[:, at] != previous[:, at]
        yield np.nonzero(new)[0], (before[:, at] * power[size - 1 - at] + after[:, at + 1])[new]
        kept = before[:, at] * power[size - at] + after[:, at + 1]
        changed = kept[:, :, None] + every * power[size - 1 - at][:, None]
        new = every != symbols[:, at][:, :, None]
        yield np.nonzero(new)[0], changed[new]


def _own(batches):
    for batch in batches:
        keys = np.zeros(batch.num_rows, np.uint64)
        for rows, symbols in by_length(batch.column("word").to_pylist()):
            keys[rows] = own_keys(symbols)
        yield batch.append_column("key", pa.array(keys.view(np.int64)))


def _neighbours(batches):
    for batch in batches:
        own = batch.column("key").to_numpy()
        for rows, symbols in by_length(batch.column("word").to_pylist()):
            some = max(1, CHUNK // (symbols.shape[1] * 2 * SYMBOLS))
            for i in range(0, len(rows), some):
                for at, keys in neighbour_keys(symbols[i : i + some]):
                    key, met = own[rows[i + at]], keys.view(np.int64)
                    # Two reduced words are in each other's neighbourhood; the one with the smaller key brings the other.
                    found = key <= met
                    yield pa.RecordBatch.from_pydict({"key": key[found], "met": met[found]})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word``, ``other``, ``n`` of the other: all pairs that differ by one letter inserted, deleted or replaced.

    ``vocabulary`` has word, n and the ``key`` of the reduced word.
    """
    reduced = vocabulary.groupBy("key").agg(F.min("word").alias("word"))
    spread = reduced.mapInArrow(_neighbours, "key long, met long")
    met = spread.join(reduced.select(F.col("key").alias("met")), "met")
    there, back = F.struct("key", "met"), F.struct(F.col("met").alias("key"), F.col("key").alias("met"))
    met = met.select(F.inline(F.when(F.col("key") == F.col("met"), F.array(there)).otherwise(F.array(there, back))))
    others = vocabulary.select(F.col("key").alias("met"), F.col("word").alias("other"), "n")
    left = vocabulary.select("key", "word").join(met, "key")
    verified = (left["met"] == others["met"]) & (F.levenshtein("word", "other", 1) == 1)
    return left.join(others, verified).select("word", "other", "n")


def with_keys(vocabulary: DataFrame) -> DataFrame:
    """``word``, ``n`` and the ``key`` of the reduced word."""
    return vocabulary.select("word", "n").mapInArrow(_own, "word string, n long, key long")


def last_forms(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for (word, form): the end of the chain of forms, by doubling jumps."""
    spark = forms.sparkSession
    folder, number = fresh_folder(spark, "forms"), 0
    current = written(forms.select("word", F.col("form").alias("root")), f"{folder}/0")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        farther = current.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        number += 1
        current = written(farther, f"{folder}/{number}")
        Folder(spark, folder).remove(str(number - 1))
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``n``, ``form``, ``root``, ``n_near``, ``form_n`` of every word with enough letters and occurrences."""
    folder = fresh_folder(docs.sparkSession, "spelling")
    vocabulary = written(with_keys(words(docs, key, text).where(F.col("n") >= OCCURRENCES)), f"{folder}/words")
    # The most frequent first, then the first by code points.
    best = F.min(F.struct((-F.col("n")).alias("less"), "other")).alias("best")
    near = near_words(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = vocabulary.join(near, "word", "left")
    enough = -F.col("best.less") >= RATIO * F.col("n")
    found = written(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ), f"{folder}/near")
    roots = last_forms(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def oracle(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """The same by comparing all words of like length, in SQL."""
    letters, bytes_ = "".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, range(0x20, 0x60))).replace("'", "''")
    # Fixed value: the polynomial of crc32.
    bits = "xor(c >> 1, CASE WHEN (c & 1) = 1 THEN 3988292384 ELSE 0 END)"
    return f"""WITH RECURSIVE crc AS MATERIALIZED (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, x: {bits}) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)),
lowered AS (SELECT coalesce(CAST({key} AS VARCHAR), '') AS key, unnest(regexp_extract_all(
    translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-zÀ-ÿ]+')) AS run FROM {table}),
runs AS MATERIALIZED (SELECT key, run, count(*) AS times FROM lowered WHERE length(run) >= {LETTERS} GROUP BY ALL),
coded AS (SELECT run, times, hex(encode(key || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2),
    lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h FROM coded, crc),
cut AS (SELECT times, CASE WHEN h % {DELETED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n,
    translate(word, '{letters}', '{bytes_}') AS letters -- levenshtein compares bytes
    FROM cut WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(times) >= {OCCURRENCES}),
near AS (SELECT a.word, count(*) AS n_near, arg_min(b.word, (-b.n, encode(b.word))) AS other, max(b.n) AS most, any_value(a.n) AS n
    FROM (SELECT *, unnest([length(word) - 1, length(word), length(word) + 1]) AS size FROM words) a
    JOIN words b ON length(b.word) = a.size AND levenshtein(a.letters, b.letters) = 1 GROUP BY a.word),
forms AS MATERIALIZED (SELECT word, other AS form, most AS form_n FROM near WHERE most >= {RATIO} * n),
chain AS (SELECT word, form AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word),
roots AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT word, w.n, form, coalesce(root, word) AS root, coalesce(n_near, 0) AS n_near, form_n
FROM words w LEFT JOIN (SELECT word, n_near FROM near) USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)"""
