"""Language of texts: script ranges narrow the candidates, Viterbi labels spans.

Each word has a score per language (character trigrams and the whole word,
learned from labelled texts). Scripts that a language does not use exclude it
for a word. A path through the words that pays a penalty for every switch of
language gives the spans of a text; its language is the one with most letters.

Defined results: null text or text without a letter is ``und`` with score 0 and
no spans; an empty training table makes every text ``und``; ties go to the
language that sorts first; repeated rows are labelled alike; extra columns are
ignored in training and kept by ``label``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import add_columns, pieces, share_of, with_small_batches

#: Documents per language that training reads, in expectation.
SAMPLE_PER_LANGUAGE = 3000
#: Languages a model can hold; more raise an error. With the buckets this bounds the broadcast model.
MAX_LANGUAGES = 256
BUCKETS = 1 << 16
#: Smallest share of a language's letters that makes a script its own.
SCRIPT_SHARE = 0.01
#: A word counts for at most this much against a language; a switch costs SWITCH.
FLOOR, SWITCH = 6.0, 14.0
UNKNOWN = "und"
MAX_CACHED = 150_000

# First code point of each script block; letters up to the next one belong to it.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
    (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"),
    (0x32000, "Other"),
]
NAMES = sorted({name for _, name in SCRIPTS})
STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_OF_BLOCK = np.array([NAMES.index(name) for _, name in SCRIPTS])

WORDS = re.compile(r"[^\W\d_]+")

SPANS = "array<struct<start: int, end: int, lang: string, letters: int>>"


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return low


def features(word: str) -> set[int]:
    padded = f"^{word}$"
    parts = {padded[i : i + 3] for i in range(len(padded) - 2)} | {f"={word}"}
    return {zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts}


def scripts(words: list[str]) -> np.ndarray:
    """Script of each word, by its first character."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return SCRIPT_OF_BLOCK[np.searchsorted(STARTS, first, "right") - 1]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language, log probability
    uses: np.ndarray  # script x language, whether the language is written so


def count_features(batches):
    """Counts of one task: (lang, bucket, n); scripts follow the buckets."""
    words: dict[str, Counter] = defaultdict(Counter)
    totals: dict[str, np.ndarray] = {}

    def flush():
        for lang, counted in words.items():
            total = totals.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
            listed = list(counted)
            for word, script in zip(listed, scripts(listed)):
                total[BUCKETS + script] += counted[word] * len(word)
                for bucket in features(word):
                    total[bucket] += counted[word]
        words.clear()

    for batch in batches:
        for piece in pieces(batch, "text"):
            for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
                words[lang].update(WORDS.findall(lowered(text)))
            if sum(map(len, words.values())) > MAX_CACHED:
                flush()
    flush()
    for lang, total in totals.items():
        (at,) = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()),
            "n": pa.array(total[at], pa.int64()),
        })


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from about ``per_language`` rows of each language, chosen by a hash of the key.

    Rows with null text or language are ignored. What the driver receives is bounded
    by buckets times languages, whatever the size of the table.
    """
    rows = labelled.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:  # nothing to learn from
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    languages = sorted(r["lang"] for r in sizes)
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]))))
    sample = rows.where(F.coalesce(share_of("key"), F.lit(0.0)) < share[F.col("lang")]).select("lang", "text")
    counts = with_small_batches(sample).mapInArrow(count_features, "lang string, bucket int, n long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros((BUCKETS + len(NAMES), len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    totals[found["bucket"].to_numpy(), [place[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    grams, letters = totals[:BUCKETS], totals[BUCKETS:]
    smooth = 0.5
    weights = np.log(grams + smooth) - np.log(grams.sum(0) + smooth * BUCKETS)
    uses = letters >= np.maximum(SCRIPT_SHARE * letters.sum(0), 1)
    return Model(languages, weights.astype(np.float32), uses)


def best_path(scores: np.ndarray, first: np.ndarray, switch: float, lane: int = 256) -> np.ndarray:
    """Viterbi over words times languages; a change costs ``switch``, none where a text begins.

    The words of many texts follow each other. They are cut into lanes of equal length
    that advance side by side: once from every entry language to link the lanes, once
    to record the steps, and once backwards.
    """
    n, k = scores.shape
    if n == 0 or k < 2:
        return np.zeros(n, np.int64)
    lanes = -(-n // lane)
    padded = np.zeros((lanes * lane, k))
    padded[:n] = scores
    cost = np.full(lanes * lane, switch)
    cost[:n][first] = 0.0
    padded, cost = padded.reshape(lanes, lane, k), cost.reshape(lanes, lane)
    table = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(lanes, 0)
    for t in range(lane):
        best = table.max(2, keepdims=True) - cost[:, t, None, None]
        table = np.maximum(table, best) + padded[:, t, None, :]
    entry = np.zeros((lanes, k))
    came = np.zeros((lanes, k), np.int64)  # the entry language that leads to each exit language
    value = np.zeros(k)
    for b in range(lanes):
        entry[b] = value
        ways = value[:, None] + table[b]
        came[b] = ways.argmax(0)
        value = ways.max(0)
        value = value - value.max()
    leaves = np.zeros(lanes, np.int64)
    leaves[-1] = value.argmax()
    for b in range(lanes - 1, 0, -1):
        leaves[b - 1] = came[b, leaves[b]]
    value = entry
    stays = np.zeros((lane, lanes, k), bool)
    tops = np.zeros((lane, lanes), np.int64)
    for t in range(lane):
        tops[t] = value.argmax(1)
        best = value.max(1, keepdims=True) - cost[:, t, None]
        stays[t] = value >= best
        value = np.maximum(value, best) + padded[:, t]
    path = np.zeros((lanes, lane), np.int64)
    at, rows = leaves, np.arange(lanes)
    for t in range(lane - 1, -1, -1):
        path[:, t] = at
        at = np.where(stays[t, rows, at], at, tops[t])
    return path.reshape(-1)[:n]


class Seen(dict):
    """Words numbered in the order they come."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Scorer:
    """Scores of words under a model, kept for words already met in this task."""

    def __init__(self, model: Model):
        self.model, self.seen, self.done = model, Seen(), 0
        self.scores = np.zeros((1024, len(model.languages)), np.float32)
        self.letters = np.zeros(1024, np.int32)

    def number(self, words: list[str]) -> np.ndarray:
        if len(self.seen) > MAX_CACHED:
            self.seen, self.done = Seen(), 0
        found = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        if len(self.seen) > self.done:
            self._score(list(self.seen)[self.done :])
        return found

    def _score(self, words: list[str]) -> None:
        start, end = self.done, self.done + len(words)
        while end > len(self.letters):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        listed = [list(features(w)) for w in words]
        cuts = np.cumsum([0] + [len(x) for x in listed[:-1]])
        flat = np.fromiter((x for one in listed for x in one), np.int64)
        sums = np.add.reduceat(self.model.weights[flat], cuts, axis=0)
        uses = self.model.uses[scripts(words)]
        sums = np.where(uses, sums, -np.inf)
        top = sums.max(1, keepdims=True)
        known = np.isfinite(top)
        gap = np.where(known, sums - np.where(known, top, 0), 0)
        self.scores[start:end] = np.maximum(gap, -FLOOR)
        self.letters[start:end] = [sum(map(str.isalpha, w)) for w in words]
        self.done = end


def spans_of(texts: list[str], scorer: Scorer):
    """Per text: language, share of its letters, and spans (start, end, lang, letters)."""
    languages = scorer.model.languages
    if not languages:
        yield from ((UNKNOWN, 0.0, []) for _ in texts)
        return
    low = [lowered(t) for t in texts]
    found = [WORDS.findall(t) for t in low]
    sizes = np.array([len(f) for f in found], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    numbers = scorer.number([w for f in found for w in f])
    letters = scorer.letters[numbers]
    first = starts[sizes > 0]
    path = best_path(scorer.scores[numbers].astype(np.float64), first, SWITCH)
    for text, lower, a, b in zip(texts, low, starts, ends):
        total = int(letters[a:b].sum())
        if not total:
            yield UNKNOWN, 0.0, []
            continue
        own, counted = path[a:b], letters[a:b]
        shares = np.bincount(own, counted, len(languages))
        top = int(shares.argmax())
        cuts = np.flatnonzero(np.diff(own)) + 1
        offsets = [0]
        if len(cuts):
            places = [m.start() for m in WORDS.finditer(lower)]
            offsets += [places[c] for c in cuts]
        sums = np.add.reduceat(counted, np.concatenate([[0], cuts]))
        spans = [
            {"start": s, "end": e, "lang": languages[own[c]], "letters": int(n)}
            for s, e, c, n in zip(offsets, [*offsets[1:], len(text)], [0, *cuts], sums)
        ]
        yield languages[top], float(shares[top] / total), spans


def label(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``lang_score`` (share of letters), ``lang_spans``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def work(texts):
            return list(zip(*spans_of([t or "" for t in texts], scorer)))

        return work

    return add_columns(docs, text, f"lang_pred string, lang_score double, lang_spans {SPANS}", make)


def accepted(min_share: float = 0.3) -> Column:
    """Whether a labelled text has one language for at least this share of its letters."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= min_share)
