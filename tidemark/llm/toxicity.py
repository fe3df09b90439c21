"""Toxicity of texts: a weighted lexicon found by Aho-Corasick in folded text.

Folding maps every character to one character: case, accents, look-alike letters
of other scripts, full-width, mathematical and enclosed letters and digits used as letters
become plain Latin letters; all that is no letter or digit becomes a space, and
invisible characters and combining marks, such as separate accents and overlays,
are removed. Terms are whole words or beginnings of words,
so each pattern starts with a space. A match inside an exception phrase (the word,
with its neighbour before, after, or both) does not count. The matched weights,
in total and per length, give the score by a logistic curve.

Defined results: null and empty texts have no match and get the score of a text
without matches; with no labelled rows the lexicon is empty and every score is
``PRIOR``; repeated rows score alike; extra columns pass through.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from functools import cache, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import add_columns, pieces, share_of, with_small_batches

#: Labelled rows that training reads, in expectation; terms and exceptions the lexicon holds at most.
SAMPLE_ROWS, MAX_TERMS = 20_000, 5_000
#: Share of the sample that the lexicon is learned from; the rest sets the curve.
LEXICON_SHARE = 0.7
PREFIXES = range(4, 7)
#: Likelihood ratio a term needs, and the log odds.
MIN_RATIO, MIN_WEIGHT = 16.0, 1.5
#: A document counts for terms of at least this part of its strongest ratio; of these documents this part is toxic.
STRONGEST, MIN_PRECISION = 0.4, 0.8
PRIOR = 0.05

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w",
    "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ß": "s",
}
# Digits and signs written for letters. i, l, 1 and | are one letter.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i", "|": "i"}
UNSEEN = "­͏​-‏‪-‮⁠-⁤﻿"
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
SIGNS = re.compile(r"(?<=\w)[@$](?=\w)")


def marks(start: int, end: int) -> set[str]:
    """Combining marks (categories Mn and Me) of a range."""
    return {chr(i) for i in range(start, end) if unicodedata.category(chr(i)) in ("Mn", "Me")}


@cache
def removed() -> tuple[re.Pattern, set[str]]:
    """What is removed from a text: a pattern below U+10000, single characters above."""
    low = "".join(sorted(marks(0x300, 0x10000)))
    return re.compile(f"[{UNSEEN}{low}]"), marks(0x10000, 0x20000) | marks(0xE0000, 0xE0200)


def enclosed(c: str) -> str:
    """The letter in a circle, square or brackets; other characters stay."""
    letters = [x for x in unicodedata.normalize("NFKD", c) if x.isascii() and x.isalpha()]
    if unicodedata.normalize("NFKD", c)[0] == "(" and len(letters) == 1:
        return letters[0]
    named = re.fullmatch(r"(?:NEGATIVE |CROSSED NEGATIVE )?(?:CIRCLED|SQUARED) LATIN (?:CAPITAL|SMALL) LETTER ([A-Z])", unicodedata.name(c, ""))
    return named[1] if named else c


def fold_character(c: str) -> str:
    c = enclosed(c)
    low = c.lower()
    if len(low) != 1:
        low = c
    low = LOOK_ALIKES.get(low, low)
    base = unicodedata.normalize("NFKD", low)
    if len(base) > 1 and all(unicodedata.combining(x) for x in base[1:]) or len(base) == 1:
        low = base[0].lower() if len(base[0].lower()) == 1 else base[0]
        low = LOOK_ALIKES.get(low, low)
    low = SUBSTITUTES.get(low, low)
    return low if low.isalnum() else " "


@cache
def folding() -> dict[int, str]:
    places = [*range(0x3000), *range(0xA640, 0xA7FF), *range(0xFB00, 0xFB07), *range(0xFE00, 0x10000),
              *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F1AE)]
    return {i: fold_character(chr(i)) for i in places if not 0xD800 <= i < 0xE000}


def fold(text: str) -> str:
    """Folded text between two spaces: character i of the cleaned text is at i + 1."""
    if "@" in text or "$" in text:
        text = SIGNS.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return f" {text.translate(folding())} "


def visible(text: str | None) -> str:
    if not text or text.isascii():
        return text or ""
    low, high = removed()
    return ASTRAL.sub(lambda m: "" if m[0] in high else m[0], low.sub("", text))


@lru_cache(maxsize=100_000)
def terms_of(word: str) -> tuple[str, ...]:
    """Patterns that a word can be matched by: the word, and its beginnings."""
    return (f" {word} ", *(f" {word[:n]}" for n in PREFIXES if len(word) >= n))


WORD = re.compile(r"\S+")


def contexts(folded: str, start: int) -> tuple[str, str, str, str]:
    """Phrases around the word whose space is at ``start``."""
    here = WORD.search(folded, start)
    following = WORD.search(folded, here.end())
    end = start
    while end and folded[end - 1].isspace():
        end -= 1
    begin = end
    while begin and not folded[begin - 1].isspace():
        begin -= 1
    word, after, prior = here[0], following[0] if following else "", folded[begin:end]
    return word, f"{prior} {word}", f"{word} {after}", f"{prior} {word} {after}"


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] = (math.log(PRIOR / (1 - PRIOR)), 0.0, 0.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        for pattern in self.weights:
            found.add_word(pattern, pattern)
        found.make_automaton()
        return found

    def score(self, total, words):
        x = self.curve[0] + np.stack(measures(total, words)).T @ np.array(self.curve[1:])
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def measures(total, words):
    """Matched weight, and the same per length of the text."""
    total, words = np.asarray(total, float), np.asarray(words, float)
    return np.log1p(total), np.log1p(100 * total / (words + 20))


def longest_matches(folded: str, automaton) -> dict[int, str]:
    """The longest pattern for each word, by the place of the space before it."""
    longest: dict[int, str] = {}
    for end, pattern in automaton.iter(folded):
        start = end - len(pattern) + 1
        if len(pattern) > len(longest.get(start, "")):
            longest[start] = pattern
    return longest


def matches(folded: str, automaton, lexicon: Lexicon) -> list[tuple[int, int, str]]:
    """Start and end in the visible text and term."""
    found = []
    for start, pattern in sorted(longest_matches(folded, automaton).items()):
        if not lexicon.exceptions or lexicon.exceptions.isdisjoint(contexts(folded, start)):
            found.append((start, start + len(pattern.strip()), pattern))
    return found


def count_terms(batches):
    """Documents of one task per term: (term, toxic, clean)."""
    counts = {0: Counter(), 1: Counter()}

    def rows():
        terms = sorted(counts[0].keys() | counts[1].keys())
        made = pa.RecordBatch.from_pydict({
            "term": pa.array(terms, pa.string()),
            "toxic": pa.array([counts[1][t] for t in terms], pa.int64()),
            "clean": pa.array([counts[0][t] for t in terms], pa.int64()),
        })
        counts[0].clear(), counts[1].clear()
        return made

    for batch in batches:
        for piece in pieces(batch, "text"):
            for label, text in zip(piece.column("label").to_pylist(), piece.column("text").to_pylist()):
                words = set(fold(visible(text)).split())
                counts[label].update({t for w in words if len(w) > 2 and not w.isdigit() for t in terms_of(w)})
            if len(counts[0]) + len(counts[1]) > 250_000:
                yield rows()
    terms_of.cache_clear()
    yield rows()


def ratio(toxic: Column, clean: Column, share: float) -> Column:
    """How much likelier the split of a term is than the split of all documents (twice the log ratio)."""
    n = toxic + clean

    def part(k, p):
        return F.when(k > 0, k * F.log(k / n / F.lit(p))).otherwise(0.0)

    return 2 * (part(toxic, share) + part(clean, 1 - share))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id",
        rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn lexicon, exceptions and curve from about ``rows`` labelled documents, chosen by a hash of the key."""
    chosen = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    chosen = chosen.where(F.col("key").isNotNull() & F.col("label").isin(0, 1))
    share = min(1.0, rows / max(1, chosen.count()))
    chosen = chosen.withColumn("u", share_of("key")).where(F.col("u") < share)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    sample = texts.join(F.broadcast(chosen), "key")  # bounded by ``rows``
    learn = sample.where(F.col("u") < LEXICON_SHARE * share).select("label", "text")
    sizes = {r["label"]: r["count"] for r in chosen.where(F.col("u") < LEXICON_SHARE * share)
             .groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon({})
    counted = with_small_batches(learn).mapInArrow(count_terms, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    counted = counted.select(
        "term", "toxic", "clean", weight.alias("weight"),
        ratio(F.col("toxic"), F.col("clean"), toxic / (toxic + clean)).alias("ratio"),
    ).where((F.col("weight") >= MIN_WEIGHT) & (F.col("ratio") >= MIN_RATIO))
    best = counted.orderBy(F.desc("ratio"), F.length("term"), "term").limit(MAX_TERMS).collect()
    shorter = pruned({r["term"]: r["weight"] for r in best})
    lexicon = responsible(learn, Lexicon(shorter), {r["term"]: r["ratio"] for r in best}, toxic, clean)
    lexicon.exceptions = exceptions(learn, lexicon)
    lexicon.curve = curve(sample.where(F.col("u") >= LEXICON_SHARE * share), lexicon, toxic / (toxic + clean))
    return lexicon


def per_phrase(learn: DataFrame, name: str, lexicon: Lexicon, phrases) -> DataFrame:
    """Documents per phrase (``name``, toxic, clean); ``phrases`` gives those of one folded text."""
    shared = learn.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        known, counts = shared.value, Counter()
        automaton = known.automaton()
        for batch in batches:
            for piece in pieces(batch, "text"):
                for label, text in zip(piece.column("label").to_pylist(), piece.column("text").to_pylist()):
                    counts.update((p, label) for p in set(phrases(fold(visible(text)), automaton, known)))
        listed = list(counts)
        yield pa.RecordBatch.from_pydict({
            name: pa.array([p for p, _ in listed], pa.string()),
            "toxic": pa.array([counts[p, x] * x for p, x in listed], pa.int64()),
            "clean": pa.array([counts[p, x] * (1 - x) for p, x in listed], pa.int64()),
        })

    found = learn.mapInArrow(run, f"{name} string, toxic long, clean long")
    return found.groupBy(name).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def responsible(learn: DataFrame, lexicon: Lexicon, ratios: dict[str, float], toxic: int, clean: int) -> Lexicon:
    """Keep terms that still tell toxic documents apart when a document counts only for its strongest terms.

    Otherwise every rare word of a toxic text with many copies would become a term.
    """
    def strongest(folded, automaton, known):
        terms = set(longest_matches(folded, automaton).values())
        least = STRONGEST * max((ratios[t] for t in terms), default=0.0)
        return [t for t in terms if ratios[t] >= least]

    if not lexicon.weights:
        return lexicon
    counted = per_phrase(learn, "term", lexicon, strongest)
    strong = ratio(F.col("toxic"), F.col("clean"), toxic / (toxic + clean)) >= MIN_RATIO
    sure = F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))
    kept = {r["term"] for r in counted.where(strong & sure).limit(MAX_TERMS).collect()}
    return Lexicon({t: w for t, w in lexicon.weights.items() if t in kept})


def pruned(terms: dict[str, float]) -> dict[str, float]:
    """Without terms that a shorter beginning of the same words covers about as surely."""
    kept: dict[str, float] = {}
    for term in sorted(terms, key=lambda t: (len(t), t)):
        weight = terms[term]
        word = term.strip()
        covered = any(kept.get(f" {word[:n]}", 0.0) >= weight - 1.0 for n in PREFIXES if n <= len(word))
        if not covered:
            kept[term] = weight
    return kept


def exceptions(learn: DataFrame, lexicon: Lexicon) -> set[str]:
    """Phrases around matches that clean documents hold at least three times and toxic ones never."""
    def around(folded, automaton, known):
        return [p for start, _, _ in matches(folded, automaton, known) for p in contexts(folded, start)]

    if not lexicon.weights:
        return set()
    found = per_phrase(learn, "phrase", lexicon, around).where("clean >= 3 AND toxic = 0")
    return {r["phrase"] for r in found.orderBy(F.desc("clean"), "phrase").limit(MAX_TERMS).collect()}


def curve(sample: DataFrame, lexicon: Lexicon, prior: float) -> tuple[float, float, float]:
    """Logistic curve over the two measures, with a ridge; what reaches the driver is bounded by the sample."""
    rows = find(sample.select("label", "text"), lexicon).select(
        "label", "toxic_weight", "toxic_words").toArrow().to_pydict()
    y = np.array(rows["label"], float)
    x = np.stack([np.ones(len(y)), *measures(rows["toxic_weight"], rows["toxic_words"])]).T
    # Two imagined rows keep the curve rising where the sample is too small to tell.
    x = np.concatenate([x, [[1, 0, 0], [1, *(m.item() for m in measures([5.0], [100]))]]])
    y = np.concatenate([y, [0, 1]])
    b, ridge = np.array([math.log(prior / (1 - prior)), 0.5, 0.5]), np.diag([0.01, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ b)
        b = b + np.clip(step, -2, 2)
    return tuple(float(v) for v in b)


FOUND = ("toxic_weight double, toxic_words long, toxic_score double, "
         "toxic_spans array<struct<start: int, end: int, term: string>>")


def find(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with matched weight, number of words, score, and matches by place in the visible text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        known = shared.value
        automaton = known.automaton() if known.weights else None

        def work(texts):
            totals, words, spans = [], [], []
            for one in texts:
                folded = fold(visible(one))
                found = matches(folded, automaton, known) if automaton else []
                totals.append(sum(known.weights[t] for _, _, t in found))
                words.append(len(folded.split()))
                spans.append([{"start": s, "end": e, "term": t} for s, e, t in found])
            return totals, words, known.score(totals, words), spans

        return work

    return add_columns(docs, text, FOUND, make)
