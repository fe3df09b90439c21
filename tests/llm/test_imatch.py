from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import imatch


def texts_of(n, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    return [" ".join(draw.choices(words, k=draw.randrange(5, 200)) + ["the"] * 5) for _ in range(n)]


def plain_lexicon(texts, most_share, least_share, least=imatch.LEAST_DOCUMENTS):
    seen = Counter(w for t in texts for w in set((t or "").split()))
    fewest = max(least, least_share * len(texts))
    return {xxhash.xxh64_intdigest(w.encode(), imatch.SEED) >> 3 for w, n in seen.items()
            if fewest <= n <= max(fewest, most_share * len(texts))}


@pytest.mark.parametrize("most_share, least_share, held", [
    (imatch.MOST_SHARE, imatch.LEAST_SHARE, imatch.HELD), (0.08, 0.04, 50), (0.5, 0.0, 3000), (0.01, 0.9, 7)])
def test_lexicon_is_the_band_of_words_over_all_documents(spark, monkeypatch, most_share, least_share, held):
    monkeypatch.setattr(imatch, "HELD", held)
    monkeypatch.setattr(imatch, "CUT_CHARS", 1500)
    texts = [*texts_of(80, 1), None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    known = imatch.lexicon(docs, most_share=most_share, least_share=least_share)
    assert known.terms.dtype == np.int64
    assert (np.diff(known.terms) > 0).all()
    assert set(known.terms.tolist()) == plain_lexicon(texts, most_share, least_share)


def test_words_are_counted_apart_however_many_there_are():
    """More distinct words than a table of 2^16 places could tell apart: each keeps its own count."""
    texts = [" ".join(f"x{i}" for i in range(a, a + 20_000)) for a in range(0, 400_000, 10_000)]
    batches = list(imatch._count([pa.RecordBatch.from_pydict({"text": texts})]))
    counts = Counter()
    for batch in batches:
        for one, *lists in zip(*(batch.column(c).to_pylist() for c in ("range", "high", "low", "n"))):
            for high, low, n in zip(*lists):
                counts[one << 48 | (high & 0xFFFF) << 32 | low & 0xFFFFFFFF] += n
    assert set(counts) == {xxhash.xxh64_intdigest(f"x{i}".encode(), imatch.SEED) >> 3 for i in range(410_000)}
    assert len(counts) == 410_000 and Counter(counts.values()) == {2: 390_000, 1: 20_000}


def test_terms_outside_the_lexicon_are_left_out():
    known = imatch.Lexicon(np.array([-5, 3, 9]))
    assert known.keep(np.array([-7, -5, 4, 9, 11])).tolist() == [-5, 9]
    assert known.keep(np.array([4, 12])).tolist() == [4, 12] and imatch.Lexicon(np.zeros(0, np.int64)).keep(np.array([1])).tolist() == [1]


@pytest.mark.parametrize("parts", [2, 7])
def test_edited_and_next_texts(spark, parts):
    texts = [*texts_of(40, 2), None, "", "x", "the", "the", "é" * 9]
    keys = random.Random(3).sample(range(1000), len(texts))
    docs = spark.createDataFrame([(k, t, 5) for k, t in zip(keys, texts)], "doc_id long, text string, n_chars int").repartition(4)
    known = imatch.lexicon(docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = {r.doc_id: r for r in imatch.edited(docs, known).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = [(k, t or "") for k, t in sorted(zip(keys, texts))]

    def print_of(text):
        return imatch.fingerprint(known.keep(imatch.terms_of([text])[0]))

    assert len(found) == len(texts)
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half, r = len(text) // 2, found[key]
        edited = text[: len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (print_of(text), print_of(edited))
        assert r.near_edited == imatch.likeness(print_of(text), print_of(edited))
        assert r.near_next == imatch.likeness(print_of(text), print_of(following))


def test_one_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "only one"), ], "doc_id long, text string")
    row = imatch.edited(docs, imatch.lexicon(docs)).first()
    assert row.near_next == 1.0 and row.n_chars == 8
    none = docs.limit(0)
    assert imatch.edited(none, imatch.lexicon(none)).count() == 0
    twins = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert imatch.edited(twins, imatch.lexicon(twins)).count() == 3


def test_likeness_follows_common_terms():
    random_ids = np.random.default_rng(4)
    values = []
    for common in (0, 50, 100, 150, 190, 200):
        estimates = []
        for _ in range(20):
            pool = random_ids.permutation(np.unique(random_ids.integers(-(2**63), 2**63, 400 - common)))
            one, other = np.sort(pool[:200]), np.sort(pool[200 - common :][:200])
            estimates.append(imatch.likeness(imatch.fingerprint(one), imatch.fingerprint(other)))
        values.append(np.mean(estimates))
        assert abs(np.mean(estimates) - common / (400 - common)) < 0.15
    assert values == sorted(values) and values[0] < 0.01 and values[-1] == 1.0


def test_subsets_are_hashes_of_their_sorted_terms():
    terms = np.array([3, 10, 77, 1000], np.int64)
    subset, place = imatch.members(terms)
    held = {one: terms[place[subset == one]].tolist() for one in set(subset.tolist())}
    assert all(own == sorted(own) for own in held.values())
    assert sorted(t for one, own in held.items() if one < imatch.PER_SIZE for t in own) == terms.tolist()
    found = imatch.fingerprint(terms)
    for one in range(imatch.SIZES * imatch.PER_SIZE):
        part = found[16 + one * imatch.DIGITS :][: imatch.DIGITS]
        own = np.array(held.get(one, []), "<i8")
        code = imatch.CODES[xxhash.xxh32_intdigest(own.tobytes(), one) & 0xFFF]
        assert part == (code if len(own) else imatch.NO_TERM)
    subset, _ = imatch.members(np.arange(100_000))
    shares = np.bincount(subset // imatch.PER_SIZE) / 100_000
    assert shares == pytest.approx([2.0**-j for j in range(imatch.SIZES)], rel=0.2)
    empty = imatch.fingerprint(terms[:0])
    assert imatch.likeness(empty, empty) == 1.0 and imatch.likeness(empty, found) == 0.0


def test_terms():
    found = imatch.terms_of(["", None, "a A  b", "--", "É_1 é_1!", "x", ""])
    assert [len(t) for t in found] == [0, 0, 2, 0, 1, 1, 0]
    assert all((np.diff(t) > 0).all() for t in found) and imatch.terms_of([]) == []


def test_fingerprinted(spark):
    docs = spark.createDataFrame([("A b c", 1), ("c B a", 2), (None, 3)], "text string, imatch int")
    rows = imatch.fingerprinted(docs, imatch.lexicon(docs)).collect()
    assert rows[0].imatch == rows[1].imatch != rows[2].imatch
