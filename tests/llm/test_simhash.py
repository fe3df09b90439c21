from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import connected


def roots(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("pairs", [
    [],
    [(1, 1)],
    [(i, i + 1) for i in range(60)],
    [(500, i) for i in range(60)] + [(700, 701), (701, 700)],
    [(random.Random(i).randrange(200), random.Random(-i - 1).randrange(200)) for i in range(150)],
])
def test_components(spark, pairs):
    found = connected(spark.createDataFrame(pairs, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(n, r) for n, r in roots(pairs).items() if n != r}


def plain_fingerprint(text, size=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "One", "one two THREE", "A b c d", "a b c d a b c d a b c d", "É à\x0bx\x1cy z w", "w " * 5000,
])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_copies(draw):
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = draw.choices(words, k=draw.randrange(40, 200))
        for _ in range(draw.randrange(1, 6)):
            copy = list(base)
            for _ in range(draw.randrange(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    return texts + [None, "", "short", "short", "A b", "a B"]


def expected_groups(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    pairs = [(a, b) for n, (a, x) in enumerate(prints) for b, y in prints[: n + 1] if (x ^ y).bit_count() <= 4]
    return roots(pairs)


@pytest.mark.parametrize("part", [1024, 3])
def test_groups(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(near_copies(random.Random(part)))]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, root string")
    found = {r.doc_id: r.component_id for r in simhash.groups(docs).collect()}
    assert found == expected_groups(rows) and len(set(found.values())) < len(rows)
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))


def test_equal_and_missing_ids_leave_one_row_each(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "p q r s t"), (None, "p q r s t"), (2, "z")],
        "doc_id long, text string")
    kept = simhash.distinct_documents(docs)
    assert sorted(((r.doc_id or 0), r.text) for r in kept.collect()) == [(0, "p q r s t"), (1, "a b c d e"), (2, "z")]
    assert simhash.distinct_documents(docs.limit(0)).count() == simhash.groups(docs.limit(0)).count() == 0


def test_one_hot_group_is_one_component(spark):
    """Fingerprints along a walk of single bits: neighbours link, the ends do not."""
    value, draw, prints = 0, random.Random(1), []
    for _ in range(400):
        value ^= 1 << draw.randrange(64)
        prints.append(value - (1 << 64) if value >> 63 else value)
    rows = spark.createDataFrame([(p,) for p in set(prints)], "fp long").withColumn("first", F.col("fp"))
    found = connected(simhash.fingerprint_links(simhash.with_pivots(rows))).collect()
    assert len(found) == len(set(prints)) - 1 and len({r.root for r in found}) == 1


def test_pairs_are_discarded_by_stored_pivot_distances(spark):
    prints = [0, 1, 3, -1, -2]
    table = simhash.with_pivots(spark.createDataFrame([(p,) for p in prints], "fp long"))
    rows = {r.fp: r for r in table.collect()}
    known = simhash.pivots().tolist()
    for p in prints:
        stored = b"".join(rows[p][name].to_bytes(8, "little") for name in simhash.TABLE)
        assert list(stored) == [((p % 2**64) ^ v).bit_count() for v in known]
    assert {frozenset(map(int, r)) for r in simhash.fingerprint_links(table).collect()} >= {frozenset((-1, -2))}
    # One stored distance, in turn of each column, that is too far off parts a pair that verification would keep.
    for name in simhash.TABLE:
        wrong = F.when(F.col("fp") == -2, F.col(name).bitwiseXOR(F.lit(1 << 29))).otherwise(F.col(name))
        found = connected(simhash.fingerprint_links(table.withColumn(name, wrong))).collect()
        assert {r.node for r in found} | {r.root for r in found} == {0, 1, 3}


def test_no_close_pair_is_discarded():
    draw = np.random.default_rng(9)
    left = draw.integers(0, 2**64, 3000, np.uint64)
    flips = np.array([sum(1 << int(b) for b in draw.choice(64, 4, replace=False)) for _ in left], np.uint64)
    sides = [(s, list(np.bitwise_count(s[:, None] ^ simhash.pivots()).astype(np.int8).reshape(len(s), -1, 8).swapaxes(0, 1)))
             for s in (left, left ^ flips)]
    pairs = {(int(x), int(y)) for a, b in simhash.close_pairs(*sides, 4) for x, y in zip(a, b)}
    assert pairs >= {(i, i) for i in range(3000)}


def test_blocks_cover_every_pair():
    for blocks in (5, 6, 8):
        masks = [m % (1 << 64) for m in simhash.block_masks(blocks, 4)]
        draw = random.Random(blocks)
        for _ in range(200):
            change = sum(1 << b for b in draw.sample(range(64), 4))
            assert any(m & change == 0 for m in masks)
    assert simhash.blocks_for(10, 4) == 5 and simhash.blocks_for(10**9, 4) > simhash.blocks_for(10**6, 4)
