from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.workspace import fresh_folder

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(sizes):
    """Share by weight, then hand on what is above the limits until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    limit = {s: mixing.LIMIT * sizes[s] for s in names}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(limit[s] for s in full)
        weights = sum(weight[s] for s in names if s not in full)
        target = {s: limit[s] if s in full else rest * weight[s] / weights for s in names}
        above = {s for s in names if s not in full and target[s] > limit[s] + 1e-9}
        if not above or above | full == set(names):
            return target if not above else {s: limit[s] for s in names}
        full |= above


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 7, None: 90}, {"Z": 10, "a": 10, "é": 3, "": 500},
    {"a": 0, "b": 10}, {"x": 4}, {None: 3}, {f"s{i}": i * i for i in range(30)}, {"a": 0},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("size", [1, 2, 3, 64, 1000, 1023])
def test_permutations(spark, size):
    rows = spark.range(size).select(*[
        mixing.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(key)).alias(f"k{key}") for key in (1, 2)]).collect()
    for key in ("k1", "k2"):
        assert sorted(r[key] for r in rows) == list(range(size))
    if size > 60:
        assert [r.k1 for r in rows] != [r.k2 for r in rows] and [r.k1 for r in rows] != sorted(r.k1 for r in rows)


def documents(seed):
    draw = random.Random(seed)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else draw.choice(["a", "b", "é", None, "tiny"] if i % 50 == 0 else ["a", "b", "é", None])
        text = "\t ".join(f"w{draw.randrange(50)}" for _ in range(draw.choice([0, 1, 5, 40, 300])))
        rows.append((i, text, source))
    return rows + [(None, "no id here", "a"), (None, None, "b"), (7, "same same", "a"), (7, "same same", "a"), (9, " \x1c ", "nothing"),
                   (10, "", "empty"), (11, "x " * 40_000, "long")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = documents(1)
    return rows, spark.createDataFrame([(*r, 1, 1.0) for r in rows], "doc_id long, text string, source string, size int, target double")


def test_taken_words(docs):
    rows, frame = docs
    found = mixing.taken_words(frame).collect()
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    by_source = Counter()
    for (_, _, source), size in zip(rows, sizes):
        by_source[source] += size
    target = plain_targets(by_source)
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.size) for r in found) == sorted(
        ((k if k is not None else -1), s) for (k, _, _), s in zip(rows, sizes))
    assert all(r.taken <= mixing.LIMIT * r.size for r in found)
    taken = Counter()
    for r in found:
        taken[round(r.target, 6), r.source_size] += r.taken
    for source, size in by_source.items():
        same = [s for s in by_source if (round(target[s], 6), by_source[s]) == (round(target[source], 6), size)]
        assert abs(taken[round(target[source], 6), size] - sum(target[s] for s in same)) <= mixing.BLOCK * len(same)
    again = mixing.taken_words(frame.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_mixture_covers_blocks_in_turn(docs):
    _, frame = docs
    rows = mixing.mixture(frame).collect()
    assert len({(r.shard, r.slot) for r in rows}) == len({(r.ix, r.block_ix, r["pass"]) for r in rows})
    passes = Counter((r.ix, r["pass"]) for r in {(x.ix, x.block_ix, x["pass"]): x for x in rows}.values())
    blocks = Counter(ix for ix, _ in {(r.ix, r.block_ix) for r in rows})
    for (ix, number), n in passes.items():
        assert number < mixing.LIMIT and (n == blocks[ix] or (ix, number + 1) not in passes)


def test_shards_draw_their_sources(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 64)
    monkeypatch.setattr(mixing, "CHUNK", 4)
    monkeypatch.setattr(mixing, "RUN", 50)
    _, shares = mixing.placed(docs[1])
    slots = {r.ix: r.slots for r in shares.collect()}
    counts = mixing.draws(shares, fresh_folder(spark, "draws")).collect()
    total, got, in_shard = sum(slots.values()), Counter(), Counter()
    for r in counts:
        got[r.ix] += r.n
        in_shard[r.shard] += r.n
    assert got == Counter({i: n for i, n in slots.items() if n})
    assert in_shard == Counter({s: min(64, total - 64 * s) for s in range(-(-total // 64))})
    # Away from the last shards, which make up for the draw, counts spread as a multinomial draw's do.
    share = {i: n / total for i, n in slots.items()}
    sizes = {(r.shard, r.ix): r.n for r in counts}
    early = [s for s in in_shard if s < 0.7 * total / 64]
    spread = [(sizes.get((s, i), 0) - 64 * p) ** 2 / (64 * p * (1 - p)) for s in early for i, p in share.items() if p > 0.1]
    assert 0.5 < sum(spread) / len(spread) < 1.8


def test_blocks_follow_the_drawn_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 64)
    slots = mixing.drawn(mixing.placed(docs[1])[1]).collect()
    counts = {(r.shard, r.ix): r.n for r in mixing.draws(mixing.placed(docs[1])[1], fresh_folder(spark, "draws")).collect()}
    assert Counter((r.shard, r.ix) for r in slots) == Counter(counts)
    # With other counts other slots, and no words, are taken.
    monkeypatch.setattr(mixing, "draws", lambda shares, folder, draws=mixing.draws: draws(shares, folder).where("shard < 1"))
    taken = mixing.taken_words(docs[1]).agg(F.sum("taken")).first()[0]
    assert 0 < taken <= 64 * mixing.BLOCK


def test_sums_over_chunks(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(4), draw.randrange(3), i, draw.randrange(100)) for i in range(500)]
    rows = [(k, i // 60, i, n) for k, _, i, n in rows]
    found = mixing.running(spark.createDataFrame(rows, "k int, chunk int, i int, n long"), ["k"], [F.col("i")], s=F.col("n"))
    assert {(r.i, r.s) for r in found.collect()} == {
        (i, sum(m for a, _, j, m in rows if a == k and j < i)) for k, _, i, _ in rows}


def test_mixed_documents_hold_the_taken_words(docs):
    rows, frame = docs
    clashing = {c: F.lit(1) for c in ("ranges", "whole", "words", "first", "ix", "start", "pass", "text_hash", "block_ix")}
    frame = frame.withColumns(clashing | {"n_chars": F.lit(0).cast("long")})
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    texts = {}
    for k, t, _ in rows:
        texts.setdefault(k, []).append(t)
    got, taken = Counter(), Counter()
    for r in mixed.collect():
        words = WORD.findall(r.text)
        got[r.doc_id] += len(words)
        assert words and r.n_chars == len(r.text)
        assert any(Counter(words) <= Counter(WORD.findall(t or "")) for t in texts[r.doc_id])
    for r in mixing.taken_words(frame).collect():
        taken[r.doc_id] += r.taken
    assert got == Counter({k: n for k, n in taken.items() if n})


def test_no_rows_and_no_python(spark, docs):
    _, frame = docs
    assert mixing.taken_words(frame.limit(0)).count() == mixing.mixed_documents(frame.limit(0)).count() == 0
    plan = mixing.mixed_documents(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
