from __future__ import annotations

import tracemalloc
import duckdb
import numpy as np
import pytest

from tidemark.llm import caps


def brute(vectors):
    units = {}
    for key, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, np.float32).astype(float)
            units.setdefault(len(v), []).append((key, v / np.linalg.norm(v)))
    links, root = {k: 0 for k, _ in vectors}, {k: k for k, _ in vectors}
    for some in units.values():
        for i, (a, x) in enumerate(some):
            for b, y in some[:i]:
                if x @ y >= 0.95:
                    links[a], links[b] = links[a] + 1, links[b] + 1
                    low, high = sorted((root[a], root[b]))
                    root = {k: low if r == high else r for k, r in root.items()}
    return {k: (links[k], root[k]) for k in links}


def clusters(seed, dims=32):
    random, rows = np.random.default_rng(seed), []
    for _ in range(30):
        center = random.normal(size=dims)
        for _ in range(random.integers(1, 8)):
            rows.append(center + random.normal(size=dims) * random.choice([0.02, 0.1, 0.15]))
        rows.append(rows[-1])
        rows.append(rows[-1] * 3)
    return [[float(x) for x in np.array(r, np.float32)] for r in rows]


@pytest.mark.parametrize("part, small", [(512, 48), (4, 2)])
def test_links_and_components(spark, monkeypatch, part, small):
    monkeypatch.setattr(caps, "PART", part)
    monkeypatch.setattr(caps, "SMALL", small)
    monkeypatch.setattr(caps, "HOT", 4 * part)
    vectors = [*clusters(part), None, [], [0.0] * 32, [1.0, None] * 16, [float("nan")] * 32, [float("inf")] + [0.0] * 31,
               [1.0, 2.0], [2.0, 4.0], [-1.0, 2.0], [3.0], [1.0], [-1.0]]
    rows = [((i * 37) % 1009, v) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, embedding array<float>, n_links int, root string")
    found = {r.vec_id: (r.n_links, r.component_id) for r in caps.near_vectors(frame).collect()}
    expected = brute(rows)
    same = sum(found[k] == expected[k] for k in expected)
    assert found.keys() == expected.keys() and same >= 0.98 * len(expected)
    assert sum(n for n, _ in found.values()) >= 0.99 * sum(n for n, _ in expected.values())


def test_empty_table_and_repeated_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in caps.near_vectors(frame).collect()) == [
        (0, 2, 1), (1, 2, 1), (1, 2, 1)]
    assert caps.near_vectors(frame.limit(0)).count() == 0


def test_decoding_lists_all_filters_that_are_exceeded():
    random = np.random.default_rng(3)
    code = caps.Code(16, 500, 0)
    units = random.normal(size=(40, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows, filters = code.decode(units)
    turned = units @ code.turn
    all_scores = (turned[:, :8] @ code.halves[0].T)[:, :, None] + (turned[:, 8:] @ code.halves[1].T)[:, None, :]
    expected = {(r, i * code.words + j) for r, i, j in zip(*np.nonzero(all_scores >= code.level))}
    assert {(int(r), int(f)) for r, f in zip(rows, filters)} == expected


def test_recall_at_the_threshold():
    """Of pairs right at the threshold nearly all share a filter."""
    random, n = np.random.default_rng(5), 400
    a = random.normal(size=(n, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = random.normal(size=(n, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * side
    codes = [caps.Code(64, 50_000, i) for i in range(caps.CODES)]
    found = []
    for units in (a, b):
        rows, filters = caps.decode(units, codes)
        found.append([set(filters[rows == i].tolist()) for i in range(n)])
    assert sum(bool(x & y) for x, y in zip(*found)) >= 0.99 * n


def test_sql_compares_every_pair():
    vectors = [*clusters(7)[:60], None, [], [0.0] * 32, [1.0, None] * 16, [float("nan")] * 32, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i * 7 % 97, v) for i, v in enumerate(vectors)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    found = {k: (n, c) for k, n, c, _ in con.execute(caps.oracle()).fetchall()}
    assert found == brute(rows)


@pytest.mark.parametrize("dims, count", [
    (64, 10_000), (64, 1_000_000), (16, 10_000), (16, 1_000_000), (8, 10_000), (8, 1_000_000), (768, 100_000),
    (7, 1_000_000), (3, 1_000_000), (2, 1_000_000), (1, 1_000_000), (64, 1_000), (2, 50)])
def test_recall_at_the_threshold_for_lengths_and_counts(dims, count):
    """Of pairs right at the threshold none of 1,000 is expected to miss, and every vector has filters."""
    kinds = caps.filters_for(dims, count, 0.95, caps.plans({dims: count}, 0.95)[dims])
    a, b = caps.pairs_at(0.95, dims, 1000, 77) if dims > 1 else (np.ones((9, 1)), np.ones((9, 1)))
    assert sum(caps.missed(kinds, a[i : i + 250], b[i : i + 250]) for i in range(0, len(a), 250)) <= 1
    rows, _ = caps.decode(a[:250], kinds)
    assert np.bincount(rows, minlength=len(a[:250])).min() >= 1


def test_pairs_of_caps_are_few_enough_to_tell_vectors_apart():
    """Unrelated vectors of a large table seldom share a filter."""
    kinds = caps.filters_for(64, 1_000_000, 0.95, caps.plans({64: 1_000_000}, 0.95)[64])
    a, b = caps.pairs_at(0.0, 64, 500, 3)
    assert caps.missed(kinds, a, b) >= 499


@pytest.mark.parametrize("dims", [2, 5, 7])
def test_short_vectors_lose_no_link(spark, monkeypatch, dims):
    monkeypatch.setattr(caps, "EXACT", 10)
    rows = list(enumerate(clusters(11, dims)))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {r.vec_id: (r.n_links, r.component_id) for r in caps.near_vectors(frame).collect()} == brute(rows)


def test_vectors_meet_in_codes(spark, monkeypatch):
    monkeypatch.setattr(caps, "EXACT", 10)
    rows = list(enumerate(clusters(12)))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {r.vec_id: (r.n_links, r.component_id) for r in caps.near_vectors(frame).collect()} == brute(rows)


def test_a_hot_filter_meets_its_count_without_a_shuffle_of_its_rows(spark, monkeypatch):
    monkeypatch.setattr(caps, "PART", 8)
    monkeypatch.setattr(caps, "HOT", 32)
    rows = [(i, [float(i), 1.0], 1, [7, 100 + i // 2]) for i in range(40)]
    marked = spark.createDataFrame(rows, "id long, vector array<double>, copies long, filters array<long>")
    cells = caps._cells(marked, ["id"])
    found = cells.collect()
    pairs = [{frozenset((x.id, y.id)) for x in r.rows for y in r.rows if x.id < y.id
              and (r.i == r.j or x.part != y.part)} for r in found if r["filter"] == 7]
    assert len(set.union(*pairs)) == sum(map(len, pairs)) == 40 * 39 // 2 and max(len(r.rows) for r in found) < 40
    assert sorted(r["filter"] for r in found if r["filter"] != 7) == list(range(100, 120))
    assert "BroadcastHashJoin" in cells._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(caps, "HOT", 41)
    assert "LeftAnti" not in caps._cells(marked, ["id"])._jdf.queryExecution().executedPlan().toString()


def test_decoding_is_bounded_whatever_the_table():
    code = caps.Code(64, 30_000_000, 0)
    units = np.random.default_rng(1).normal(size=(2000, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    tracemalloc.start()
    rows, filters = code.decode(units)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert code.words > 20_000 and peak < 8 * 8 * caps.PRODUCTS
    one, found = code.decode(units[1500:1501])
    assert found.tolist() == filters[rows == 1500].tolist() and (np.diff(rows) >= 0).all()
