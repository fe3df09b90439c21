"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut into two halves and each half is quantised by centroids of its own, so a pair of centroids names a
cell and k centroids a half make k * k cells. A query takes the pairs by their summed distance, smallest first, from a
heap over the two sorted lists of distances (the distance of a half is minus its inner product with the centroid), until
the cells it took hold enough entries. The entries of these cells are ranked anew by the inner product of the
original vectors in double precision.

Centroids are fitted by k-means on at most ``SAMPLE`` vectors, chosen by a hash of the id; every row is indexed. How
many entries are enough is measured: the true neighbours of at most ``TRIED`` queries, found by comparing them with the whole
table, tell how many entries a query had to take to meet the share ``RECALL`` of its neighbours. So recall stays
the same as the table grows, and tables with structure are searched in few cells.

Neighbouring cells are put together into blocks of about ``BLOCK`` entries; a cell with more is cut by a hash of
the id. A query goes once to each block that holds some of its cells, with their list; a block meets its queries
``QUERIES`` at a time, and only the best of each query leave it. What the driver holds is bounded: the sample,
the tried queries with their neighbours, the centroids and at most ``CELLS`` sizes of cells.

Defined results: null, empty and zero vectors, and those with null or non-finite components, neither ask nor are found; only
vectors of equal length are compared; repeated rows are entries of their own, and a query with a repeated id is not its own
candidate but asks once, with the least of its vectors; rows without an id take no part; ties go to the smaller id; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.caps import usable
from tidemark.llm.tables import batches_of
from tidemark.workspace import fresh_folder, written

#: Vectors that centroids are fitted on, rounds of fitting, entries per cell, cells.
SAMPLE, ROUNDS, LOAD, CELLS = 16_384, 12, 16, 65_536
#: Queries that are tried against the whole table, and the share of their neighbours that has to be met.
TRIED, RECALL = 64, 0.96
#: Entries of a block, and queries that meet it at once.
BLOCK, QUERIES = 4096, 2048
#: Meetings of a block and queries that Python gets at once.
ROWS = 2
SEED = 42


def fitted(vectors: np.ndarray, k: int) -> np.ndarray:
    """k-means centroids; fewer where there are fewer distinct vectors."""
    distinct = np.unique(vectors, axis=0)
    if len(distinct) <= k or not vectors.shape[1]:
        return distinct if len(distinct) else np.zeros((1, vectors.shape[1]))
    centroids = distinct[np.random.default_rng(SEED).choice(len(distinct), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = quantised(vectors, centroids)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def quantised(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector."""
    found = np.zeros(len(vectors), np.int64)
    squares = 0.5 * (centroids * centroids).sum(1)
    for i in range(0, len(vectors), 8192):
        found[i : i + 8192] = np.argmax(vectors[i : i + 8192] @ centroids.T - squares, axis=1)
    return found


class Index:
    """Centroids of both halves for vectors of one length, and what their cells hold."""

    def __init__(self, sample: np.ndarray, k: int):
        self.cut = sample.shape[1] // 2
        self.halves = [fitted(sample[:, : self.cut], k), fitted(sample[:, self.cut :], k)]
        self.width = len(self.halves[1])
        self.cells = len(self.halves[0]) * self.width
        self.sizes = np.zeros(self.cells, np.int64)
        self.blocks = np.zeros(self.cells, np.int64)
        self.parts = np.ones(self.cells, np.int64)

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        one, two = (quantised(v, c) for v, c in zip((vectors[:, : self.cut], vectors[:, self.cut :]), self.halves))
        return one * self.width + two

    def filled(self, sizes: dict[int, int], first: int) -> int:
        """Deal the cells to blocks from number ``first`` on; returns the number after the last."""
        for cell, n in sizes.items():
            self.sizes[cell] = n
        held = 0
        for cell, n in enumerate(self.sizes.tolist()):
            if held and held + n > BLOCK:
                first, held = first + 1, 0
            self.blocks[cell], self.parts[cell] = first, max(1, math.ceil(n / BLOCK))
            held += n
            if n > BLOCK:  # its parts have blocks of their own
                first, held = first + int(self.parts[cell]), 0
        return first + 1

    def traversed(self, query: np.ndarray):
        """Cells by the summed distance of their centroids."""
        distances = [-(c @ q) for c, q in zip(self.halves, (query[: self.cut], query[self.cut :]))]
        orders = [np.argsort(d, kind="stable").tolist() for d in distances]
        one, two = (np.sort(d).tolist() for d in distances)
        heap, reached = [(one[0] + two[0], 0, 0)], [0] * len(one)
        while heap:
            _, i, j = heapq.heappop(heap)
            yield orders[0][i] * self.width + orders[1][j]
            # A pair waits once both pairs before it, in its row and in its column, were taken.
            reached[i] = j + 1
            if j + 1 < len(two) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
            if i + 1 < len(one) and reached[i + 1] == j:
                heapq.heappush(heap, (one[i + 1] + two[j], i + 1, j))

    def taken(self, query: np.ndarray, enough: int) -> list[int]:
        """Non-empty cells in the order of the heap until they hold enough entries."""
        found, held = [], 0
        for cell in self.traversed(query):
            if self.sizes[cell]:
                found.append(cell)
                held += int(self.sizes[cell])
                if held >= enough:
                    break
        return found

    def before(self, query: np.ndarray, cells: set[int]) -> dict[int, int]:
        """How many entries a query has taken when it comes to each of these cells, itself included."""
        found, held = {}, 0
        for cell in self.traversed(query):
            held += int(self.sizes[cell])
            if cell in cells:
                found[cell] = held
                if len(found) == len(cells):
                    break
        return found


def lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the components."""
    total = np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        total += x * y
    return total


def best_of(queries: np.ndarray, entries: np.ndarray, allowed, query_ids, entry_ids, k: int):
    """(query row, entry row, score): the k best entries of each query, and all that tie with the last."""
    scores = queries @ entries.T
    scores[entry_ids[None, :] == query_ids[:, None]] = -np.inf
    if allowed is not None:
        scores[~allowed] = -np.inf
    if scores.shape[1] > k:
        last = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    else:
        last = np.full(len(queries), -np.inf)
    # The product of matrices rounds otherwise than the sum in order: keep what may tie.
    slack = 1e-9 * np.abs(queries).sum(1) * max(1e-300, np.abs(entries).max(initial=0))
    a, b = np.nonzero((scores >= (last - slack)[:, None]) & (scores > -np.inf))
    exact = products(queries[a], entries[b])
    order = np.lexsort((entry_ids[b], -exact, a))
    a, b, exact = a[order], b[order], exact[order]
    starts = np.searchsorted(a, np.arange(len(queries)))
    kept = np.arange(len(a)) - starts[a] < k
    return a[kept], b[kept], exact[kept]


def sound(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``vector`` in double precision of the rows that take part."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    return rows.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), doubles.alias("vector"))


def top(found: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best rows of each query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _true(asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """The best of a batch for the tried queries: length -> (ids, vectors)."""
    def run(batches):
        for batch in batches:
            sizes = lengths(batch.column("vector"))
            for dims, (ids, queries) in asked.items():
                some = batch.filter(pa.array(sizes == dims))
                if some.num_rows:
                    entry_ids = some.column("id").to_numpy()
                    a, b, score = best_of(queries, matrix(some.column("vector"), dims), None, ids, entry_ids, k)
                    yield pa.RecordBatch.from_pydict({
                        "query_id": ids[a], "vec_id": entry_ids[b], "score": score, "cell": some.column("cell").to_numpy()[b]})

    return run


def _cells(indexes: dict[int, Index]):
    def run(batches):
        for batch in batches:
            sizes = lengths(batch.column("vector"))
            cells = np.zeros(batch.num_rows, np.int64)
            for dims in np.unique(sizes).tolist():
                mine = sizes == dims
                if dims in indexes:
                    cells[mine] = indexes[dims].cells_of(matrix(batch.column("vector").filter(pa.array(mine)), dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    return run


def _asked(indexes: dict[int, Index], enough: dict[int, int], k: int):
    """For each query the blocks that it goes to, with its cells there."""
    def run(batches):
        for batch in batches:
            blocks, cells, rows = [], [], []
            copies = batch.column("copies").to_pylist()
            for row, vector in enumerate(batch.column("vector")):
                query = vector.values.to_numpy()
                index = indexes[len(query)]
                # The rows of the query itself are no candidates.
                wanted = max(enough[len(query)], k) + copies[row]
                mine = np.array(sorted(index.taken(query, wanted)), np.int64)
                cuts = np.nonzero(np.diff(index.blocks[mine], prepend=-1))[0].tolist()
                for start, end in zip(cuts, [*cuts[1:], len(mine)]):
                    first = int(index.blocks[mine[start]])
                    for block in range(first, first + int(index.parts[mine[start]])):
                        blocks.append(block), rows.append(row), cells.append(mine[start:end])
            taken = batch.select(["id", "vector"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(blocks, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                ["query_id", "asks", "block", "cells"])

    return run


def _ranked(k: int):
    """The best entries of a block for some of its queries."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                entries, asks = row.column("entries").flatten(), row.column("asks").flatten()
                dims = len(entries.field("vector")[0])
                entry_ids, entry_cells = entries.field("id").to_numpy(), entries.field("cell").to_numpy()
                local, places = np.unique(entry_cells, return_inverse=True)
                allowed = np.zeros((len(asks), len(local)), bool)
                wanted = asks.field("cells")
                who = np.repeat(np.arange(len(asks)), lengths(wanted))
                cells = wanted.flatten().to_numpy()
                at = np.minimum(np.searchsorted(local, cells), len(local) - 1)
                here = local[at] == cells
                allowed[who[here], at[here]] = True
                query_ids = asks.field("query_id").to_numpy()
                a, b, score = best_of(matrix(asks.field("asks"), dims), matrix(entries.field("vector"), dims),
                                      allowed[:, places], query_ids, entry_ids, k)
                yield pa.RecordBatch.from_pydict({"query_id": query_ids[a], "vec_id": entry_ids[b], "score": score})

    return run


def sampled(rows: DataFrame, n: int, seed: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """At most n rows by a hash of their id, as length -> (ids, vectors)."""
    chosen = rows.select("id", "vector").orderBy(F.xxhash64(F.lit(seed), "id"), "id", "vector").limit(n).toArrow().combine_chunks()
    sizes = lengths(chosen.column("vector"))
    some = {d: chosen.filter(pa.array(sizes == d)) for d in np.unique(sizes).tolist()}
    return {d: (t.column("id").to_numpy(), matrix(t.column("vector").combine_chunks(), d)) for d, t in some.items()}


def fit(vectors: DataFrame) -> dict[int, Index]:
    """An index for each length of vectors, without entries; cells number ``CELLS`` at most over all lengths."""
    size = F.size("vector").alias("dims")
    counts = vectors.groupBy(size).agg(F.count(F.lit(1)).alias("n")).collect()
    sample, room = sampled(vectors, SAMPLE, "index"), max(1, CELLS // max(1, len(counts)))
    return {
        r["dims"]: Index(sample.get(r["dims"], (None, np.zeros((0, r["dims"]))))[1],
                         max(1, math.isqrt(min(math.ceil(r["n"] / LOAD), room))))
        for r in counts
    }


def entries_enough(indexed: DataFrame, queries: DataFrame, indexes: dict[int, Index], k: int, recall: float) -> dict[int, int]:
    """Entries that queries of each length have to take to meet the share ``recall`` of their true neighbours."""
    asked = sampled(queries, TRIED, "tried")
    true = indexed.mapInArrow(_true(asked, k), "query_id long, vec_id long, score double, cell long")
    cells: dict[int, list[int]] = {}
    for r in top(true, k).select("query_id", "cell").collect():
        cells.setdefault(r["query_id"], []).append(r["cell"])
    enough = {}
    for dims, index in indexes.items():
        held = []
        for query_id, query in zip(*asked.get(dims, ([], []))):
            mine = cells.get(int(query_id), [])
            before = index.before(query, set(mine))
            held += [before[c] for c in mine]
        # Without a tried query of this length every entry is taken.
        enough[dims] = int(np.quantile(held, recall, method="higher")) if held else int(index.sizes.sum())
    return enough


def questions(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``vector``, ``copies`` (rows with the id) of the rows that ask."""
    return sound(rows, key, vector).groupBy("id").agg(F.min("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))


def nearest(rows: DataFrame, asking: Column | str, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest other rows found for each row that ``asking`` selects."""
    spark = rows.sparkSession
    folder = fresh_folder(spark, "inverted")
    given = written(sound(rows, key, vector), f"{folder}/vectors")
    queries = written(questions(rows.where(asking), key, vector), f"{folder}/queries")
    indexes = fit(given)
    indexed = written(given.mapInArrow(_cells(indexes), "id long, vector array<double>, cell long"), f"{folder}/indexed")
    sizes: dict[int, dict[int, int]] = {}
    for r in indexed.groupBy(F.size("vector").alias("dims"), "cell").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes.setdefault(r["dims"], {})[r["cell"]] = r["n"]
    first = 0
    for dims, index in indexes.items():
        first = index.filled(sizes[dims], first)
    enough = entries_enough(indexed, queries, indexes, k, recall)

    dealt = spark.createDataFrame(
        [(d, c, int(i.blocks[c]), int(i.parts[c])) for d, i in indexes.items() for c in sizes[d]],
        "dims int, cell long, block long, parts long")
    placed = indexed.withColumn("dims", F.size("vector")).join(F.broadcast(dealt), ["dims", "cell"])
    block = F.col("block") + F.pmod(F.xxhash64(F.lit("part"), "id", "vector"), F.col("parts"))
    blocks = placed.groupBy(block.alias("block")).agg(F.collect_list(F.struct("id", "vector", "cell")).alias("entries"))
    blocks = written(blocks, f"{folder}/blocks")
    going = written(queries.mapInArrow(_asked(indexes, enough, k), "query_id long, asks array<double>, block long, cells array<long>"),
                    f"{folder}/going")
    crowds = going.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("crowds"))
    crowd = F.pmod(F.xxhash64(F.lit("crowd"), "query_id"), F.col("crowds"))
    met = going.join(crowds, "block").groupBy("block", crowd.alias("crowd")).agg(
        F.collect_list(F.struct("query_id", "asks", "cells")).alias("asks"))
    found = met.join(blocks, "block").select("entries", "asks").mapInArrow(
        _ranked(k), "query_id long, vec_id long, score double")
    with batches_of(spark, ROWS):
        found = written(found, f"{folder}/found")
    return top(found, k).select("query_id", "rank", "vec_id", "score")


def recalled(found: DataFrame, rows: DataFrame, asking: Column | str, key: str = "vec_id", vector: str = "embedding",
             k: int = 20) -> float:
    """The share of true neighbours among those found, by comparing all rows that ask with all rows, block by block."""
    cell = F.lit(0).cast("long")
    given, asks = sound(rows, key, vector).cache(), questions(rows.where(asking), key, vector).cache()
    blocks, crowds = max(1, given.count() // BLOCK), max(1, asks.count() // QUERIES)
    entries = given.groupBy(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("id", "vector", cell.alias("cell"))).alias("entries"))
    crowd = asks.groupBy(F.pmod(F.xxhash64("id"), F.lit(crowds)).alias("crowd")).agg(F.collect_list(F.struct(
        F.col("id").alias("query_id"), F.col("vector").alias("asks"), F.array(cell).alias("cells"))).alias("asks"))
    numbers = F.sequence(cell, F.lit(crowds - 1).cast("long"))
    every = entries.select(F.explode(numbers).alias("crowd"), "entries").join(crowd, "crowd")
    true = top(every.select("entries", "asks").mapInArrow(_ranked(k), "query_id long, vec_id long, score double"), k).cache()
    n = true.count()
    return true.join(found, ["query_id", "vec_id"]).count() / n if n else 1.0
