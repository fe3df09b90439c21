"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction made of two code words, one for each half of a randomly
rotated space; the code words are random unit vectors. There are up to ``CODES`` rotations
with code words of their own. A vector falls in every filter whose direction it exceeds a
level with, and in one code in ``LEAST`` filters at least: where the level gives fewer, the
vector has a lower level of its own. The list of these filters is decoded
without trying all of them: only code words of one half that can reach the threshold
with the best of the other half are paired. Vectors meet in filters, and pairs are
verified by cosine in double precision.

Codes are drawn alike for every vector, so a pair at a given angle shares no filter of
one code with the same probability m wherever it lies, and none of n codes with m^n.
``planned`` measures m at the threshold for the length and number of vectors, lowers
the level until m^n is at most ``MISS`` with ``CODES`` codes, and takes the fewest codes that do.
Pairs above the threshold are missed less often. Nothing is missed among vectors shorter
than ``LOW_DIMS``, which meet in the cells of a grid, and among up to ``EXACT`` vectors of a
length, which are all compared.

Equal vectors are compared once. Number of code words and level follow the number
of vectors, so that a filter holds about ``LOAD`` unrelated vectors unless the angle needs wider
ones; filters with one vector are dropped. A filter with many is cut
into parts that meet pair by pair in separate tasks; one with more than ``HOT`` is also joined with its
count by broadcast, so that no task reads it whole. What leaves the tasks is a spanning
forest of the links. In a second pass over linked vectors only, a pair is counted in the
first filter that both fall in, and only counts per vector leave the tasks.

Defined results: null, empty and zero vectors and those with null or non-finite
components link with nothing and are components of their own; only vectors of equal
length are compared; null ids are their own component null unless linked to others;
repeated rows with equal vectors are linked; extra columns are ignored. More than ``LENGTHS``
different lengths are an error.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.simhash import forest
from tidemark.operators.joins import ROWS, lookup_join
from tidemark.workspace import fresh_folder, written

THRESHOLD = 0.95
CODES, FILTERS, LOAD = 5, 40, 0.5
#: Vectors of one filter that are compared in one task.
PART = 512
#: Vectors of one filter that may meet its count in one task.
HOT = 4 * PART
#: Lengths of vectors that a table may have.
LENGTHS = 1000
#: Filters of a vector in one code at least; pairs at the threshold that share no filter at most.
LEAST, MISS = FILTERS // CODES, 1e-4
#: Pairs per code, and codes, that the share of missed pairs is measured with.
TRIED, TRIED_CODES = 400, 2
#: Below this length vectors meet in a grid; of one length up to so many are all compared.
LOW_DIMS, EXACT = 8, 4096
#: Cells up to this size are compared together.
SMALL = 48
SEED = 42


#: Products of vectors and code words that a task holds at once, of each half.
PRODUCTS = 4_000_000


@lru_cache(maxsize=1000)
def cap_level(dims: int, share: float) -> float:
    """The cosine that this share of all directions exceeds with a given one."""
    if dims == 1:
        return 0.99
    angles = np.linspace(0, math.pi, 200_001)
    weights = np.sin(angles) ** (dims - 2)
    below = np.cumsum(weights) / weights.sum()
    return math.cos(angles[np.searchsorted(below, share)])


class Code:
    """Filters for vectors of one length under one rotation; the same in every task."""

    def __init__(self, dims: int, count: int, number: int):
        random = np.random.default_rng([SEED, dims, number])
        self.share = min(0.02, LOAD / max(1, count))
        words = max(8, math.ceil(math.sqrt(FILTERS / CODES / self.share)))
        self.words, self.first = words, number * words * words
        self.level = cap_level(dims, self.share)
        self.turn = np.linalg.qr(random.normal(size=(dims, dims)))[0]
        self.cut = dims // 2
        halves = [random.normal(size=(words, n)) for n in (self.cut, dims - self.cut)]
        # Each half's code words have the length that makes a whole direction a unit vector.
        self.halves = [h / np.linalg.norm(h, axis=1, keepdims=True) * math.sqrt(h.shape[1] / dims) for h in halves]

    def decode(self, units: np.ndarray, level: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that each unit vector exceeds the level with."""
        level = self.level if level is None else level
        at_once = max(1, PRODUCTS // self.words)
        parts = [self._decode(units[i : i + at_once], level) for i in range(0, len(units), at_once)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([r + i * at_once for i, (r, _) in enumerate(parts)]), np.concatenate([f for _, f in parts])

    def _decode(self, units: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray]:
        turned = units @ self.turn
        first = turned[:, : self.cut] @ self.halves[0].T
        second = turned[:, self.cut :] @ self.halves[1].T
        rows, ones = np.nonzero(first >= level - second.max(1, keepdims=True))
        found = []
        step = max(1, PRODUCTS // self.words)
        for i in range(0, len(rows), step):
            r, one = rows[i : i + step], ones[i : i + step]
            at, two = np.nonzero(second[r] >= (level - first[r, one])[:, None])
            found.append((r[at], self.first + one[at] * self.words + two))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, filters = (np.concatenate(x) for x in zip(*found))
        return rows, filters

    def falls(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter); a vector with few filters has those of the first level that gives ``LEAST``."""
        found, left, share, level = [], np.arange(len(units)), self.share, self.level
        while len(left):
            rows, filters = self.decode(units[left], level)
            enough = np.bincount(rows, minlength=len(left)) >= LEAST
            kept = enough[rows]
            found.append((left[rows[kept]], filters[kept]))
            left, share = left[~enough], 2 * share
            level = cap_level(self.turn.shape[0], share) if share < 0.5 else -2.0  # -2: all filters
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, filters = (np.concatenate(x) for x in zip(*found))
        return rows, filters


class Grid:
    """Cells whose box is within half the distance of two vectors at the threshold.

    The middle of two such vectors lies in a cell that both fall in, so no pair is missed.
    """

    def __init__(self, threshold: float):
        self.side = math.sqrt(max(2 - 2 * threshold, 1e-6)) * (1 + 1e-6)

    def falls(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = math.ceil(2 / self.side) + 3
        rows, cells, squares = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units))
        for x in units.T:
            place = (x + 1) / self.side + 1
            own = np.floor(place)
            parts = []
            for move, gap in ((-1, place - own), (0, 0 * place), (1, own + 1 - place)):
                total = squares + gap[rows] ** 2
                near = total <= 0.25 + 1e-9
                parts.append((rows[near], cells[near] * steps + own[rows[near]].astype(np.int64) + move, total[near]))
            rows, cells, squares = (np.concatenate(p) for p in zip(*parts))
        return rows, cells


class Whole:
    """One filter that all vectors fall in."""

    def falls(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(units)), np.zeros(len(units), np.int64)


def pairs_at(threshold: float, dims: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and others at exactly this cosine."""
    random = np.random.default_rng([SEED, dims, seed])
    a, side = random.normal(size=(2, n, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return a, threshold * a + math.sqrt(1 - threshold**2) * side


def missed(kinds: list, a: np.ndarray, b: np.ndarray) -> int:
    """Pairs of rows that share no filter."""
    shared = [set(zip(*(x.tolist() for x in decode(units, kinds)))) for units in (a, b)]
    return len(a) - len({row for row, _ in shared[0] & shared[1]})


def planned(dims: int, count: int, threshold: float = THRESHOLD) -> tuple[int, int] | None:
    """The number of vectors that the level is made for, and the codes that miss ``MISS`` at most.

    None if no level does it with ``CODES`` codes.
    """
    made_for = count
    while made_for > LOAD / 0.02:
        misses, tried = 0, TRIED * TRIED_CODES
        for i in range(TRIED_CODES):
            misses += missed([Code(dims, made_for, i)], *pairs_at(threshold, dims, TRIED, i))
        # The most that so many misses leave likely.
        most = min(1.0, (misses + 2 * math.sqrt(misses) + 3) / tried)
        if most ** CODES <= MISS:
            return made_for, math.ceil(math.log(MISS) / math.log(most))
        made_for //= 2
    return None


def filters_for(dims: int, count: int, threshold: float, plan: tuple[int, int] | None) -> list:
    """What vectors of one length meet in."""
    if dims < LOW_DIMS and count > EXACT:
        return [Grid(threshold)]
    return [Code(dims, plan[0], i) for i in range(plan[1])] if plan else [Whole()]


def plans(sizes: dict[int, int], threshold: float) -> dict[int, tuple[int, int] | None]:
    """What ``planned`` gives for each length whose vectors meet in codes."""
    return {d: planned(d, n, threshold) if d >= LOW_DIMS and n > EXACT else None for d, n in sizes.items()}


def decode(units: np.ndarray, kinds: list) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over all codes, by row."""
    rows, filters = (np.concatenate(x) for x in zip(*(c.falls(units) for c in kinds)))
    order = np.lexsort((filters, rows))
    return rows[order], filters[order]


def usable(vector: str):
    """Whether a vector can link: no null or non-finite component, not all zero."""
    parts = F.col(vector)
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return parts.isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists(parts, lambda x: x != 0)


def _units(vectors: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors in double precision."""
    found = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    found = found / np.abs(found).max(1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _falls(counts: dict[int, int], threshold: float):
    planned_for = plans(counts, threshold)

    def run(batches):
        kinds: dict[int, list] = {}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector")])
            for dims in np.unique(sizes).tolist():
                if dims not in kinds:
                    kinds[dims] = filters_for(dims, counts[dims], threshold, planned_for[dims])
                some = batch.filter(pa.array(sizes == dims))
                rows, filters = decode(_units(some.column("vector"), dims), kinds[dims])
                n = np.bincount(rows, minlength=some.num_rows)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(filters.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], [*some.schema.names, "filters"])

    return run


def cell_pairs(units: np.ndarray, cells: list[tuple], threshold: float):
    """Linked rows (a, b) of cells (first row, number of rows, rows of the one part or None)."""
    found_a, found_b = [], []

    def keep(a, b):
        for i in range(0, len(a), 200_000):
            x, y = a[i : i + 200_000], b[i : i + 200_000]
            close = np.einsum("ij,ij->i", units[x], units[y]) >= threshold
            found_a.append(x[close]), found_b.append(y[close])

    by_size: dict[int, list[int]] = {}
    for start, n, one in cells:
        if one is None and n <= SMALL:
            by_size.setdefault(n, []).append(start)
            continue
        rows = np.arange(start, start + n)
        left, right = (rows, rows) if one is None else (rows[one], rows[~one])
        close = units[left] @ units[right].T >= threshold
        a, b = np.nonzero(np.triu(close, 1) if one is None else close)
        found_a.append(left[a]), found_b.append(right[b])
    for n, starts in by_size.items():
        a, b = np.triu_indices(n, 1)
        offsets = np.array(starts)[:, None]
        keep((offsets + a).ravel(), (offsets + b).ravel())
    return np.concatenate(found_a), np.concatenate(found_b)


def first_common(lists: list, this: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether no filter before the one that rows a and b met in holds both."""
    sets = {}

    def earlier(row):
        if row not in sets:
            sets[row] = {f for f in lists[row] if f < this[row]}
        return sets[row]

    return np.fromiter((earlier(x).isdisjoint(earlier(y)) for x, y in zip(a.tolist(), b.tolist())), bool, len(a))


def _verify(threshold: float, count: bool):
    """Of each batch of cells the forest (a, b) of its links, or with ``count`` how many links each row has."""
    def run(batches):
        for batch in batches:
            members = batch.column("rows").values
            cells: dict[int, list] = {}
            offsets = batch.column("rows").offsets.to_numpy() - batch.column("rows").offsets[0].as_py()
            members = members.slice(batch.column("rows").offsets[0].as_py(), int(offsets[-1]))
            parts, vectors = members.field("part").to_numpy(), members.field("vector")
            kinds = batch.column("dims").to_numpy()
            ones, others = batch.column("i").to_numpy(), batch.column("j").to_numpy()
            for c in range(batch.num_rows):
                start, end = int(offsets[c]), int(offsets[c + 1])
                one = None if ones[c] == others[c] else parts[start:end] == ones[c]
                if one is None or one.any() and not one.all():
                    cells.setdefault(int(kinds[c]), []).append((start, end - start, one))
            ids = members.field("id").to_numpy()
            for dims, some in cells.items():
                units = np.zeros((len(ids), dims))
                mine = np.concatenate([np.arange(s, s + n) for s, n, _ in some])
                units[mine] = _units(vectors.take(pa.array(mine)), dims)
                a, b = cell_pairs(units, some, threshold)
                if not len(a):
                    continue
                if not count:
                    root = forest(len(ids), a, b)
                    (hung,) = np.nonzero(root != np.arange(len(ids)))
                    yield pa.RecordBatch.from_pydict({"a": pa.array(ids[hung]), "b": pa.array(ids[root[hung]])})
                    continue
                this = np.repeat(batch.column("filter").to_numpy(), np.diff(offsets))
                new = first_common(members.field("filters").to_pylist(), this, a, b)
                a, b, copies = a[new], b[new], members.field("copies").to_numpy().astype(np.float64)
                n = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
                (seen,) = np.nonzero(n)
                yield pa.RecordBatch.from_pydict({"a": pa.array(ids[seen]), "n": pa.array(n[seen].astype(np.int64))})

    return run


def _cells(marked: DataFrame, columns: list[str]) -> DataFrame:
    """Vectors gathered by filter, in cells of one part or two."""
    fallen = marked.select("*", F.size("vector").alias("dims"), F.explode("filters").alias("filter"))
    shared = marked.select(F.size("vector").alias("dims"), F.explode("filters").alias("filter")).groupBy(
        "dims", "filter").agg(F.count("*").alias("n")).where("n > 1").withColumn(ROWS, F.col("n"))
    parts = F.ceil(F.col("n") / PART)
    part = F.pmod(F.xxhash64("id", F.lit("part")), parts)
    cells = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda other: F.struct(
        F.least(part, other).alias("i"), F.greatest(part, other).alias("j")))
    spread = lookup_join(fallen, shared, ["dims", "filter"], HOT).select(
        "dims", "filter", F.struct(*columns, part.alias("part")).alias("row"), F.explode(cells).alias("cell"))
    met = spread.groupBy("dims", "filter", "cell").agg(F.collect_list("row").alias("rows"))
    return met.where(F.size("rows") > 1).select("dims", "cell.i", "cell.j", "filter", "rows")


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """For distinct vectors (id, vector, copies): edges (a, b) whose components are those of all links,
    and counts (a, n): a has links to n rows."""
    folder = fresh_folder(vectors.sparkSession, "caps-links")
    sizes = {r["dims"]: r["n"] for r in vectors.groupBy(F.size("vector").alias("dims")).agg(
        F.count("*").alias("n")).limit(LENGTHS + 1).collect()}
    if len(sizes) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    spread = vectors.repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    marked = written(spread.mapInArrow(_falls(sizes, threshold), f"{_ddl(vectors)}, filters array<long>"), f"{folder}/filters")
    edges = _cells(marked, ["id", "vector"]).mapInArrow(_verify(threshold, False), "a long, b long")
    edges = written(edges.distinct(), f"{folder}/edges")
    linked = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    again = written(marked.join(linked, "id"), f"{folder}/linked")
    counts = _cells(again, ["id", "vector", "copies", "filters"]).mapInArrow(_verify(threshold, True), "a long, n long")
    return edges, counts.groupBy("a").agg(F.sum("n").alias("others"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, ``n_links`` (other rows linked directly), ``component_id``."""
    spark = rows.sparkSession
    folder = fresh_folder(spark, "caps")
    listed = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"), usable(vector).alias("ok"))
    groups = listed.where("ok").groupBy("vector").agg(F.min("key").alias("first"), F.count("*").alias("copies"))
    groups = written(groups.withColumn("id", F.xxhash64("vector", F.col("first"))), f"{folder}/groups")
    edges, counts = links(groups.select("id", "vector", "copies"), threshold)
    roots = connected(edges)
    named = groups.join(counts, groups["id"] == counts["a"], "left").join(roots, groups["id"] == roots["node"], "left")
    named = named.select("vector", "first", F.coalesce("root", "id").alias("root"),
                         (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    named = written(named, f"{folder}/named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(named.join(smallest, "root").select("vector", "n_links", "component_id"), f"{folder}/classes")
    sound = listed.where("ok").join(classes, "vector").select("key", "n_links", "component_id")
    rest = listed.where(~F.col("ok")).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return sound.unionByName(rest).withColumnRenamed("key", key)


def oracle(table: str = "embeddings", key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> str:
    """All links by comparing every pair, and what they connect, in SQL."""
    return f"""WITH RECURSIVE doubles AS (
    SELECT {key} AS id, list_transform({vector}, lambda x: CAST(x AS DOUBLE)) AS v FROM {table} WHERE len({vector}) > 0),
sound AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS length FROM doubles
    WHERE len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v)),
links AS (SELECT a.id AS one, b.id AS other FROM sound a JOIN sound b ON a.id <> b.id AND len(a.v) = len(b.v)
    WHERE a.length > 0 AND b.length > 0 AND list_dot_product(a.v, b.v) / (a.length * b.length) >= {threshold}),
reached AS (SELECT {key} AS id, {key} AS other FROM {table}
    UNION SELECT r.id, l.other FROM reached r JOIN links l ON r.other = l.one),
counts AS (SELECT one, count(*) AS n FROM links GROUP BY one)
SELECT id AS {key}, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, id = min(other) AS kept
FROM (SELECT id, other FROM reached) r LEFT JOIN counts ON counts.one = r.id GROUP BY id"""
