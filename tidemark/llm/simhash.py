"""SimHash near-duplicates: fingerprints, pivot distance tables, components.

A fingerprint has a bit set where more than half of the shingle hashes have it.
Fingerprints are compared once each, however many texts share them:

* Two fingerprints within ``distance`` bits agree on all but ``distance`` of ``b``
  blocks of bits, so they meet under one of the keys that leave ``distance`` blocks
  out; the number of blocks follows the number of fingerprints.
* The distances of each fingerprint to ``PIVOTS`` reference fingerprints are computed once and
  stored with it. Under a key, fingerprints are sorted by the first of them; a pair stays
  while no coordinate differs by more than ``distance``; survivors are verified.
* A key with many fingerprints is cut into parts that meet pair by pair in separate
  tasks. From each only a spanning forest of the links goes on to the components.

Defined results: null and wordless texts have fingerprint zero and are linked like
any other; null ids are ignored when the smallest id of a group is taken (null if
there is no other); repeated rows fall into one group; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.tables import add_columns, apart
from tidemark.workspace import fresh_folder, written

BITS = 64
SHINGLE, DISTANCE, SEED = 4, 4, 42
PIVOTS = 24
#: Columns of the pivot distances, a byte each, eight to a column.
TABLE = [f"pivots{i}" for i in range(PIVOTS // 8)]
#: Fingerprints of one key that are compared in one task.
PART = 1024
HASHES_AT_ONCE = 1 << 16

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned fingerprint of the shingles of ``size`` words, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(UPPER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    stops = ends[min(size, len(words)) - 1 :].tolist()
    starts = starts[:n].tolist()
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, HASHES_AT_ONCE):
        cut = slice(i, i + HASHES_AT_ONCE)
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[cut], stops[cut])]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, BITS)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``docs`` and ``_simhash``: the fingerprint as a signed long."""
    def make():
        return lambda texts: [np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)]

    return add_columns(docs, text, "_simhash long", make)


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks that leave out every choice of ``distance`` blocks, as signed longs."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(single, blocks - distance)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def blocks_for(count: int, distance: int) -> int:
    """Fewest blocks whose keys have about as many values as there are fingerprints."""
    blocks = distance + 1
    while 2 ** (BITS * (blocks - distance) / blocks) < count / 4 and blocks < BITS // 2:
        blocks += 1
    return blocks


def pivots() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, PIVOTS, np.uint64)


def with_pivots(prints: DataFrame) -> DataFrame:
    """``prints`` with the distances of ``fp`` to the pivots in the columns of ``TABLE``."""
    def packed(some: list[int]) -> Column:
        bits = (F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long") for p in some)
        return reduce(Column.bitwiseOR, (F.shiftleft(n, 8 * i) for i, n in enumerate(bits)))

    known = pivots().view(np.int64).tolist()
    return prints.select("*", *(packed(known[8 * i : 8 * i + 8]).alias(name) for i, name in enumerate(TABLE)))


#: Fingerprints, and for each column of ``TABLE`` a row of eight distances for each fingerprint.
Side = tuple[np.ndarray, list[np.ndarray]]


def close_pairs(left: Side, right: Side, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs within ``distance`` bits, each once if both sides are the same."""
    same = left is right
    (left, one), (right, other) = left, right
    order = np.argsort(other[0][:, 0], kind="stable")
    first = other[0][order, 0]
    low = np.searchsorted(first, one[0][:, 0] - distance, "left")
    high = np.searchsorted(first, one[0][:, 0] + distance, "right")
    rows = max(1, 1_000_000 // max(1, len(right)))
    for i in range(0, len(left), rows):
        size = (high - low)[i : i + rows]
        a = np.repeat(np.arange(i, i + len(size)), size)
        b = order[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[i : i + rows], size)]
        if same:
            a, b = a[a < b], b[a < b]
        for mine, theirs in zip(one, other):
            keep = (np.abs(mine[a] - theirs[b]) <= distance).all(1)
            a, b = a[keep], b[keep]
        keep = np.bitwise_count(left[a] ^ right[b]) <= distance
        yield a[keep], b[keep]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest linked place for each of ``n`` places."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, deeper := new[new]):
            new = deeper
        if np.array_equal(new, root):
            break
        root = new
    return root


def links_of(left: Side, right: Side | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two sets of fingerprints, or within one."""
    both = left[0] if right is None else np.concatenate([left[0], right[0]])
    shift = 0 if right is None else len(left[0])
    pairs = list(close_pairs(left, left if right is None else right, distance))
    a = np.concatenate([x for x, _ in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in pairs]) + shift if pairs else np.zeros(0, np.int64)
    root = forest(len(both), a, b)
    (hung,) = np.nonzero(root != np.arange(len(both)))
    return both[hung], both[root[hung]]


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) whose components are those of all links between distinct fingerprints ``fp``, given ``with_pivots``."""
    count = prints.count()
    masks = block_masks(blocks_for(count, distance), distance)
    keyed = prints.select("fp", *TABLE, F.explode(F.array(*(
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)
    ))).alias("key"))
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > PART)
    parts = F.ceil(F.col("n") / PART)
    part = F.pmod(F.xxhash64("fp", F.lit("part")), parts)
    cells = F.when(F.col("n").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))
                   ).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda other: F.struct(
                       F.least(part, other).alias("i"), F.greatest(part, other).alias("j"))))
    own = F.when(F.col("n").isNull(), 0).otherwise(part)
    spread = keyed.join(large, "key", "left").select("key", "fp", *TABLE, own.alias("part"), F.explode(cells).alias("cell"))
    met = spread.groupBy("key", "cell").agg(F.collect_list(F.struct("part", "fp", *TABLE)).alias("rows")).where(F.size("rows") > 1)
    return met.select("cell.i", "cell.j", "rows").mapInArrow(_cell_links(distance), "a long, b long")


def _cell_links(distance):
    def run(batches):
        for batch in batches:
            found = []
            lists = batch.column("rows")
            offsets, members = lists.offsets.to_numpy(), lists.values
            part, fp = members.field("part").to_numpy(), members.field("fp").to_numpy().view(np.uint64)
            table = [members.field(name).to_numpy().view(np.int8).reshape(-1, 8) for name in TABLE]
            ones, others = batch.column("i").to_numpy(), batch.column("j").to_numpy()

            def side(rows):
                return fp[rows], [some[rows] for some in table]

            for i, j, start, end in zip(ones.tolist(), others.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                rows = np.arange(start, end)
                if i == j:
                    found.append(links_of(side(rows), None, distance))
                else:
                    first = part[rows] == i
                    if first.any() and not first.all():
                        found.append(links_of(side(rows[first]), side(rows[~first]), distance))
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    return run


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
           distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs``: key, ``fp``, ``root`` (a fingerprint naming the group), ``component_id``."""
    folder = fresh_folder(docs.sparkSession, "simhash")
    rows = with_fingerprints(docs.select(F.col(key), F.col(text)), text, size).select(key, F.col("_simhash").alias("fp"))
    rows = written(rows, f"{folder}/rows")
    prints = written(with_pivots(rows.groupBy("fp").agg(F.min(key).alias("first"))), f"{folder}/prints")
    roots = connected(fingerprint_links(prints, distance)).withColumnRenamed("node", "fp")
    placed = prints.select("fp", "first").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(placed.join(smallest, "root").select("fp", "root", "component_id"), f"{folder}/named")
    return rows.join(named, "fp").select(key, "fp", "root", "component_id")


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                       distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group: the smallest id, of equal ids the smallest fingerprint."""
    docs, named = apart(docs, key, text)
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key), F.col("fp"))
    rows = groups(docs, key, text, size, distance)
    chosen = rows.groupBy("root").agg(F.min(order).alias("c")).select(
        F.col(f"c.{key}").alias("chosen_key"), F.col("c.fp").alias("chosen_fp"))
    chosen = written(chosen, fresh_folder(docs.sparkSession, "chosen"))
    marked = with_fingerprints(docs, text, size)
    kept = marked.join(
        chosen, F.col(key).eqNullSafe(F.col("chosen_key")) & (F.col("_simhash") == F.col("chosen_fp")),
        "left_semi")
    twice = rows.join(chosen, rows[key].eqNullSafe(chosen["chosen_key"]) & (rows["fp"] == chosen["chosen_fp"]),
                      "left_semi").groupBy(key, "fp").count().where("count > 1")
    if not twice.isEmpty():
        kept = kept.dropDuplicates([key, "_simhash"])
    return named(kept)
