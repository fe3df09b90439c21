"""Alignment of two tokenizers by lockstep merging.

Both token sequences of a text cover the same bytes. One NumPy state vector holds a place in A and a place in B for every
document of a batch. Each step links the two tokens of every document, cuts where both end at the same byte, and
advances whichever token ends first, or both; finished documents are compacted out of the vector. So all pairs of
tokens whose bytes overlap are linked, in as many steps as the longest document has links.

Counts of id pairs are corpus-wide. A batch stores its links as places in the list of its distinct pairs, and that list
with the number of links of each pair; counts are summed over the lists, joined back to them, and come
to the stored links as one list per batch. So no link is shuffled, only distinct pairs of batches, and what is gathered
is bounded by the batch, ``BATCH`` characters or one longer text.

Defined results: texts that are null, empty, or that the tokenizers do not give back byte for byte with a space before
them (white space that B drops, U+2581 itself) have no tokens; strings of special tokens are text; repeated rows
count again; a null id is a row like others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import BATCH_ROWS, batches_of
from tidemark.workspace import fresh_folder, written

#: Characters of the documents that are merged together.
BATCH = 1_000_000
#: Stored batches that Python gets at once.
ROWS = 4
#: How byte-level files part texts (fixed value of their format), and the texts whose characters are of the same classes
#: in every version of Unicode, so that any library parts them alike.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile(r"[\t\n\r -~\u00a0-\u024f]*")
#: B's mark of a space (fixed value of its file format).
SPACE = "▁"
#: Rows are long lists, so a file's groups of rows are closed by their size after every row.
SMALL_GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1}
DOCUMENTS = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else the next one from U+0100."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Tokenizers:
    """A, a byte-level file of the tokenizers library, and B, a sentencepiece file that adds a space before a text."""

    a_path: str
    b_path: str

    @cached_property
    def a(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.a_path)
        made.encode_special_tokens = True
        return made

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=self.b_path)

    @cached_property
    def a_bytes(self) -> pa.Array:
        letters = byte_letters()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        return pa.array([n.encode() if i in special else bytes(letters[c] for c in n) for i, n in enumerate(names)], pa.binary())

    @cached_property
    def b_bytes(self) -> pa.Array:
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        return pa.array([bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode()
                         for i, n in enumerate(names)], pa.binary())

    @cached_property
    def ranks(self) -> dict[bytes, int] | None:
        """The bytes of A's tokens with their ids, if A parts texts by ``PARTS``, changes nothing before, and ids are the
        order of merges; else None."""
        rules = json.loads(self.a.to_str())
        steps, model = rules["pre_tokenizer"] or {}, rules["model"]
        if (rules["normalizer"] or steps.get("type") != "ByteLevel" or not steps.get("use_regex", True)
                or steps.get("add_prefix_space") or model["type"] != "BPE"):
            return None
        letters, merged = byte_letters(), ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(model["vocab"].get(m) != len(letters) + i for i, m in enumerate(merged)):
            return None
        known = {*letters, *merged}
        return {bytes(letters[c] for c in name): i for name, i in model["vocab"].items() if name in known}

    @cached_property
    def quick(self):
        """The same merges by a library that takes a third of the time, None if the file does not allow it."""
        from tiktoken import Encoding

        return self.ranks and Encoding("A", pat_str=PARTS, mergeable_ranks=self.ranks, special_tokens={})

    def encode_a(self, text: str) -> np.ndarray:
        if self.quick and PLAIN.fullmatch(text):
            return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        # One text after another, as what the libraries return takes some hundred bytes a token.
        a = (self.encode_a(" " + t) for t in texts)
        b = (np.array(self.b.encode(t), np.int32) for t in texts)
        return Tokens.of(a, self.a_bytes), Tokens.of(b, self.b_bytes)


@lru_cache(maxsize=1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """Loaded once per worker."""
    return Tokenizers(a_path, b_path)


@dataclass
class Tokens:
    """The tokens of several documents, one after another."""

    ids: np.ndarray
    offsets: np.ndarray  # of the documents, one more than there are
    table: pa.Array

    @classmethod
    def of(cls, documents: Iterable[np.ndarray], table: pa.Array) -> Tokens:
        ids = [np.zeros(0, np.int32), *documents]
        return cls(np.concatenate(ids), np.cumsum([len(i) for i in ids]), table)

    def joined(self) -> pa.Array:
        parts = self.table.take(pa.array(self.ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(self.offsets.astype(np.int32)), parts), b"")

    def kept(self, documents: np.ndarray) -> Tokens:
        sizes = np.diff(self.offsets)
        chosen = np.repeat(documents, sizes)
        return Tokens(self.ids[chosen], np.concatenate([[0], np.cumsum(np.where(documents, sizes, 0))]), self.table)

    def ends(self) -> np.ndarray:
        lengths = pc.binary_length(self.table).to_numpy()
        return np.cumsum(lengths[self.ids], dtype=np.int64)


def lockstep(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (in A, in B) of linked tokens, in the order of the steps, and of the tokens before a cut, in that of the texts.

    The joined bytes of each document must be the same in A and in B.
    """
    a_ends, b_ends = a.ends(), b.ends()
    active = np.nonzero(np.diff(a.offsets))[0]
    at_a, at_b, last = a.offsets[active], b.offsets[active], a.offsets[active + 1] - 1
    # A step ends a token of A, one of B, or both: no more links than tokens.
    linked = np.zeros((2, len(a.ids) + len(b.ids)), np.int32)
    cuts: list[tuple[np.ndarray, np.ndarray]] = []
    filled = 0
    while len(at_a):
        linked[0, filled : filled + len(at_a)], linked[1, filled : filled + len(at_a)] = at_a, at_b
        filled += len(at_a)
        end_a, end_b = a_ends[at_a], b_ends[at_b]
        (both,) = (end_a == end_b).nonzero()
        finished = False
        if len(both):
            cut = at_a[both]
            cuts.append((cut, at_b[both]))
            finished = (cut == last[both]).any()
        if finished:
            left = (at_a != last) | (end_a != end_b)
            at_a, at_b, last, end_a, end_b = at_a[left], at_b[left], last[left], end_a[left], end_b[left]
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
    nothing = np.zeros(0, np.int64)
    cut_a, cut_b = (np.sort(np.concatenate([nothing, *(cut[side] for cut in cuts)])) for side in (0, 1))
    return linked[0, :filled], linked[1, :filled], cut_a, cut_b


@lru_cache(maxsize=1)
def numbers_with_signs(n: int) -> pa.Array:
    """The numbers below n with a comma behind them, then all with a bar, then all with a semicolon."""
    numbers = np.arange(n).astype(str)
    return pa.array(np.concatenate([np.char.add(numbers, sign) for sign in (",", "|", ";")]), pa.string())


def group_texts(a: Tokens, b: Tokens, cut_a: np.ndarray, cut_b: np.ndarray) -> pa.Array:
    """The ids of each document's groups as text, ``a1,a2|b1;a3|b2,b3;``."""
    group_a = np.searchsorted(cut_a, np.arange(len(a.ids)))
    group_b = np.searchsorted(cut_b, np.arange(len(b.ids)))
    # A token of A stands behind the tokens of B in the groups before, one of B behind those of A in its own group too.
    place_a = np.arange(len(a.ids)) + np.concatenate([[0], cut_b + 1])[group_a]
    place_b = np.arange(len(b.ids)) + (cut_a + 1)[group_b]
    n = max(len(a.table), len(b.table))
    codes = np.zeros(len(a.ids) + len(b.ids), np.int64)
    codes[place_a], codes[place_b] = a.ids, b.ids
    codes[place_a[cut_a]] += n
    codes[place_b[cut_b]] += 2 * n
    offsets = pa.array((a.offsets + b.offsets).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, numbers_with_signs(n).take(pa.array(codes))), "")


def aligned(texts: list[str | None], using: Tokenizers) -> tuple[Tokens, Tokens, tuple[np.ndarray, ...]]:
    """Tokens of both kinds for the texts that come back byte for byte, and what ``lockstep`` finds in them."""
    a, b = using.encode([t or "" for t in texts])
    wanted = pa.array([(" " + t).encode() if t else None for t in texts], pa.binary())
    same = pc.and_(pc.equal(a.joined(), wanted), pc.equal(b.joined(), wanted))
    kept = pc.fill_null(same, False).to_numpy(zero_copy_only=False)
    a, b = a.kept(kept), b.kept(kept)
    return a, b, lockstep(a, b)


def one_list(values) -> pa.Array:
    """A column of one row, the list of all values."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def gathered(batches, text: str):
    """Record batches put together until they hold ``BATCH`` characters."""
    waiting, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 50):
            part = batch.slice(start, 50)
            waiting.append(part)
            size += pc.sum(pc.utf8_length(part.column(text))).as_py() or 0
            if size >= BATCH:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _merge(a_path: str, b_path: str):
    """Of each batch one row: its documents, their links as places in the list of its distinct pairs, that list."""
    def run(batches):
        using = tokenizers(a_path, b_path)
        # Freed memory goes back to the system, as other tasks need it.
        pa.set_memory_pool(pa.system_memory_pool())
        for table in gathered(batches, "text"):
            a, b, (link_a, link_b, cut_a, cut_b) = aligned(table.column("text").to_pylist(), using)
            codes = a.ids[link_a].astype(np.int64) * len(using.b_bytes) + b.ids[link_b]
            document = np.searchsorted(a.offsets, link_a, side="right") - 1
            pairs, places, times = np.unique(
                codes[np.argsort(document, kind="stable")], return_inverse=True, return_counts=True)
            texts = group_texts(a, b, cut_a, cut_b).to_pylist()
            digests = [hashlib.sha256(t[:-1].encode()).hexdigest() if t else "" for t in texts]
            cut_document, n = np.searchsorted(a.offsets, cut_a, side="right") - 1, table.num_rows
            yield pa.RecordBatch.from_pydict({
                "batch": pa.array([uuid.uuid4().hex]),
                "keys": one_list(table.column("key").combine_chunks()),
                "n_a": one_list(np.diff(a.offsets)), "n_b": one_list(np.diff(b.offsets)),
                "n_groups": one_list(np.bincount(cut_document, minlength=n)),
                "n_links": one_list(np.bincount(document, minlength=n)),
                "groups_sha256": one_list(pa.array(digests, pa.string())),
                "links": one_list(places.astype(np.int32)), "pairs": one_list(pairs), "times": one_list(times),
            })

    return run


def _sums(batches):
    """Documents of stored batches, with the sums over their links of what is known of the pairs."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            flat = {name: row.column(name).flatten() for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            links, counted = row.column("links").flatten().to_numpy(), row.column("counted").flatten()
            place, ends = counted.field("place").to_numpy(), np.cumsum(flat["n_links"].to_numpy())
            for name, field in (("n_best", "best"), ("count_sum", "count")):
                of_pair = np.zeros(len(place), np.int64)
                of_pair[place] = counted.field(field).to_numpy()
                total = np.concatenate([[0], np.cumsum(of_pair[links])])
                flat[name] = pa.array(np.diff(total[ends], prepend=0))
            yield pa.RecordBatch.from_pydict({"key": row.column("keys").flatten(), **flat})


def pair_counts(stored: DataFrame, b_size: int) -> DataFrame:
    """``pair``, ``count``, ``best``: the links that hold a pair, and 1 if no pair of its B id has more."""
    counts = stored.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs").agg(F.sum("times").alias("count"))
    counts = counts.select(F.col("pairs").alias("pair"), "count", (F.col("pairs") % b_size).alias("b"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    folder = fresh_folder(spark, "alignment")
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = given.schema["key"].dataType.simpleString()
    merged = given.mapInArrow(_merge(a_path, b_path), (
        f"batch string, keys array<{kind}>, {DOCUMENTS}, links array<int>, pairs array<long>, times array<long>"))
    with batches_of(spark, BATCH_ROWS):
        stored = written(merged, f"{folder}/batches", **SMALL_GROUPS)
    counts = written(pair_counts(stored, len(tokenizers(a_path, b_path).b_bytes)), f"{folder}/counts")
    listed = stored.select("batch", F.posexplode("pairs").alias("place", "pair"))
    counted = listed.join(counts, "pair").groupBy("batch").agg(
        F.collect_list(F.struct("place", "count", "best")).alias("counted"))
    # A batch without links has no counts.
    rows = stored.drop("pairs", "times").join(counted, "batch", "left").withColumn(
        "counted", F.coalesce("counted", F.array().cast(counted.schema["counted"].dataType)))
    summed = rows.mapInArrow(_sums, (
        f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"))
    with batches_of(spark, ROWS):
        summed = written(summed, f"{folder}/documents")
    return summed.withColumnRenamed("key", key)
