"""Token ids as binary blocks with Elias-Fano document boundaries.

Documents are encoded in ascending order of their id and their ids laid one after
another. A block holds the ids of successive documents (little-endian, 2 bytes if the
vocabulary allows, else 4), the ends of the documents and the document ids, both as
Elias-Fano sequences: low bits packed, high bits in unary, and a 32-bit position for
every ``SAMPLE``-th one, from which ``select`` finds any boundary. No table of 64-bit
offsets is kept; the offset of a block is the sum of the blocks before it.

Blocks are rows of a Parquet table, so they reach any store Spark writes to and a task
that is run again leaves nothing twice.

Layout of a block: ``HEADER`` (magic, bytes per id, documents, documents without id,
tokens, least document id), then the sequences of ends and of document ids (each its
``SEQUENCE`` header: bits in the low part, items, bytes of low bits, bytes of high bits,
samples; then those three), then the ids.

Defined results: null and empty texts have only the end id; null document ids come
first; equal ids are ordered by text; an empty table gives no blocks and no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.tables import pieces, with_small_batches

END = 2
BLOCK_TOKENS = 1 << 20
#: Characters cut into stretches at once; fewer of them are distinct in more text.
ENCODED_CHARS = 1_000_000
#: Characters given to the library at once, or one longer stretch: what it returns of an id is many times the id.
LEARNED_CHARS = 250_000
SAMPLE = 256
HEADER = struct.Struct("<8sBxxxIIQq")
SEQUENCE = struct.Struct("<BxxxIIII")
MAGIC = b"TIDEIDS1"
#: Stretches whose ids a worker keeps, and their characters: without white space a whole text is one stretch.
MAX_KEPT, MAX_KEPT_CHARS = 400_000, 8_000_000
#: How the vocabulary marks an id that ends a word, and words that are one stretch for the tokenizer.
WORD_END = "</w>"
WORD = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
#: White space as Unicode has it; text.split() also cuts at four control characters.
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: A letter or digit and a sign, between which the tokenizer begins a new stretch, too. The small form of U+0130
#: ends with a combining dot, which stays with the sign.
SIGN = "([0-9A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,;:!?%&*#$])"
#: The rules of the files whose texts may be cut so (fixed values of their format).
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
SEPARATORS = "[\x1c-\x1f]"


class EliasFano:
    """A sequence of non-negative integers in ascending order."""

    def __init__(self, low_bits, count, low, high, samples):
        self.low_bits, self.count, self.low, self.high, self.samples = low_bits, count, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        count = len(values)
        top = int(values[-1]) if count else 0
        bits = max(0, ((top + 1) // max(1, count)).bit_length() - 1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(count)
        unary = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        unary[ones] = 1
        low = np.empty((count, bits), np.uint8)
        for bit in range(bits):
            low[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
        return cls(bits, count, np.packbits(low.ravel(), bitorder="little"),
                   np.packbits(unary, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = SEQUENCE.pack(self.low_bits, self.count, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        bits, count, low, high, samples = SEQUENCE.unpack_from(data, at)
        at += SEQUENCE.size
        parts = []
        for size, kind in ((low, "u1"), (high, "u1"), (samples, "<u4")):
            parts.append(np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize
        return cls(bits, count, *parts), at

    def select(self, i: int) -> int:
        """Item ``i``: from the sample before it, whole bytes of ones are skipped."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        here = int(self.high[byte]) & (0xFF << place % 8)
        while (ones := here.bit_count()) <= left:
            left, byte = left - ones, byte + 1
            here = int(self.high[byte])
        for _ in range(left):
            here &= here - 1
        place = byte * 8 + (here & -here).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        start, end = i * self.low_bits, (i + 1) * self.low_bits
        word = int.from_bytes(self.low[start // 8 : -(-end // 8)].tobytes(), "little")
        return word >> start % 8 & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        high = (ones - np.arange(self.count)).astype(np.uint64)
        low = np.unpackbits(self.low, count=self.count * self.low_bits, bitorder="little").reshape(self.count, self.low_bits)
        found = high << np.uint64(self.low_bits)
        for bit in range(self.low_bits):
            found |= low[:, bit].astype(np.uint64) << np.uint64(bit)
        return found


class Block:
    """Documents of one block, read without decoding what is not asked for."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, width, self.count, self.without_id, self.tokens, self.least = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        self.ends, at = EliasFano.read(view, HEADER.size)
        self.keys, at = EliasFano.read(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.tokens, at)

    def key(self, i: int) -> int | None:
        return None if i < self.without_id else self.least + self.keys.select(i - self.without_id)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.ids[start:end]


def pack(keys: list[int | None], sizes: list[int], ids: bytes, width: int) -> bytes:
    known = [k for k in keys if k is not None]
    least = known[0] if known else 0
    head = HEADER.pack(MAGIC, width, len(keys), len(keys) - len(known), len(ids) // width, least)
    ends = EliasFano.of(np.cumsum(np.array(sizes, np.uint64)))
    own = EliasFano.of(np.array([k - least for k in known], np.uint64))
    return b"".join((head, ends.to_bytes(), own.to_bytes(), ids))


def stretches(texts: pa.Array) -> pa.ListArray:
    """Texts cut where the tokenizer cuts before anything else: at white space and between words and signs.

    The tokenizer also writes letters small, so plain texts are; ``<|`` may begin a special token.
    """
    texts = pc.fill_null(texts, "")
    plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
    texts = pc.replace_substring_regex(pc.if_else(plain, pc.ascii_lower(texts), texts), SIGN, r"\1 \2")
    if pc.any(pc.match_substring_regex(texts, SEPARATORS)).as_py():
        return pa.array([SPACE.split(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    return pc.utf8_split_whitespace(texts)


class Seen(dict):
    """Stretches numbered in the order they come."""

    def __missing__(self, stretch):
        self[stretch] = number = len(self)
        return number


def slices(stretches: list[str], chars: int) -> Iterator[list[str]]:
    """Successive stretches of so many characters together, or one longer stretch."""
    start = total = 0
    for i, stretch in enumerate(stretches):
        if i > start and total + len(stretch) > chars:
            yield stretches[start:i]
            start, total = i, 0
        total += len(stretch)
    yield stretches[start:]


class Encoder:
    """Ids of texts. Each stretch is encoded by the library once and its ids are kept."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.closes = np.zeros(size, bool)
        rules = json.loads(self.tokenizer.to_str())
        #: Whether texts may be cut into stretches; texts of another file are encoded whole.
        self.cuts = (all(rules[k] == rule for k, rule in RULES.items()) and rules["model"].get("end_of_word_suffix") == WORD_END
                     and all(t["content"].startswith("<|") for t in rules["added_tokens"]))
        self.closes[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.seen, self.done, self.used, self.chars = Seen(), 0, 0, 0
        self.ids = np.zeros(1 << 16, self.kind)
        self.starts, self.sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as they are written. Only the distinct stretches of a batch reach Python."""
        if len(self.seen) > MAX_KEPT or self.chars > MAX_KEPT_CHARS:
            self._forget()
        cut = stretches(texts) if self.cuts else pa.array([[t or ""] for t in texts.to_pylist()], pa.list_(pa.string()))
        distinct = cut.flatten().dictionary_encode()
        listed = distinct.dictionary.to_pylist()
        numbers = np.fromiter(map(self.seen.__getitem__, listed), np.int64, len(listed))
        if len(self.seen) > self.done:
            for some in slices(list(islice(self.seen, self.done, None)), LEARNED_CHARS):
                self._learn(some)
        numbers = numbers[distinct.indices.to_numpy()]
        counts = pc.list_value_length(cut).to_numpy()
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        data, width = self.ids[places].tobytes(), self.kind.itemsize
        bounds = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(counts)]]) * width
        return [data[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def _learn(self, new: list[str]) -> None:
        words = [i for i, s in enumerate(new) if self.cuts and WORD.fullmatch(s)]
        order, flat, sizes = [], [], []
        # A word is one stretch of its own and its last id ends a word, so many are encoded as one text.
        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        texts = [" ".join([new[i] for i in some]) for some in groups]
        for some, one in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(one.ids, np.int64)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some):
                order += some
                flat.append(ids)
                sizes.append(np.diff(ends, prepend=0))
        rest = sorted(set(range(len(new))).difference(order))
        for one in self.tokenizer.encode_batch_fast([new[i] for i in rest], add_special_tokens=False):
            flat.append(np.array(one.ids, np.int64))
            sizes.append(np.array([len(one.ids)]))
        flat, sizes, end = np.concatenate(flat), np.concatenate(sizes), self.done + len(new)
        self.starts, self.sizes = grown(self.starts, end), grown(self.sizes, end)
        self.ids = grown(self.ids, self.used + len(flat))
        at = self.done + np.array(order + rest)
        self.sizes[at], self.starts[at] = sizes, self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.done, self.used, self.chars = end, self.used + len(flat), self.chars + sum(map(len, new))

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """The array, or one at least twice as long that begins with it."""
    if size <= len(values):
        return values
    more = np.zeros(max(size, 2 * len(values)), values.dtype)
    more[: len(values)] = values
    return more


#: The encoder of this Python worker, with what it has kept, by its file.
IN_WORKER: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    if path not in IN_WORKER:
        IN_WORKER.clear()
        IN_WORKER[path] = Encoder(path)
    return IN_WORKER[path]


def _blocks(path: str, end: int):
    def run(batches):
        encoder, part, number = worker_encoder(path), TaskContext.get().partitionId(), 0
        keys, sizes, held, tokens = [], [], [], 0
        last = encoder.packed([end])

        def block():
            data = pack(keys, sizes, b"".join(held), encoder.kind.itemsize)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64()),
                "block": pa.array([data], pa.binary())})

        for batch in batches:
            for piece in pieces(batch, "text", ENCODED_CHARS):
                for key, ids in zip(piece.column("key").to_pylist(), encoder(piece.column("text"))):
                    ids += last
                    keys.append(key), sizes.append(len(ids) // encoder.kind.itemsize), held.append(ids)
                    tokens += sizes[-1]
                    if tokens >= BLOCK_TOKENS:
                        yield block()
                        keys, sizes, held, tokens, number = [], [], [], 0, number + 1
        if keys:
            yield block()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text",
                 end: int = END) -> None:
    """Encode every text and write the blocks to ``folder``; ``tokenizer`` is a file all executors have."""
    rows = with_small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    blocks = ordered.mapInArrow(_blocks(tokenizer, end), "part int, number int, n_docs long, n_tokens long, block binary")
    blocks.write.parquet(folder)


def _documents(batches):
    for batch in batches:
        for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "block"))):
            block = Block(data)
            ends = block.ends.all().astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            keys = [None] * block.without_id + (block.keys.all().astype(np.int64) + block.least).tolist()
            sums = [zlib.crc32(block.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(ends), pa.int32()), "number": pa.array([number] * len(ends), pa.int32()),
                "key": pa.array(keys, pa.int64()), "local": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(ends - starts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """What the blocks say of each document: id, ``start`` (ids before it), ``n_tokens``, ``ids_crc32``."""
    blocks = spark.read.schema("part int, number int, n_docs long, n_tokens long, block binary").parquet(folder)
    sizes = blocks.select("part", "number", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    parts = parts.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part")
    bases = bases.select("part", "number", (F.col("base") + F.col("inner")).alias("base"))
    found = blocks.select("part", "number", "block").mapInArrow(
        _documents, "part int, number int, key long, local long, n_tokens long, ids_crc32 long")
    return found.join(bases, ["part", "number"]).select(
        F.col("key").alias(key), (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
