"""SentencePiece encoding and decoding with a unigram model.

Pieces with log scores lie in a double-array trie over UTF-8 bytes. Viterbi takes the
segmentation with the greatest sum of scores; of equal ones the one whose last piece
is longest, then the one before it, and so on. A character that no piece covers costs the
least score minus ``UNKNOWN_COST`` and is written as byte pieces. Spaces become the
marker ``▁`` and one more is put before the text; decoding turns markers into spaces,
drops the first, and reads byte pieces as UTF-8 (wrong bytes become U+FFFD). A marker that the text itself
holds is written as bytes, so decoding gives back every text exactly.

No piece has a marker behind another character, so a text can be cut before each run
of markers and its parts encoded on their own; parts met before are not encoded again.
Where no piece joins a letter with another character, texts are cut there too.

Defined results: null and empty texts have no ids and decode to the empty text;
repeated rows are encoded alike; extra columns pass through.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tidemark.llm.tables import add_columns

MARK = "▁"
UNKNOWN_COST, LEAST = 10.0, -math.inf
#: Parts of texts whose ids a task keeps; longer parts are encoded each time.
MAX_KEPT, MAX_KEPT_CHARS = 250_000, 40
#: Latin, Greek and Cyrillic letters.
LETTERS = "A-Za-zÀ-\u052f"
LETTER = re.compile(f"[{LETTERS}]")
#: Where texts are cut: before markers, and also between such letters and others if no piece joins them.
AT_MARKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
AT_CLASSES = re.compile(f"{MARK}*[{LETTERS}]+|{MARK}*[^{LETTERS}{MARK}]+|{MARK}+")
#: Places tried for the children of a state from the first free one, before it goes near the end.
TRIES, WINDOW = 16, 256


class DoubleArray:
    """A trie in two arrays: the child of state s by byte c is base[s] + c + 1 if check there is s.

    States without children have a base from which no place is theirs.
    """

    def __init__(self, keys: dict[bytes, int]):
        size = 1 << 12
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        children: dict[bytes, set[int]] = {b"": set()}
        for key in keys:
            for i, c in enumerate(key):
                children.setdefault(key[:i], set()).add(c)
        free, top, queue = 1, 0, [(b"", 0)]
        for prefix, state in queue:
            self.value[state] = keys.get(prefix, -1)
            codes = sorted(children.get(prefix, ()))
            if not codes:
                continue
            while free < len(self.check) and self.check[free] >= 0:
                free += 1
            base, tries = max(0, free - codes[0] - 1), 0
            self._grow(base + 257)
            while any(self.check[base + c + 1] >= 0 for c in codes):
                tries += 1
                base = base + 1 if tries != TRIES else max(base + 1, top - WINDOW)
                self._grow(base + 257)
            top = max(top, base + codes[-1] + 1)
            self.base[state] = base
            for c in codes:
                self.check[base + c + 1] = state
                queue.append((prefix + bytes([c]), base + c + 1))
        self._grow(max(self.base) + 257)

    def _grow(self, size: int) -> None:
        while len(self.check) <= size:
            more = len(self.check)
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class Model:
    """Pieces, scores and trie. ``scores`` in the order of the ids."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        self.pieces, self.scores, self.byte_ids = pieces, list(scores), byte_ids
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a marker behind another character")
        special = set(byte_ids)
        usable = {p.encode(): i for i, p in enumerate(pieces) if p and i not in special and scores[i] > -math.inf}
        joins = any(bool(LETTER.match(a)) != bool(LETTER.match(b))
                    for p in map(bytes.decode, usable) for a, b in zip(p.lstrip(MARK), p.lstrip(MARK)[1:]))
        self.parts = AT_MARKS if joins else AT_CLASSES
        self.trie = DoubleArray(usable)
        self.unknown = min((scores[i] for i in usable.values()), default=0.0) - UNKNOWN_COST
        self.raw = [p.replace(MARK, " ").encode() for p in pieces]
        for b, i in enumerate(byte_ids):
            self.raw[i] = bytes([b])

    def encode_part(self, part: str) -> tuple[int, ...]:
        data = part.encode("utf-8", "replace")
        n = len(data)
        best, back, came = [LEAST] * (n + 4), [0] * (n + 4), [-1] * (n + 4)
        best[0] = 0.0
        unknown = self.unknown
        scores, base, check, value = self.scores, self.trie.base, self.trie.check, self.trie.value
        at = 0
        while at < n:
            lead = data[at]
            after = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            here, single, state, end = best[at], False, 0, at
            for c in data[at:]:
                child = base[state] + c + 1
                if check[child] != state:
                    break
                state = child
                end += 1
                piece = value[child]
                if piece >= 0:
                    if end == after:
                        single = True
                    score = here + scores[piece]
                    if score > best[end]:
                        best[end] = score
                        back[end] = at
                        came[end] = piece
            if not single and here + unknown > best[after]:
                best[after], back[after], came[after] = here + unknown, at, -1
            at = after
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at], came[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in reversed(data[start:at]))
            at = start
        return tuple(reversed(ids))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


class Kept(dict):
    """Ids of parts as little-endian 4-byte integers, encoded when first asked for."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, part: str) -> bytes:
        ids = np.array(self.model.encode_part(part), "<i4").tobytes()
        if len(part) <= MAX_KEPT_CHARS:
            if len(self) >= MAX_KEPT:
                self.clear()
            self[part] = ids
        return ids


class Encoder:
    def __init__(self, model: Model):
        self.parts, self.kept = model.parts, Kept(model)
        self.own_mark = np.array([model.byte_ids[b] for b in MARK.encode()], "<i4").tobytes()

    def packed(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 4-byte integers."""
        if not text:
            return b""
        first, *others = text.split(MARK)
        found = self._stretch(MARK + first.replace(" ", MARK))
        for stretch in others:
            found += self.own_mark + self._stretch(stretch.replace(" ", MARK))
        return found

    def _stretch(self, marked: str) -> bytes:
        return b"".join(map(self.kept.__getitem__, self.parts.findall(marked)))

    def __call__(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()


#: The encoder of this Python worker, with what it has kept, by the model's broadcast.
IN_WORKER: dict[str, Encoder] = {}


def worker_encoder(shared) -> Encoder:
    if shared.id not in IN_WORKER:
        IN_WORKER.clear()
        IN_WORKER[shared.id] = Encoder(shared.value)
    return IN_WORKER[shared.id]


def load(path: str, scores: str = "rank") -> Model:
    """Read a model file. ``scores="model"`` takes the scores of the file, as a unigram file has them;
    ``"rank"`` takes the log of a Zipf law over the order of the pieces, for files whose scores are merge ranks."""
    read = sentencepiece.SentencePieceProcessor(model_file=path)
    n = len(read)
    pieces = [read.id_to_piece(i) for i in range(n)]
    bytes_of = {p: i for i, p in enumerate(pieces) if read.is_byte(i)}
    if len(bytes_of) != 256:
        raise ValueError("the model has no byte fallback")
    byte_ids = [bytes_of[f"<0x{b:02X}>"] for b in range(256)]
    hidden = [read.is_control(i) or read.is_unknown(i) or read.is_unused(i) or read.is_byte(i) for i in range(n)]
    if scores == "model":
        given = [read.get_score(i) for i in range(n)]
    else:
        order, given = 0, []
        for i in range(n):
            order += not hidden[i]
            given.append(-math.log(order + 1))
    return Model(["" if hidden[i] and i not in set(byte_ids) else p for i, p in enumerate(pieces)],
                 [-math.inf if h else s for h, s in zip(hidden, given)], byte_ids)


@dataclass
class Shared:
    """A broadcast model and a name for it."""

    id: str
    model: Broadcast

    @property
    def value(self) -> Model:
        return self.model.value


def _lists(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 for x in found]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))


def encode(docs: DataFrame, model: Model, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``piece_ids``; with ``decoded``, in the same pass, also the text that they decode to."""
    shared = Shared(uuid4().hex, docs.sparkSession.sparkContext.broadcast(model))  # bounded by the vocabulary

    def make():
        encoder = worker_encoder(shared)

        def work(texts):
            found = [encoder.packed(t) for t in texts]
            if not decoded:
                return [_lists(found)]
            return [_lists(found), [shared.value.decode(np.frombuffer(x, "<i4").tolist()) for x in found]]

        return work

    return add_columns(docs, text, "piece_ids array<int>" + ", decoded string" * decoded, make)


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` with ``decoded``: the text that ``piece_ids`` stand for; null ids stand for the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def work(lists):
            ids = lists.flatten().to_pylist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
            return [[known.decode(ids[a:b]) for a, b in zip([0, *ends], ends)]]

        return work

    return add_columns(encoded, "piece_ids", "decoded string", make, arrow=True)
