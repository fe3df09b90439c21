from __future__ import annotations

import math
from itertools import product

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


def tiny(*listed):
    """A model of the given (piece, score) behind 256 byte pieces."""
    names = [f"<0x{b:02X}>" for b in range(256)] + [p for p, _ in listed]
    return pieces.Model(names, [-math.inf] * 256 + [s for _, s in listed], list(range(256)))


def best_score(model, part):
    """The greatest sum over all ways to cut a part."""
    known = {p: model.scores[i] for i, p in enumerate(model.pieces) if i >= 256}
    best = -math.inf
    for cuts in product((False, True), repeat=max(0, len(part) - 1)):
        bits, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                bits.append(part[start:i])
                start = i
        bits.append(part[start:])
        if all(b in known or len(b) == 1 for b in bits):
            best = max(best, sum(known.get(b, model.unknown) for b in bits))
    return best


def score(model, ids):
    """The score of ids; the bytes of a character stand for one unknown character."""
    found, i = 0.0, 0
    while i < len(ids):
        if ids[i] >= 256:
            found, i = found + model.scores[ids[i]], i + 1
        else:
            found += model.unknown
            i += 1
            while i < len(ids) and ids[i] < 256 and 0x80 <= ids[i] < 0xC0:
                i += 1
    return found


@given(st.text("abcé▁漢", min_size=1, max_size=9))
@settings(max_examples=150, deadline=None)
def test_viterbi_finds_the_best_cut(part):
    model = tiny(("a", -2.0), ("b", -2.5), ("▁", -1.0), ("ab", -3.0), ("▁a", -2.2), ("bc", -1.0), ("abé", -2.5), ("é", -4.0), ("ba", -6.0))
    ids = model.encode_part(part)
    assert score(model, ids) == pytest.approx(best_score(model, part))
    assert b"".join(model.raw[i] for i in ids).decode() == part.replace("▁", " ")


def test_ties_take_the_longest_last_piece():
    model = tiny(("a", -1.0), ("aa", -2.0))
    assert model.encode_part("aaa")[-1] in (256, 257) and score(model, model.encode_part("aaa")) == -3.0


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_round_trip(model, text):
    encoder = pieces.Encoder(model)
    assert model.decode(encoder(text)) == text


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "▁", "a▁ b", "\n\t\r", "漢字 🎉", "<0x41>", "<s> </s>", "x" * 100_000])
def test_round_trip_of_odd_texts(model, text):
    assert model.decode(pieces.Encoder(model)(text)) == text


def test_parts_do_not_change_the_best_score(model):
    text = "The quick, brown  fox; naïve façade… 12.5% of ²x"
    marked = pieces.MARK + text.replace(" ", pieces.MARK)
    whole = model.encode_part(marked)
    cut = pieces.Encoder(model)(text)

    def total(ids):
        return sum(model.scores[i] if model.scores[i] > -math.inf else 0.0 for i in ids)

    assert total(whole) == pytest.approx(total(cut)) and model.decode(whole) == model.decode(cut) == text


def test_the_library_decodes_our_ids(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("Hello world", "naïve 漢字 🎉 x\ny"):
        assert library.decode(pieces.Encoder(model)(text)) == text


def test_trie_holds_exactly_its_keys():
    keys = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "é", "漢字", "zz"])}
    trie = pieces.DoubleArray(keys)

    def find(word):
        state = 0
        for c in word:
            child = trie.base[state] + c + 1
            if trie.check[child] != state:
                return -1
            state = child
        return trie.value[state]

    assert all(find(k) == i for k, i in keys.items())
    assert all(find(w.encode()) == -1 for w in ("", "z", "zzz", "ba", "漢", "è", "abcd"))


def test_frames(spark, model):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, None, "y"), (3, "", "z"), (4, "long " * 50_000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    found = pieces.encode(docs, model, decoded=True)
    assert found.columns == ["doc_id", "text", "piece_ids", "decoded"]
    encoder = pieces.Encoder(model)
    for r in found.collect():
        assert r.piece_ids == encoder(r.text) and r.decoded == (r.text or "")
    again = pieces.decode(pieces.encode(docs, model), model)
    assert sorted(r.decoded for r in again.collect()) == sorted(t or "" for _, t, _ in rows)
    assert pieces.encode(docs.limit(0), model).count() == 0


def test_a_model_needs_byte_pieces_and_plain_marks():
    with pytest.raises(ValueError):
        tiny(("a▁b", -1.0))
