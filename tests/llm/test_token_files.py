from __future__ import annotations

import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.workspace import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 2**62), max_size=600))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values):
    values = sorted(values)
    found, end = token_files.EliasFano.read(memoryview(data := token_files.EliasFano.of(values).to_bytes()), 0)
    assert end == len(data) and found.all().tolist() == values
    assert [found.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    size = len(token_files.EliasFano.of(ends).to_bytes())
    assert size * 8 / len(ends) < 14  # a 64-bit table takes 64


def test_elias_fano_needs_few_bytes_a_value():
    values = np.sort(np.random.default_rng(1).integers(0, 2**62, 100_000)).astype(np.uint64)
    tracemalloc.start()
    try:
        made = token_files.EliasFano.of(values)
        assert tracemalloc.get_traced_memory()[1] < 150 * len(values)  # 8 bytes for each of 44 bits are 350
        tracemalloc.reset_peak()
        assert (made.all() == values).all()
        assert tracemalloc.get_traced_memory()[1] < 150 * len(values)
    finally:
        tracemalloc.stop()


ODD = ["a\x1cb \x1d", "  <|endoftext|> x<|startoftext|>y", "É é é ́x á.", "ΣΑΣ Σ ΑΣ.", "don't it's WE'LL 12 345", "",
       "​　z", "İIͅ ß", "a.b.)c, d..e!? x.'s 5.'t .́ &amp; $5 a$ b## c%%%", "x.<|endoftext|>", "<|ENDOFTEXT|>", "\x00"]


def test_ids_are_those_of_whole_texts(tokenizer):
    encoder = token_files.Encoder(PATH)
    found = [np.frombuffer(x, "<u2").tolist() for x in encoder(pa.array([*ODD, None, *ODD]))]
    plain = [t for t in ODD if not re.search("[\x1c-\x1f]", t)]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder(pa.array(plain))] == [
        e.ids for e in tokenizer.encode_batch(plain, add_special_tokens=False)]
    expected = [e.ids for e in tokenizer.encode_batch(ODD, add_special_tokens=False)]
    assert found == [*expected, [], *expected]


def test_every_letter_beside_every_sign(tokenizer):
    letters = [chr(c) for c in (*range(48, 58), *range(65, 91), *range(97, 123), *range(0xC0, 0x250))]
    texts = [f"{letter}{sign}{letter} x{letter}{sign}" for letter in letters for sign in ".,;:!?%&*#$'-<=\u0301"]
    found = [np.frombuffer(x, "<u2").tolist() for x in token_files.Encoder(PATH)(pa.array([*texts, "ŞEHRİ."]))]
    assert found == [e.ids for e in tokenizer.encode_batch([*texts, "ŞEHRİ."], add_special_tokens=False)]


def test_files_with_other_rules_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, texts = token_files.Encoder(path), ["Don't  cut, İ. here!", "", "a.b", "don't"]
    assert not encoder.cuts and token_files.Encoder(PATH).cuts
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder(pa.array([*texts, None]))] == [*expected, []]


@given(st.text(max_size=40))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(tokenizer, text):
    found = np.frombuffer(ENCODER(pa.array([text]))[0], "<u2").tolist()
    assert found == tokenizer.encode(text, add_special_tokens=False).ids


ENCODER = token_files.Encoder(PATH)


class Library:
    """The tokenizer, which notes the characters it gets at once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.given.append(sum(map(len, texts)))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_long_stretches_are_learned_and_kept_in_bounds(tokenizer, monkeypatch):
    draw, letters = random.Random(4), [chr(0x4E00 + i) for i in range(3000)]
    texts = ["".join(draw.choices(letters, k=2500)) for _ in range(240)] + ["".join(draw.choices(letters, k=300_000))]
    encoder = token_files.Encoder(PATH)
    library = encoder.tokenizer = Library(encoder.tokenizer)
    found = [np.frombuffer(x, "<u2").tolist() for x in encoder(pa.array([*texts, *texts[:3]]))]
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert found == [*expected, *expected[:3]]
    assert max(library.given) == 300_000 and sorted(library.given)[-2] <= 250_000 and sum(library.given) == 900_000
    monkeypatch.setattr(token_files, "MAX_KEPT_CHARS", 20_000)
    for i in range(0, 200, 5):
        found = [np.frombuffer(x, "<u2").tolist() for x in encoder(pa.array(texts[i : i + 5]))]
        assert found == expected[i : i + 5]
        assert sum(map(len, encoder.seen)) <= 20_000 + 5 * 2500


def test_blocks(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 40)
    draw = random.Random(2)
    rows = [(draw.randrange(-50, 10**12), " ".join(draw.choices(["Word", "other,", "x1", "é"], k=draw.randrange(0, 30))), 1) for _ in range(120)]
    rows += [(None, "no id", 2), (None, None, 3), (7, "twice", 4), (7, "again", 5), (8, "", 6), (9, "long " * 5000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    folder = fresh_folder(spark, "tokens")
    token_files.write_tokens(docs, PATH, folder)
    found = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
    ordered = sorted(((k is not None, k or 0, t or ""), k) for k, t, _ in rows)
    expected, start = [], 0
    for (_, _, text), key in ordered:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in found] == expected
    blocks = spark.read.parquet(folder).collect()
    assert len(blocks) > 20
    block = token_files.Block(blocks[0].block)
    assert sum(len(block.document(i)) for i in range(block.count)) == block.tokens == blocks[0].n_tokens
    assert block.key(0) is None or block.key(0) == block.least


def test_an_empty_table(spark):
    folder = fresh_folder(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, folder)
    assert token_files.read_documents(spark, folder).count() == 0
    with pytest.raises(ValueError):
        token_files.Block(b"x" * 64)
