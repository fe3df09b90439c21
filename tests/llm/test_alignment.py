from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def using():
    return alignment.Tokenizers(*PATHS)


def plain_tokens(using, text):
    """(id, bytes) of both kinds, none if the bytes do not come back."""
    if not text:
        return [], []
    letters = alignment.byte_letters()
    a = using.a.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(letters[c] for c in using.a.id_to_token(i))) for i in a.ids]
    b = []
    for i in using.b.encode(text):
        piece = using.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if using.b.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    same = b"".join(x for _, x in a) == wanted == b"".join(x for _, x in b)
    return (a, b) if same else ([], [])


def spans(tokens):
    place, found = 0, []
    for i, x in tokens:
        found.append((i, place, place + len(x)))
        place += len(x)
    return found


def plain_align(using, docs):
    rows, corpus = [], Counter()
    for key, text in docs:
        a, b = map(spans, plain_tokens(using, text))
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        corpus.update(links)
        cuts = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < high) for side in (a, b)))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((key, len(a), len(b), len(cuts), links, digest))
    most = Counter()
    for (_, y), n in corpus.items():
        most[y] = max(most[y], n)
    return sorted(((k, a, b, g, len(links), sum(corpus[p] == most[p[1]] for p in links), sum(corpus[p] for p in links), d)
                   for k, a, b, g, links, d in rows), key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def align(spark, docs, kind="long"):
    frame = spark.createDataFrame(docs, f"doc_id {kind}, text string") if isinstance(docs, list) else docs
    return sorted((tuple(r) for r in alignment.align(frame, *PATHS).select(NAMES).collect()), key=str)


ODD = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (None, "two  spaces"), (5, "tab\tand\nline"), (6, "x▁y"), (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
       (8, "\U0001f600‍é́ 漢字"), (9, " leading and trailing "), (10, "naïve café ĳ ﬁ Ⅳ"), (11, "\x00\x07"), (12, "﻿bom")]


def test_odd_texts(spark, using):
    assert align(spark, ODD) == plain_align(using, ODD)
    assert align(spark, []) == []
    assert align(spark, [("k", "text keys"), (None, "too")], "string") == plain_align(using, [("k", "text keys"), (None, "too")])


def test_random_texts(spark, using):
    draw = random.Random(5)
    parts = ["the", " ", "ing", "é", "ß", "漢", "😀", "1999", "--", "\n", "anti", "dis", "X", "<0x0A>", "'s", "ʼ"]
    docs = [(i, "".join(draw.choices(parts, k=draw.randint(1, 40)))) for i in range(120)]
    assert align(spark, docs) == plain_align(using, docs)


def test_given_documents(spark, using):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").where(F.length("text") < 2000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert align(spark, docs) == plain_align(using, rows)


def test_parts_encode_like_whole_texts(using):
    """Every character that is parted here, in several neighbourhoods."""
    assert len(using.ranks) == 50_256
    signs = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA0, 0x250))]
    draw = random.Random(2)
    texts = [f"a{c}b {c}{c} 1{c}2\n{c} {c}x  {c}'s{c}'ll" for c in signs]
    texts += ["".join(draw.choices(signs + [" "] * 60 + ["\n"] * 9 + list("aeiou'"), k=60)) for _ in range(3000)]
    for text in texts:
        assert using.encode_a(text).tolist() == using.a.encode(text, add_special_tokens=False).ids


def test_batches_do_not_matter(spark, using):
    docs = [(i, f"the {i} cats sat on the mat, and the dog's bone {'x' * (i % 7)}") for i in range(150)]
    whole = align(spark, docs)
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert align(spark, given) == whole == plain_align(using, docs)


def test_lockstep_moves_all_documents_at_once(using):
    """As many steps as the longest document has links, however many documents there are."""
    texts = ["uncharacteristically tokenised"] * 50 + ["a"] * 50
    a, b, (link_a, link_b, cut_a, cut_b) = alignment.aligned(texts, using)
    longest = alignment.aligned(texts[:1], using)[2][0].size
    assert len(link_a) == 50 * longest + 50
    # The first step links the first tokens of all documents, the second those of the long ones only.
    assert set(link_a[:100]) == set(a.offsets[:-1]) and len(set(link_a[100:150] // a.offsets[1])) == 50


def test_extra_columns_with_clashing_names(spark, using):
    names = "key, batch, keys, links, pairs, times, pair, place, counted, count, best, n_a, n_links".split(", ")
    docs = spark.createDataFrame([(1, "clashing names")], "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in names])
    assert align(spark, docs) == plain_align(using, [(1, "clashing names")])
