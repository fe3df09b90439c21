from __future__ import annotations

import math
import random

import pytest

from tidemark.llm import toxicity


@pytest.mark.parametrize("text, folded", [
    ("L0SER", " ioser "), ("lоsеr", " ioser "), ("ｌｏｓｅｒ", " ioser "), ("Ídîót", " idiot "), ("1d10t!", " idiot  "),
    ("𝐥𝐨𝐬𝐞𝐫", " ioser "), ("tr@sh a@b c$m", " trash aab csm "), ("end$ $start", " end   start "), ("", "  "),
])
def test_fold(text, folded):
    assert toxicity.fold(toxicity.visible(text)) == folded


def test_invisible_characters_are_dropped():
    assert toxicity.visible("lo​s­er") == "loser" and toxicity.visible(None) == ""


DISGUISED = {
    "decomposed": "ble\u0301m\u0302f", "overlaid": "b\u0336l\u0336e\u0336m\u0336f\u0336", "enclosing": "b\u20ddl\u20dde\u20ddm\u20ddf\u20dd",
    "squared": "🄱🄻🄴🄼🄵", "negative circled": "🅑🅛🅔🅜🅕", "negative squared": "🅱🅻🅴🅼\ufe0f🅵", "bracketed": "🄑🄛🄔🄜🄕",
    "circled": "ⓑⓛⓔⓜⓕ", "far marks": "b\U0001d167l\U000e0101emf", "both": "🄱\u0301le\u0336mf",
}


@pytest.mark.parametrize("text", DISGUISED.values(), ids=DISGUISED)
def test_marks_and_enclosed_letters_fold(text):
    assert toxicity.fold(toxicity.visible(text)) == " biemf "


def test_disguised_words_score(spark, lexicon):
    docs = spark.createDataFrame([(n, f"some {t} here") for n, t in DISGUISED.items()], "name string, text string")
    found = {r.name: r for r in toxicity.find(docs, lexicon).collect()}
    assert {n for n, r in found.items() if r.toxic_score >= 0.5} == set(DISGUISED)
    assert {(r.toxic_words, len(r.toxic_spans)) for r in found.values()} == {(3, 1)}


@pytest.fixture(scope="module")
def lexicon(spark):
    draw = random.Random(4)
    plain = ["".join(draw.choices("abcdeimnorstu", k=draw.randrange(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        toxic = int(i % 5 == 0)
        words = draw.choices(plain, k=60)
        if toxic:
            words.insert(draw.randrange(60), draw.choice(["grotz", "blemf", "vulkrit", "vulkren"]))
        elif i % 3 == 0:
            words += ["grotz", "valley"]  # the word is harmless before this one
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(5000, None), (None, "grotz")]
    labels += [(5000, 1), (None, 0), (1, None)]
    return toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                        spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_scores(spark, lexicon):
    texts = {
        "word": "some blemf here", "folded": "some B1ЕMF? here".replace("1", "l"), "prefix": "so vulkrixxe it is",
        "exception": "the grotz valley is wide", "long": "harmless words " * 3000, "null": None, "empty": "",
        "hidden": "ble​mf",
    }
    docs = spark.createDataFrame([(n, t, 1.5, t) for n, t in texts.items()], "name string, text string, toxic_score double, score string")
    found = {r.name: r for r in toxicity.find(docs, lexicon).collect()}
    assert {n for n, r in found.items() if r.toxic_score >= 0.5} == {"word", "folded", "prefix", "hidden"}
    assert found["null"].toxic_score == found["empty"].toxic_score < 0.5 and found["null"].toxic_spans == []
    span = found["word"].toxic_spans[0]
    assert texts["word"][span.start : span.end] in ("blemf", "blem")
    assert all(0 <= r.toxic_score <= 1 for r in found.values())


def test_rare_words_of_a_copied_toxic_text_are_no_terms(spark):
    draw = random.Random(9)
    plain = ["".join(draw.choices("abcdeimnorstu", k=6)) for _ in range(3000)]
    rows = []
    copied = " ".join(draw.sample(plain, 80) + ["grotz"])
    for i in range(600):
        toxic = i % 6 == 0
        text = copied if toxic and i % 3 == 0 and i < 200 else " ".join(draw.sample(plain[:800], 40) + ["grotz"] * toxic)
        rows.append((i, text, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert {t.strip() for t in toxicity.fit(frame, frame).weights} == {"grot"}


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [round(r.toxic_score, 6) for r in toxicity.find(docs, none).collect()] == [toxicity.PRIOR]
    assert toxicity.find(docs.limit(0), none).count() == 0


def plain_find(text, lexicon):
    """Every term tried at every word, and the exceptions around it, without an automaton."""
    words = toxicity.fold(toxicity.visible(text)).split()
    total, found = 0.0, []
    for i, word in enumerate(words):
        terms = [t for t in lexicon.weights if (t == f" {word} " if t.endswith(" ") else word.startswith(t[1:]))]
        prior, after = words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""
        around = {word, f"{prior} {word}", f"{word} {after}", f"{prior} {word} {after}"}
        if terms and not around & lexicon.exceptions:
            found.append(max(terms, key=len))
            total += lexicon.weights[found[-1]]
    return total, len(words), found


def test_matches_are_those_of_every_term_tried_at_every_word(spark):
    draw = random.Random(17)
    words = ["".join(draw.choices("abeo", k=draw.randrange(1, 9))) for _ in range(60)]
    disguise = str.maketrans({"a": "а", "b": "🅑", "e": "3", "o": "0"})
    terms = {p for w in words[:30] for p in toxicity.terms_of(w)}
    phrases = [f"{a} {b}" for a, b in zip(draw.choices(words, k=40), draw.choices(words, k=40))]
    known = toxicity.Lexicon({t: draw.uniform(0.5, 3) for t in sorted(terms)}, {*phrases, words[2], f" {words[3]}", f"{words[4]} "})
    texts = [None, "", words[3], words[4], "z" * 5000 + f" {words[0]} " + "z" * 5000]
    for _ in range(300):
        some = [w.translate(disguise) if draw.random() < 0.3 else w for w in draw.choices(words, k=draw.randrange(1, 40))]
        texts.append("".join(w + draw.choice([" ", "  ", ", ", "\n", "! "]) for w in some) + draw.choice(["", draw.choice(phrases)]))
    long = "z" * 700
    known.exceptions |= {f"{long} {words[0]}", f"{words[1]} {long}"}
    texts += [f"{long} {words[0]}", f"{words[1]} {long}", f"{words[0]} {long}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.find(docs, known).collect()}
    for i, text in enumerate(texts):
        total, n, found = plain_find(text, known)
        assert (rows[i].toxic_words, [s.term for s in rows[i].toxic_spans]) == (n, found)
        assert rows[i].toxic_weight == pytest.approx(total)
    assert plain_find(texts[-3], known)[0] == plain_find(texts[-2], known)[0] == 0.0 and plain_find(texts[-1], known)[0] > 0


def test_weights_are_those_of_plain_counts(spark):
    draw = random.Random(23)
    plain = ["".join(draw.choices("abcdeimnorstu", k=draw.randrange(3, 8))) for _ in range(200)]
    rows = []
    for i in range(700):
        toxic = int(i % 4 == 0)
        rows.append((i, " ".join(draw.choices(plain, k=30) + draw.choices(["grotz", "blemfy", "vulkrit"], k=toxic)), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fitted = toxicity.fit(frame, frame)
    learned = {r.doc_id for r in frame.where(toxicity.share_of("doc_id") < toxicity.LEXICON_SHARE).collect()}
    own = [({p for w in set(toxicity.fold(t).split()) if len(w) > 2 for p in toxicity.terms_of(w)}, x) for i, t, x in rows if i in learned]
    toxic, clean = sum(x for _, x in own), sum(1 - x for _, x in own)
    share, strong = toxic / (toxic + clean), {}
    for term in set().union(*(terms for terms, _ in own)):
        k = [sum(term in terms for terms, x in own if x == label) for label in (1, 0)]
        weight = math.log((k[0] + 0.5) / (toxic + 1)) - math.log((k[1] + 0.5) / (clean + 1))
        ratio = 2 * sum(n * math.log(n / sum(k) / p) for n, p in zip(k, (share, 1 - share)) if n)
        if weight >= toxicity.MIN_WEIGHT and ratio >= toxicity.MIN_RATIO:
            strong[term] = weight
    assert fitted.weights and fitted.weights.keys() <= strong.keys()
    assert all(w == pytest.approx(strong[t]) for t, w in fitted.weights.items())
    # What is not in the lexicon is covered by a shorter beginning of the same word.
    assert all(any(t.startswith(f.rstrip()) for f in fitted.weights) for t in strong)
