from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import language

SOUNDS = {"aa": ["ba", "bo", "bi", "du"], "bb": ["chz", "khr", "zw", "pl"], "ru": ["да", "не", "ко", "ри"], "bg": ["ъл", "ят", "ще", "ъж"]}


def words(lang, n, draw):
    return " ".join("".join(draw.choices(SOUNDS[lang], k=draw.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(1)
    rows = [(i, words(lang, 60, draw), lang) for i, lang in enumerate([*SOUNDS] * 20)]
    rows += [(900, None, "aa"), (901, "x", None), (None, "ba bo", "aa")]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_predictions_and_spans(spark, model):
    draw = random.Random(2)
    texts = {lang: words(lang, 30, draw) for lang in SOUNDS}
    mixed = f"{texts['aa']} {texts['ru']} {texts['aa']}"
    rows = [(lang, t) for lang, t in texts.items()]
    rows += [("mixed", mixed), ("null", None), ("empty", ""), ("none", "12 % ² 34!"), ("long", texts["bb"] * 300)]
    docs = spark.createDataFrame([(*r, "mine", 7) for r in rows], "name string, text string, lang_pred string, lang int")
    labelled = language.label(docs, model)
    found = {r.name: r for r in labelled.collect()}
    assert labelled.columns[:3] == ["name", "text", "lang"]
    assert all(found[lang].lang_pred == lang and found[lang].lang_score == 1.0 for lang in SOUNDS)
    assert [s.lang for s in found["mixed"].lang_spans] == ["aa", "ru", "aa"]
    assert found["mixed"].lang_pred == "aa" and 0.5 < found["mixed"].lang_score < 1
    cut = [mixed[s.start : s.end] for s in found["mixed"].lang_spans]
    assert "".join(cut) == mixed and cut[1].startswith(texts["ru"][:4])
    for name in ("null", "empty", "none"):
        assert (found[name].lang_pred, found[name].lang_score, found[name].lang_spans) == ("und", 0.0, [])
    assert found["long"].lang_pred == "bb"
    assert {r.name for r in labelled.where(language.accepted()).collect()} == {*SOUNDS, "mixed", "long"}


def test_scripts_exclude_languages(model):
    scorer = language.Scorer(model)
    numbers = scorer.number(["bababa", "данери", "漢字"])
    scores = scorer.scores[numbers]
    at = {name: i for i, name in enumerate(model.languages)}
    assert scores[0, at["ru"]] == scores[1, at["aa"]] == -language.FLOOR
    assert (scores[2] == 0).all()


def test_no_training_rows(spark):
    empty = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert {r.lang_pred for r in language.label(docs, empty).collect()} == {"und"}
    assert language.label(docs.limit(0), empty).count() == 0


def plain_path(scores, switch):
    best, back = list(scores[0]), []
    for row in scores[1:]:
        top = int(np.argmax(best))
        back.append([k if best[k] >= best[top] - switch else top for k in range(len(row))])
        best = [max(best[k], best[top] - switch) + row[k] for k in range(len(row))]
    path = [int(np.argmax(best))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return max(best), path[::-1]


@pytest.mark.parametrize("lane", [1, 3, 64])
def test_best_path(lane):
    draw = np.random.default_rng(lane)
    texts = [draw.normal(size=(n, 4)) for n in (1, 2, 7, 40, 1, 100)]
    first = np.cumsum([0] + [len(t) for t in texts[:-1]])
    path = language.best_path(np.concatenate(texts), first, 1.5, lane)
    for start, text in zip(first, texts):
        own = path[start : start + len(text)]
        value = sum(text[i, k] for i, k in enumerate(own)) - 1.5 * np.count_nonzero(np.diff(own))
        assert value == pytest.approx(plain_path(text, 1.5)[0])


def test_letters_keep_their_places():
    assert len(language.lowered("İxİy")) == 4
