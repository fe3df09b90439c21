from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_mixing import WORD, plain_targets
from test_simhash import expected_groups

from tidemark.llm import language, mixing, pieces, toxicity
from tidemark.llm.tables import held_out, table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage made of what the one before it kept."""
    docs = [table(spark, SF_DIR, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(stage(spark, docs[-1], SF_DIR).cache())
    return docs


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_language_and_toxicity_drop_what_the_operators_reject(spark, stages):
    model = language.fit(stages[0].where(~held_out("doc_id", 3, 1)))
    assert ids(stages[1]) == ids(language.label(stages[0], model).where(language.accepted()))
    labels = table(spark, SF_DIR, "labels").where(~held_out("doc_id", 5, 0))
    lexicon = toxicity.fit(stages[1], labels)
    assert ids(stages[2]) == ids(toxicity.find(stages[1], lexicon).where("toxic_score < 0.5"))
    assert len(ids(stages[2])) < len(ids(stages[1])) <= len(ids(stages[0]))


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    assert ids(stages[3]) == sorted(set(expected_groups(rows).values()))


def test_mixture_and_pieces(stages):
    sizes, before, got = {}, {}, {}
    for r in stages[3].collect():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        before[r.doc_id] = r
    target = plain_targets(sizes)
    for r in stages[4].collect():
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        got[r.source] = got.get(r.source, 0) + len(WORD.findall(r.text))
    assert all(abs(got.get(s, 0) - target[s]) <= mixing.BLOCK for s in sizes)
    encoder = pieces.Encoder(pieces.load(public_tokenizers.path("piece_bpe_32k.model")))
    expected = sorted((r.doc_id, encoder(r.text)) for r in stages[4].collect())
    found = stages[5].collect()
    assert sorted((r.doc_id, r.piece_ids) for r in found) == expected and all(r.same_text for r in found)


def test_run_writes_and_reads_every_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.piece_ids) for r in found) == sorted((r.doc_id, r.piece_ids) for r in stages[5].collect())


CLASHING = """lang_pred lang_score lang_spans toxic_score toxic_words toxic_spans toxic_weight chosen_key chosen_fp _simhash fp root
component_id first c last _mix_id _mix_text _mix_hash _mix_ranges _mix_whole ix start pass size h ranges taken words text_hash times a.b"""


def test_columns_with_clashing_names_pass_through(spark):
    given = table(spark, "/root/testdata/sf0.001", "documents")
    docs = given.select("*", *[F.concat(F.lit("kept "), F.col("doc_id")).alias(n) for n in CLASHING.split()])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "/root/testdata/sf0.001").cache()
        assert after.columns == docs.columns and after.count() > 0
        for r in after.collect():
            assert all(r[n] == f"kept {r.doc_id}" for n in CLASHING.split())
        assert ids(after.select("doc_id")) == ids(stage(spark, given, "/root/testdata/sf0.001").select("doc_id"))
