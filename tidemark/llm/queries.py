"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    caps,
    hosts,
    imatch,
    inverted,
    language,
    licences,
    mixing,
    pieces,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from tidemark.llm.tables import held_out, table
from tidemark.workspace import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op6_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 3, 1))
    model = language.fit(docs.where(~F.col("held_out")))
    labelled = language.label(docs.select("doc_id", "held_out", "text"), model)
    return labelled.select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"),
        F.size("lang_spans").cast("long").alias("n_spans"),
    )


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 5, 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    lexicon = toxicity.fit(docs.where(~F.col("held_out")), labels)
    found = toxicity.find(docs, lexicon)
    return found.select(
        "doc_id", "held_out", F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_spans").cast("long").alias("n_matches"),
    )


@query
def op9_simhash(spark, sf_dir):
    rows = simhash.groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_mixing(spark, sf_dir):
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op1_sentencepiece(spark, sf_dir):
    model = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    low, high = min(model.byte_ids), max(model.byte_ids)
    return pieces.encode(docs, model, decoded=True).select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
        F.size(F.filter("piece_ids", lambda i: i.between(low, high))).cast("long").alias("n_byte_pieces"),
        F.crc32(F.array_join("piece_ids", " ")).alias("ids_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


@query
def op3_caps(spark, sf_dir):
    found = caps.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


ORACLES["op3_caps"] = caps.oracle()


@query
def op4_token_files(spark, sf_dir):
    folder = fresh_folder(spark, "tokens")
    token_files.write_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_files.read_documents(spark, folder)


@query
def op7_imatch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.edited(docs, imatch.lexicon(docs))


@query
def op5_licences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.licensed(docs).select("doc_id", "license", "license_sentences", "n_license_sentences")


ORACLES["op5_licences"] = licences.oracle()


@query
def op10_hosts(spark, sf_dir):
    return hosts.filtered(table(spark, sf_dir, "pages"))


ORACLES["op10_hosts"] = hosts.oracle()


@query
def op13_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling"] = spelling.oracle()


@query
def op12_alignment(spark, sf_dir):
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@query
def op11_inverted(spark, sf_dir):
    return inverted.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
