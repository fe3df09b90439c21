"""A corpus in stages: each takes (spark, docs, sf_dir) and returns what the next one reads.

``run`` writes what each stage returns as Parquet in the shared folder and reads it back; what a stage
needed on its way, and the result before, are removed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, pieces, simhash, toxicity
from tidemark.llm.tables import apart, held_out, table
from tidemark.workspace import Folder, fresh_folder, passing_folders, written


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; the model learns from the documents themselves."""
    docs, named = apart(docs, "doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out("doc_id", 3, 1)))
    return named(language.label(docs, model).where(language.accepted()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    docs, named = apart(docs, "doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0)))
    return named(toxicity.find(docs, lexicon).where("toxic_score < 0.5"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by four-word shingles and at most four bits."""
    return simhash.distinct_documents(docs, size=simhash.SHINGLE, distance=simhash.DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mixture takes them, a row for each pass over a document."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it."""
    model = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.encode(docs, model, decoded=True).select(
        "doc_id", "lang", "source", "n_chars", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


STAGES = [
    ("language", keep_languages),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_texts),
]

#: No SQL: the stages learn models and encode by a trie; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        with passing_folders(spark):
            docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}-{name.replace(' ', '-')}")
        if number:
            Folder(spark, folder).remove(f"{number - 1}-{STAGES[number - 1][0].replace(' ', '-')}")
    return docs
