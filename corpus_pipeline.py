"""The training-data pipeline: language, quality, near duplicates, repeated passages, packing.

Each stage takes the documents that the one before it kept (written as Parquet and reread) and returns the
columns of documents; the last returns the packed pieces.

Defined cases: a null, empty or letterless text goes at the first stage; columns beside doc_id, text and n_chars pass through,
whatever they are called (n_chars is renewed where a passage was removed); rows that share doc_id and text are copies, of which the
near-duplicate stage keeps one; a null doc_id comes before all others where the first is kept; of texts that tie in the
first doc_id the row of that id stays; very long texts are read whole by every stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import jaccard, language, packing, quality_model, substrings
from fleetlens.llm.common import keep, prepare, table

#: Two stages are trained models, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lets go documents without a letter and those whose language isn't determined."""
    model = language.train(docs, language.remainder("doc_id", 4) != 2)
    return language.keep_identified(docs, model)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lets go documents that the weak-label model rejects."""
    weights, prior, _ = quality_model.train(docs)
    return quality_model.keep_good(docs, weights, prior)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has are removed; documents that lose every word go."""
    return substrings.without_redundant(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their sequences."""
    return packing.packed_pieces(docs)


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("ngram_jaccard_join", join_near_duplicates),
    ("substring_dedup", remove_passages),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what goes from one to the next is a written table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
