"""The training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns a DataFrame that ``run`` writes as parquet and reads back for the
next one.  All but the last return the columns of ``docs``; the last returns the
pieces with their places in packed sequences.

Defined results: null and empty texts are judged like any text (they have too few
words and go with the quality rules); rows with equal id and text are judged
alike; a null id counts as the largest; an empty table passes every stage empty;
other columns stay through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import minhash, packing, quality, repetition, substrings
from strata.llm.common import documents, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.learn(docs, labels)
    return quality.scored(docs, model, out="__llm_score").where(f"__llm_score >= {quality.THRESHOLD}").drop("__llm_score")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits on repeats."""
    return repetition.passes(docs, out="__llm_kept").where("__llm_kept").drop("__llm_kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8)."""
    return minhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word runs that an earlier document has."""
    return substrings.remove_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset."""
    pieces = written(packing.pieces(docs).drop("ids"), "pieces")
    return packing.pack(pieces)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # not expressible: models, suffix arrays and packing plans


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
