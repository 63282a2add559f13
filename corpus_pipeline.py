"""The training-data pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
to the shared folder as Parquet and reads it back, so a lost executor never
sends the work back behind the last finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nivalis.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, queries, toxicity
from nivalis.llm.common import read, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact_dedup.drop_duplicates(docs, exact_dedup.new_index(spark))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document of the smallest doc_id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go; the others keep their text."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text is encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return byte_bpe.digests(docs, *queries.byte_bpe_parameters())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("decontaminate", decontamination_stage),
    ("byte_bpe", byte_bpe_stage),
]
#: A trained classifier and a tokenizer are no SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
