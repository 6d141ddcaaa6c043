"""The corpus pipeline: documents through the stages below, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import decontaminate, overlap, packing, secrets, toxicity
from tallyfold.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the threshold of their language go. The model is trained on the labelled
    documents of this stage's input."""
    model = toxicity.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def overlap_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at a similarity of 0.8 or more, the one with the smallest
    id stays."""
    return overlap.keep_one(docs, overlap.Join(width=5, percent=80))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, cut and packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", overlap_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

# A trained model, tokenizers and a packing search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
