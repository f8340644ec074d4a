"""The corpus pipeline: five stages from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared
checkpoint folder and read again as the next stage's docs.  All stages but the last return the columns of
documents.

Results for odd input: null and empty texts end in the first stage (they have too few words); texts of any
length pass whole; of repeated rows, and of near copies, exactly one stays after the near-dedup stage, the one
with the smallest doc_id (a null id only where no row of the group has one; ties by the smallest text hash);
further columns pass all stages but the last as they are, whatever their names; an empty table passes through
every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import packing as fitting
from lapse.llm import pii_spans, quality_rules, simhash_dedup, subword_classifier
from lapse.llm.common import table
from lapse.session import scratch_folder


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality_rules.keep_clean(docs)


def apply_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1.  Learned from the labelled raw documents, as few bad ones come this far."""
    model = subword_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                     learn=~subword_classifier.held_out())
    return subword_classifier.keep_good(docs, model)


def apply_simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash_dedup.keep_one(docs)


def apply_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    clean = pii_spans.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def apply_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    return fitting.packing(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("quality_classifier", apply_quality_classifier),
    ("simhash_dedup", apply_simhash_dedup),
    ("pii", apply_pii),
    ("packing", apply_packing),
]
# Trained models and token ids are not SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; every stage's result is written and read again."""
    folder = scratch_folder(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
