"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapse.llm.common import table


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.nce_lm import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.nn_descent import ann_search
    return ann_search(table(spark, sf_dir, "embeddings"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.bpe_codec import bpe_codec
    return bpe_codec(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.chat_format import chat_format
    return chat_format(table(spark, sf_dir, "conversations"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy rejects, alone and with others, from the ledger of all documents."""
    from lapse.llm.quality_rules import ablations, measure
    return ablations(measure(table(spark, sf_dir, "documents")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.subword_classifier import quality_classifier
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.pii_spans import pii_spans
    return pii_spans(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.packing import packing
    return packing(table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.simhash_dedup import simhash_dedup
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.warc import warc_round_trip
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.centroid_clustering import centroid_clustering
    return centroid_clustering(table(spark, sf_dir, "embeddings"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lapse.llm.source_audit import source_audit
    return source_audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith(("op", "quality_")) and callable(fn)}


def oracle_sql() -> dict[str, str]:
    from lapse.llm.oracle import SQL
    return dict(SQL)
