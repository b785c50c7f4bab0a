"""Queries of this package: one per operator over its whole table, and the pipeline's stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, centroid_clustering, chat_format, decontamination, html_extract, license_scan, mixing, packing,
               quality_rules, simhash_dedup, spelling, token_counts, toxicity)
from .common import released, scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts from an empty cache, so that each call encodes all distinct texts."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     scratch(spark, "token-cache"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    model = toxicity.fit(toxicity.training_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    released()  # what the driver fitted with
    return model


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(more)))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), thin=97)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.clusters(table(spark, sf_dir, "embeddings"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity_model(spark, sf_dir))


def stage_simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates_removed(docs, shingle=3, max_bits=2)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_chat_formatting, op4_license_scan, op5_quality_rules,
                            op6_simhash_dedup, op7_source_mixing, op8_nearest_neighbours, op9_html_extraction,
                            op10_packing, op11_spelling_variants, op12_decontamination, op13_centroid_clustering)}
