"""Registered queries of the subpackage and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlcat.llm import decontaminate, edit_counts, jaccard, language, media, packing, pii, quotes, secrets, token_files
from crawlcat.llm.common import table, written


def op1_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op2_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.scan(table(spark, sf_dir, "documents")))


def op4_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = written(edit_counts.build(table(spark, sf_dir, "documents")), "trees")
    return edit_counts.update(trees.withColumn("edits", edit_counts.sample_edits(F.col("text"), F.col("doc_id")))).select(*edit_counts.COUNTS)


def op5_media_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(media.store(table(spark, sf_dir, "documents"), with_media=False))


def op6_chosen_path_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op7_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op9_quotation_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.rendered(quotes.format_chat(table(spark, sf_dir, "conversations")))


def op10_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.where(~F.col("held_out")))
    return language.identify(docs, model, "held_out")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(table(spark, sf_dir, "documents"))
    return token_files.read(files).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_power_of_two_packing,
        op2_latent_decontamination,
        op3_disclosure_pii,
        op4_edit_aware_counts,
        op5_media_fingerprints,
        op6_chosen_path_jaccard,
        op7_ownership_secrets,
        op8_token_files,
        op9_quotation_chat,
        op10_centroid_language,
    )
}

ORACLE_SQL: dict[str, str] = {}
