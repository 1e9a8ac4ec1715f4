"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, decontaminate, dialogue_repair, jaccard_join, license_scan, mix, multi_index, pii, quality_model, quality_rules, spelling, substring_dedup, url_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_sources(_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), jaccard_join.QUERY_WORDS, jaccard_join.QUERY_THRESHOLD)
    return linked.select("doc_id", "n_shingles", "component_id")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(_table(spark, sf_dir, "conversations"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    # sums of logarithms depend on the order of rows in their last digits
    return verdicts.select("doc_id", "language", "n_grams", F.round("perplexity", 6).alias("perplexity"), F.round("threshold", 6).alias("threshold"), "kept")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(_table(spark, sf_dir, "documents")))


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = _table(spark, sf_dir, "conversations")
    done = dialogue_repair.repair(dialogue_repair.damage(whole))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    name = dialogue_repair.conv_key(F.col("conv_id")).alias("conv")
    found = done.dialogues.select(name, *counts, "audit")
    hashed = dialogue_repair.repaired_digests(done.turns).select(name, "sha256")
    rows = whole.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("conv", name)
    rows = rows.join(found, "conv", "left").join(hashed, "conv", "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest_rows(_table(spark, sf_dir, "embeddings"), multi_index.QUERY_NEAREST, multi_index.QUERY_EVERY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_url_filters, op2_decontamination, op3_mix, op4_jaccard_join, op5_license_scan,
        op6_quality_rules, op7_chat_format, op8_quality_model, op9_substring_dedup, op10_personal_data,
        op11_dialogue_repair, op12_spelling_variants, op13_nearest_vectors,
    )
}

#: DuckDB SQL of the queries that SQL can express at the size of the tables.
ORACLE_SQL: dict[str, str] = {
    "op3_mix": mix.ORACLE_SQL,
    "op4_jaccard_join": jaccard_join.ORACLE_SQL,
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op7_chat_format": chat.ORACLE_SQL,
    "op9_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_dialogue_repair": dialogue_repair.ORACLE_SQL,
    "op12_spelling_variants": spelling.ORACLE_SQL,
}
