"""A corpus pipeline over ``documents``: each stage filters or rewrites what the one before kept.

Quality classifier, near duplicates, benchmark decontamination, personal
data, source mix. All stages but the last return the columns of
``documents``. The quality stage decides by doc_id: rows that repeat one, or
have none, stay together if one of them does. The other stages decide row by
row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, jaccard_join, mix, pii, quality_model
from strata.session import scratch_path

#: Near duplicates: words of a shingle, and least similarity in percent (op4's query has its own).
NEAR_WORDS, NEAR_THRESHOLD = 5, 80


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids`` (one column; null matches null)."""
    ids = ids.toDF("__kept_id").distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__kept_id"]), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text reads like the trusted text of their language."""
    verdicts = quality_model.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _only(docs, verdicts.filter("kept").select("doc_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the least doc_id, also where rows repeat an id or have none."""
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_THRESHOLD)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.mask_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, target and words taken of the documents in the mix."""
    return mix.mix_sources(docs).filter("taken > 0")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]
#: Models and sketches are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; between stages the rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
