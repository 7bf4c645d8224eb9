"""From raw documents to packed training sequences: quality rules, language, near duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import jaccard, language, packing, quality
from ledgerwatch.sources.tables import staged

STAGES = [
    ("quality_rules", quality.stage_quality),
    ("language_id", language.stage_language),
    ("jaccard_join", jaccard.stage_unique),
    ("best_fit_packing", packing.stage_pack),
]

#: None: the trees of the quality rules and the language model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
