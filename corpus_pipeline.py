"""A training-corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, decontamination, encoding.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and returns the
columns of ``documents``; the last one returns token ids.  ``run`` chains them with the lineage cut in
the shared checkpoint folder after each, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe, decontaminate, line_dedup, near_dup, quality
from panelcast.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds; ``n_chars`` follows the text."""
    out = line_dedup.dedup(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity of 0.8 or more)."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its token ids, their count, and whether decoding them gives the text again."""
    done = bpe.round_trip(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_ids", bpe_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Merging byte pairs in rank order is not expressible in SQL at this size; tests hold run() against brute force.
ORACLE_SQL = None
