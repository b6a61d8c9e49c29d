"""The training-data pipeline: quality rules, line dedup, near-dedup,
benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all documents its
predecessor kept and returns the columns of ``documents``; the last one
returns the packed pieces. ``run`` writes each stage's result as Parquet in
the shared checkpoint folder and reads it again for the next. Empty tables
give empty results; null texts and ids go through as each operator's
docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.llm import decontaminate, frames, lines, minhash, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a certified cutoff go."""
    return quality.keep(docs, frames.read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from the texts; every document stays."""
    counts = ("__n_lines", "__n_removed")
    while {c.lower() for c in counts} & {c.lower() for c in docs.columns}:
        counts = tuple(f"{c}_" for c in counts)
    out = lines.dedup(docs, counts=counts)
    n_chars = F.when(F.col(counts[1]) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles,
    similarity 0.8 or more)."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark windows go."""
    return decontaminate.clean(docs, frames.read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in token-budget batches of optimal length buckets."""
    return packing.pack(packing.lengths(docs)).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# The near-dedup stage's signatures have no SQL form; tests hold the pipeline
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.read(spark, sf_dir, "documents")
    before = None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = frames.keep(docs)
            # Each stage's input goes once its result is written.
            frames.drop(before)
            before = docs
    return docs
