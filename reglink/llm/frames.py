"""Small DataFrame helpers of the ``llm`` operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reglink.session import ensure_checkpoint_dir, ship_package


def ready(spark: SparkSession) -> None:
    """Checkpoint folder known, package importable on the workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def keep(df: DataFrame) -> DataFrame:
    """Cut lineage with a table in the shared checkpoint folder. A table read
    again has a plan of its own size, its bytes are known to the planner, and
    every executor can read it after another is lost. The folder lives as
    long as results that read it are wanted; ``clean`` removes it."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Remove kept tables that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_kept_at", None)
        if path:
            _delete(df.sparkSession, path)


def folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Remove every kept table of this application."""
    _delete(spark, folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The table with its columns named c0, c1, ...: whatever they are called,
    they cannot clash with an operator's own."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def at(df: DataFrame, name: str) -> str:
    """The name in ``numbered`` of the column ``name`` of ``df``."""
    names = df.columns
    return f"c{names.index(name) if name in names else [c.lower() for c in names].index(name.lower())}"
