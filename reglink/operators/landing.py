"""Which months of a monthly dump have landed, from the files themselves.

A month counts as landed when its folder holds data: at least one file with
content, none of them still being written. An empty folder, one with empty
files only (Spark's listing leaves files without bytes out), or one a
download broke off in is still missing. The ledger keeps one row per month and is
brought up to date month by month: only the months of the calendar that have
not landed yet are listed again. Listings read paths, lengths and times, not
contents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.operators.ingest import missing_periods
from reglink.sources import store

# --- fixed values -----------------------------------------------------------
# YYYYMM as a run of its own in the name of a folder of the path.
PERIOD_REGEX = r"(?:^|/)[^/]*?(?<![0-9])((?:19|20)[0-9]{2}(?:0[1-9]|1[0-2]))(?![0-9])[^/]*/"
# Endings of files that a download has not finished.
PARTIAL_REGEX = r"(?i)\.(part|partial|tmp|crdownload|filepart)$"
# ----------------------------------------------------------------------------

LEDGER_SCHEMA = "n_files bigint, n_bytes bigint, n_partial bigint, last_modified timestamp, period string"


def months(start: str, end: str) -> list[str]:
    """``YYYYMM`` of every month from ``start`` to ``end`` (ISO dates or
    months), inclusive; none for a reversed range."""
    a, b = (int(x[:4]) * 12 + int(x[5:7]) - 1 for x in (start, end))
    return [f"{i // 12:04d}{i % 12 + 1:02d}" for i in range(a, b + 1)]


def list_landings(spark: SparkSession, root: str, periods: list[str] | None = None) -> DataFrame:
    """(path, period, n_bytes, modified_at, partial) of the files under the
    folders directly below ``root`` whose names hold a ``YYYYMM`` (one of
    ``periods``). Files elsewhere, and files without bytes, are passed over."""
    root = root.rstrip("/")
    if periods is not None and not periods:
        return spark.createDataFrame([], "path string, period string, n_bytes bigint, modified_at timestamp, partial boolean")
    names = "*" if periods is None else "*{" + ",".join(periods) + "}*"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(f"{root}/{names}")
        files.schema  # noqa: B018
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return list_landings(spark, root, [])
    # The path below the root: digits in the root's own name are no month.
    below = F.regexp_extract("path", r"([^/]+/.*)$", 1) if not root else F.substring_index("path", f"{root.rsplit('/', 1)[-1]}/", -1)
    period = F.regexp_extract(below, PERIOD_REGEX, 1)
    out = files.select(
        "path",
        period.alias("period"),
        F.col("length").alias("n_bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.col("path").rlike(PARTIAL_REGEX).alias("partial"),
    ).where(F.col("period") != "")
    return out if periods is None else out.where(F.col("period").isin(periods))


def summarize_landings(files: DataFrame) -> DataFrame:
    """One ledger row per month that has files."""
    return files.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"),
        F.count_if("partial").alias("n_partial"),
        F.max("modified_at").alias("last_modified"),
    ).select("n_files", "n_bytes", "n_partial", "last_modified", "period")


def landed(ledger: DataFrame) -> DataFrame:
    """(period) of the months whose folder is whole."""
    return ledger.where((F.col("n_files") > 0) & (F.col("n_partial") == 0)).select("period")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty before the first update."""
    try:
        df = spark.read.schema(LEDGER_SCHEMA).parquet(path)
        df.schema  # noqa: B018
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def update_ledger(spark: SparkSession, root: str, ledger_path: str, start: str, end: str) -> list[str]:
    """List the months of the range that the ledger does not know as landed,
    and replace their rows; returns those months. Landed months are not
    looked at again: delete a month's folder in the ledger to have it read
    anew. The range's months, not the files, pass through the driver."""
    done = {r.period for r in landed(read_ledger(spark, ledger_path)).collect()}
    pending = [m for m in months(start, end) if m not in done]
    rows = summarize_landings(list_landings(spark, root, pending))
    store.replace_partitions(rows, ledger_path, "period")
    return pending


def missing_landings(spark: SparkSession, ledger_path: str, start: str, end: str) -> DataFrame:
    """(period) of the months of the range that have not landed whole."""
    expected = spark.createDataFrame([(m,) for m in months(start, end)], "period string")
    return missing_periods(expected, landed(read_ledger(spark, ledger_path)))
