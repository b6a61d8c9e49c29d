"""Partitioned tables that are written state by state.

``replace_partitions`` writes the rows of some states into a table laid out
by state and leaves every other state's files alone (dynamic partition
overwrite). Rows are dealt to tasks by each state's measured number of rows:
a state of n rows becomes ``ceil(n / rows_per_file)`` files, each written by
one task, so a state holding a third of the table is as evenly spread as the
rest and a small one is one file. A manifest beside the data says which files
each state consists of since its last commit; ``verify_partitions`` compares
it with what lies in the folders.

``write_counted`` writes a table and counts its rows per state on the way
(observed metrics of the write job), so the data is read once.

The manifest lies in ``_manifest`` under the table, which readers of the
table pass over.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reglink.operators.profile import ref

ROWS_PER_FILE = 5_000_000
# A column per label is observed during the write: labels are states,
# months and the like, not keys.
MAX_LABELS = 2_000
MANIFEST = "_manifest"
_MANIFEST_SCHEMA = "label string, commit_id string, committed_at timestamp, file string, n_rows bigint, n_bytes bigint"


def _free(df: DataFrame, name: str) -> str:
    """``name`` or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partition_sizes(df: DataFrame, by: str, rows: Column | None = None) -> dict[str | None, int]:
    """Rows per value of the partition column (one row per partition folder
    comes to the driver). Values are told apart as the folders are: by text.
    ``rows`` is the aggregate that gives them where ``df`` is counted in part
    already (a sum of counts)."""
    counts = df.groupBy(ref(by).cast("string").alias("label")).agg((F.count(F.lit(1)) if rows is None else rows).alias("n"))
    sizes = {r.label: r.n for r in counts.limit(MAX_LABELS + 1).collect()}
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"{by} has over {MAX_LABELS} values: too many to be partition folders")
    return sizes


def deal_by_size(df: DataFrame, by: str, sizes: dict[str | None, int], rows_per_file: int = ROWS_PER_FILE, spread: str | None = None) -> DataFrame:
    """``df`` repartitioned so that each task holds rows of one value of
    ``by`` only, about ``rows_per_file`` of them.

    Which task of its value a row goes to is a hash of the row, so a task
    that runs again deals alike, whatever order its input comes in. Equal
    rows then go together: where one row may be copied very often, ``spread``
    names a column that tells copies apart (a line number, say); it is
    hashed instead and left out of the result.
    """
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be positive")
    spark, plan, begin = df.sparkSession, [], 0
    for label, n in sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")):
        tasks = max(1, -(-n // rows_per_file))
        plan.append((label, begin, tasks))
        begin += tasks
    label, first, tasks = (_free(df, x) for x in ("label", "first_task", "tasks"))
    dealt = F.broadcast(spark.createDataFrame(plan, f"`{label}` string, `{first}` int, `{tasks}` int"))
    placed = df.join(dealt, ref(by).cast("string").eqNullSafe(ref(label)))
    row = F.xxhash64(ref(spread)) if spread else F.xxhash64(*[ref(c) for c in df.columns])
    task = (ref(first) + F.pmod(row, ref(tasks))).cast("int")
    return placed.repartitionById(max(1, begin), task).select(*[ref(c) for c in df.columns if c != spread])


def replace_partitions(
    df: DataFrame, path: str, by: str, rows_per_file: int = ROWS_PER_FILE, sizes: dict[str | None, int] | None = None, spread: str | None = None
) -> str:
    """Write the partitions that ``df`` has rows of; all others stay. The
    whole of each such partition is replaced. Returns the commit's id.

    ``sizes`` are the rows per partition where they are known already (they
    are counted otherwise), ``spread`` as in ``deal_by_size``. An empty
    ``df`` replaces nothing. Spark moves the new files in place when all
    tasks are done; the manifest is written after that, so a commit that
    broke off in between shows up in ``verify_partitions``.
    """
    sizes = partition_sizes(df, by) if sizes is None else sizes
    commit = uuid.uuid4().hex
    if not sizes:
        return commit
    writer = deal_by_size(df, by, sizes, rows_per_file, spread).write.mode("overwrite").partitionBy(by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    files = _files(df.sparkSession, path, by)
    wanted = [x for x in sizes if x is not None]
    mine = F.col("label").isin(wanted) if wanted else F.lit(False)
    if None in sizes:
        mine = mine | F.col("label").isNull()
    rows = files.where(mine).select("label", F.lit(commit).alias("commit_id"), F.current_timestamp().alias("committed_at"), "file", "n_rows", "n_bytes")
    rows.write.mode("append").parquet(f"{path}/{MANIFEST}")
    return commit


def _files(spark: SparkSession, path: str, by: str) -> DataFrame:
    """(label, file, n_rows, n_bytes) of the files that lie in the table.

    Rows are grouped by the path as the scan gives it (one value per file);
    names are cut from it once per file, not once per row."""
    table = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    found = table.groupBy(ref(by).cast("string").alias("label"), F.col("_metadata.file_path").alias("found_path")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.col("_metadata.file_size")).cast("bigint").alias("n_bytes")
    )
    return found.select("label", F.regexp_extract("found_path", r"[^/]+/[^/]+$", 0).alias("file"), "n_rows", "n_bytes")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of each partition's last commit."""
    rows = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}")
    last = rows.groupBy("label").agg(F.max_by("commit_id", F.struct("committed_at", "commit_id")).alias("last"))
    other = last.withColumnRenamed("label", "of")
    return rows.join(F.broadcast(other), F.col("label").eqNullSafe(F.col("of")) & (F.col("commit_id") == F.col("last"))).drop("of", "last")


def verify_partitions(spark: SparkSession, path: str, by: str) -> DataFrame:
    """(label, file, fault): files that the manifest names and the table lacks
    (``missing``), the other way round (``uncommitted``), and files of another
    size or number of rows (``changed``). Empty when all is as committed."""
    there = _files(spark, path, by).select(F.col("label").alias("there_label"), F.col("file").alias("there_file"), F.col("n_rows").alias("there_rows"), F.col("n_bytes").alias("there_bytes"))
    both = manifest(spark, path).join(there, F.col("file") == F.col("there_file"), "full_outer")
    changed = (F.col("n_rows") != F.col("there_rows")) | (F.col("n_bytes") != F.col("there_bytes"))
    fault = F.when(F.col("there_file").isNull(), "missing").when(F.col("file").isNull(), "uncommitted").when(changed, "changed")
    return both.select(F.coalesce("label", "there_label").alias("label"), F.coalesce("file", "there_file").alias("file"), fault.alias("fault")).where("fault is not null")


def _observed(labels: Sequence[str], by: str) -> list[Column]:
    counts = [F.count_if(ref(by) == F.lit(x)).alias(f"n{i}") for i, x in enumerate(labels)]
    return [*counts, F.count_if(ref(by).isNull()).alias("n_null"), F.count(F.lit(1)).alias("n_all")]


def write_counted(df: DataFrame, path: str, by: str, labels: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """Write ``df`` by ``by`` and return (by, n_rows) with the grand total
    under a NULL label, sorted by label; one job reads the data.

    ``labels`` are the values to count (the state folders that were found).
    The counts are metrics of the write job: a task that is run again counts
    once. Labels without rows have no row in the result; rows under a value
    outside ``labels`` raise ``ValueError`` after the write, as their count
    would be missing. A table with NULL in ``by`` is refused the same way.
    """
    labels = sorted(set(labels))
    if len(labels) > MAX_LABELS:
        raise ValueError(f"{len(labels)} labels: too many to observe during a write")
    seen = Observation()
    df.observe(seen, *_observed(labels, by)).write.mode(mode).partitionBy(by).parquet(path)
    found = seen.get
    counts = [(x, found[f"n{i}"]) for i, x in enumerate(labels) if found[f"n{i}"]]
    if sum(n for _, n in counts) != found["n_all"]:
        raise ValueError(f"{found['n_all'] - sum(n for _, n in counts)} rows of {by} have none of the labels")
    schema = StructType([StructField(by, StringType()), StructField("n_rows", LongType())])
    return df.sparkSession.createDataFrame([*counts, (None, found["n_all"])], schema)
