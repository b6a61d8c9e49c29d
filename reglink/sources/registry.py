"""Delimited registry files in, Parquet tables out.

One read covers every state folder: a path glob selects the folders whose
names look like ``NN_XX`` and the state label comes from each row's own file
path (``_metadata.file_path``), so there is no per-folder loop, no per-folder
count action and no chain of unions. Other folders under the same root (for
example a downloaded establishment dump) are never read.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reglink.operators.profile import distinct_values, ref
from reglink.sources.schemas import STATE_FOLDER_GLOB

CORRUPT_COLUMN = "_corrupt_record"


def read_registry(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    sep: str = ";",
    header: bool = True,
    check_header: bool = True,
    keep_rejects: bool = False,
    infer: bool = False,
    as_string: Iterable[str] = (),
    encoding: str | None = None,
) -> DataFrame:
    """Read delimited registry files.

    With a declared ``schema`` and a header, the header is checked against
    the schema by position (``check_header``), so a reordered file fails
    instead of silently shifting columns. ``keep_rejects`` adds a
    ``_corrupt_record`` column holding the raw line of every row with a short,
    long or mistyped field (those fields are NULL otherwise).

    Without a schema every column is read as a string (no inference pass over
    the data). ``infer=True`` runs Spark's inference first, over
    the whole input; ``as_string`` then forces
    identifier columns (postal codes, unit codes) back to string so leading
    zeros survive.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if encoding:
        reader = reader.option("encoding", encoding)
    if schema is None and infer:
        # Over the whole input: a type taken from a part of it would turn
        # values outside that type into NULL.
        inferred = reader.option("inferSchema", True).csv(path).schema
        forced = set(as_string)
        schema = StructType(
            [StructField(f.name, StringType(), True) if f.name in forced else f for f in inferred.fields]
        )
    if schema is not None:
        if keep_rejects:
            schema = StructType(list(schema.fields) + [StructField(CORRUPT_COLUMN, StringType(), True)])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        reader = reader.schema(schema)
        if header:
            reader = reader.option("enforceSchema", not check_header)
    return reader.csv(path)


def rejected_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n_rows, n_rejected, n_accepted) of a frame read with ``keep_rejects=True``.

    The CSV reader only checks the fields a query asks for, so every data
    column is referenced (in the accepted count, through a nullable
    expression the optimizer cannot fold away) to make each row be checked
    in full; Spark would also refuse a query on the corrupt column alone.
    """
    data = [ref(c) for c in df.columns if c != CORRUPT_COLUMN]
    flagged = F.col(CORRUPT_COLUMN).isNotNull()
    measures = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(flagged).alias("n_rejected"),
        F.count(F.when(~flagged, F.struct(*data))).alias("n_accepted"),
    ]
    if by:
        return df.groupBy(*[ref(c) for c in by]).agg(*measures)
    return df.agg(*measures)


def load_partitioned(
    spark: SparkSession,
    raw_dir: str,
    schema: StructType,
    label: str = "UF",
    sep: str = ";",
    allow_empty: bool = False,
    **read_options,
) -> DataFrame:
    """All state folders under ``raw_dir`` as one table with a state label.

    Folder ``11_RO`` gives label ``RO``. A root without any state folder
    raises Spark's path-not-found error unless ``allow_empty``.
    """
    pattern = f"{raw_dir.rstrip('/')}/{STATE_FOLDER_GLOB}"
    try:
        df = read_registry(spark, pattern, schema, sep=sep, **read_options)
        # Resolve the listing now so a missing root fails here, not later.
        df.schema  # noqa: B018
    except AnalysisException as exc:
        if not allow_empty or "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(label, F.lit(None).cast("string"))
    state = F.regexp_extract(F.col("_metadata.file_path"), r"^.*/[0-9]{2}_([A-Z]{2})/", 1)
    return df.withColumn(label, state)


def state_labels(spark: SparkSession, raw_dir: str) -> list[str]:
    """Labels of the state folders under ``raw_dir`` that hold files, from a
    listing (no content is read; one label per folder comes back)."""
    files = spark.read.format("binaryFile").load(f"{raw_dir.rstrip('/')}/{STATE_FOLDER_GLOB}")
    label = F.regexp_extract("path", r"^.*/[0-9]{2}_([A-Z]{2})/", 1)
    return sorted(r.label for r in files.select(label.alias("label")).distinct().collect())


def source_counts(df: DataFrame, label: str = "UF", total_label: str | None = None) -> DataFrame:
    """Rows per source plus the grand total, in one aggregate.

    (label, n_rows): the total row has a NULL label (or ``total_label``).
    """
    if total_label is None:
        counts = df.rollup(ref(label)).agg(F.count(F.lit(1)).alias("n_rows"))
    else:
        # grouping() tells the total row apart from a source whose label is NULL.
        counts = df.rollup(ref(label)).agg(
            F.count(F.lit(1)).alias("n_rows"), F.grouping(ref(label)).alias("__total")
        )
        counts = counts.select(
            F.when(F.col("__total") == 1, F.lit(total_label)).otherwise(ref(label)).alias(label),
            "n_rows",
        )
    # A sort above the aggregate's own exchange: the final counts are made in
    # every shuffle partition, not in one task.
    return counts.orderBy(ref(label).asc_nulls_last())


def union_sources(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name; a column missing from one input raises unless
    ``allow_missing`` fills it with NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    max_records_per_file: int | None = None,
    files_per_partition: int | None = None,
) -> str:
    """Write Parquet, optionally partitioned (``partition_by=['UF']``).

    By default there is no shuffle before the write: input splits read from
    state folders hold one state each, so every task writes to very few
    partition folders. When the input is mixed (after a join or a shuffle),
    ``files_per_partition=k`` clusters rows by the partition columns plus a
    row-hash salt in ``[0, k)``: each partition folder gets about ``k``
    files, and a state holding a third of the rows is still spread over
    ``k`` tasks (a shuffle by state alone would give it one). The salt is a
    hash of the row, so a retried task rebuilds the same split.
    """
    if files_per_partition is not None:
        if not partition_by:
            raise ValueError("files_per_partition needs partition_by")
        salt = F.pmod(F.xxhash64(*[ref(c) for c in df.columns]), F.lit(files_per_partition))
        df = df.repartition(*[ref(c) for c in partition_by], salt)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def export_distinct(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    sep: str = ",",
    mode: str = "overwrite",
) -> str:
    """Distinct combinations of ``columns`` as delimited files with a header."""
    (
        df.select(*[ref(c) for c in columns])
        .distinct()
        .write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .csv(path)
    )
    return path


def export_distinct_values(
    df: DataFrame,
    path: str,
    columns: Iterable[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Distinct values of every string column as JSON lines, one folder per column."""
    (
        distinct_values(df, columns)
        .write.mode(mode)
        .partitionBy("column_name")
        .json(path)
    )
    return path
