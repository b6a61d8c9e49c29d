"""Column-quality profiling: fill rates, blanks, markers, frequencies, duplicates.

Every profile is one aggregate over one scan: the row total is computed next
to the per-column counts (no separate count action), partial aggregation runs
map-side, and only one small row per task crosses the shuffle. Results are
rows (column, measure...), never driver-side lists.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from reglink.functions.expr import (
    UNDEFINED_MARKERS,
    is_undefined,
    parse_decimal_of,
    string_columns,
)


def ref(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _pct(count: Column, total: Column) -> Column:
    # count / total * 100 in that order; an empty input gives NULL, not an error.
    return F.try_divide(count, total) * F.lit(100)


def _rows_per_column(agg: DataFrame, fields: Sequence[tuple[str, Sequence[tuple[str, Column]]]]) -> DataFrame:
    """Turn one wide aggregate row into one row per profiled column."""
    structs = [
        F.struct(F.lit(name).alias("column_name"), *[expr.alias(alias) for alias, expr in measures])
        for name, measures in fields
    ]
    if not structs:
        raise ValueError("no column to profile")
    return agg.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def fill_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Share of non-NULL values per column: (column, fulfillment_pct), descending."""
    cols = list(columns) if columns is not None else df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(ref(c)).alias(f"__n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = _rows_per_column(
        wide,
        [(c, [("fulfillment_pct", _pct(F.col(f"__n{i}"), F.col("__rows")))]) for i, c in enumerate(cols)],
    )
    return rows.orderBy(F.desc("fulfillment_pct"), F.asc("column_name"))


def _strict_condition(
    df: DataFrame,
    c: str,
    strings: set[str],
    markers: Sequence[str],
    mode: str,
    blank_is_undefined: bool,
) -> Column:
    present = ref(c).isNotNull()
    if c in strings:
        return present & ~is_undefined(ref(c), markers, mode, blank_is_undefined)
    return present


def strict_fill_profile(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    markers: Sequence[str] = UNDEFINED_MARKERS,
    mode: str = "contains",
    blank_is_undefined: bool = False,
) -> DataFrame:
    """Fill rate where string values must also not be "no value" markers."""
    cols = list(columns) if columns is not None else df.columns
    strings = set(string_columns(df))
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [
        F.count_if(_strict_condition(df, c, strings, markers, mode, blank_is_undefined)).alias(f"__s{i}")
        for i, c in enumerate(cols)
    ]
    wide = df.agg(*aggs)
    rows = _rows_per_column(
        wide,
        [(c, [("fulfillment_pct", _pct(F.col(f"__s{i}"), F.col("__rows")))]) for i, c in enumerate(cols)],
    )
    return rows.orderBy(F.desc("fulfillment_pct"), F.asc("column_name"))


def fill_comparison(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    markers: Sequence[str] = UNDEFINED_MARKERS,
    mode: str = "contains",
    blank_is_undefined: bool = False,
    digits: int = 4,
) -> DataFrame:
    """Basic and strict fill rates side by side, in one pass.

    (column, pct_basic, pct_strict, diff): the difference is taken on the
    unrounded rates, then all three are rounded to ``digits`` places. Sorted
    by the strict rate, descending.
    """
    cols = list(columns) if columns is not None else df.columns
    strings = set(string_columns(df))
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(ref(c)).alias(f"__n{i}"))
        aggs.append(
            F.count_if(_strict_condition(df, c, strings, markers, mode, blank_is_undefined)).alias(f"__s{i}")
        )
    wide = df.agg(*aggs)
    fields = []
    for i, c in enumerate(cols):
        basic = _pct(F.col(f"__n{i}"), F.col("__rows"))
        strict = _pct(F.col(f"__s{i}"), F.col("__rows"))
        fields.append((c, [("pct_basic", basic), ("pct_strict", strict)]))
    rows = _rows_per_column(wide, fields)
    rows = rows.select(
        "column_name",
        F.round("pct_basic", digits).alias("pct_basic"),
        F.round("pct_strict", digits).alias("pct_strict"),
        F.round(F.col("pct_strict") - F.col("pct_basic"), digits).alias("diff"),
    )
    return rows.orderBy(F.desc("pct_strict"), F.asc("column_name"))


def fill_losses(comparison: DataFrame) -> DataFrame:
    """Columns whose strict rate is below the basic one: (column, diff), ascending."""
    return (
        comparison.where(F.col("diff") != 0)
        .select("column_name", "diff")
        .orderBy(F.asc("diff"), F.asc("column_name"))
    )


def empty_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Number of empty strings per string column: (column, empty_count).

    Delimited files read with default options turn empty and quoted-empty
    fields into NULL, so on CSV-derived data this is usually zero.
    """
    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        raise ValueError("no string column to profile")
    wide = df.agg(*[F.count_if(ref(c) == F.lit("")).alias(f"__e{i}") for i, c in enumerate(cols)])
    rows = _rows_per_column(wide, [(c, [("empty_count", F.col(f"__e{i}"))]) for i, c in enumerate(cols)])
    return rows.orderBy(F.desc("empty_count"), F.asc("column_name"))


def _long_format(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) rows, values cast to string so mixed types can stack."""
    narrow = df.select(*[ref(c).cast("string").alias(c) for c in cols])
    return narrow.unpivot([], list(cols), "column_name", "value")


def _costly_text(t: DataType) -> bool:
    """Types whose text form is expensive to produce (floating point, dates,
    timestamps, decimals): these are counted typed and cast once per distinct
    value. Integers, strings and the rest are cheap and stack as text."""
    return isinstance(t, (FloatType, DoubleType, DecimalType, DateType, TimestampType, TimestampNTZType))


def _typed_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value text, frequency) of every non-NULL value, counted
    on typed values and cast to text once per distinct value.

    Columns whose text is costly to produce (floating point, temporal,
    decimal) are stacked per type (``unpivot`` needs one type) and counted on
    typed keys, so the conversion runs once per distinct value instead of
    once per row; all other columns stack together as text. Each group is
    one scan, which on Parquet reads only the group's own columns. Float and
    double groups also key on the text of zeros: grouping merges -0.0 with
    0.0, their texts differ.
    """
    groups: dict[DataType, list[str]] = {}
    for c in cols:
        t = df.schema[c].dataType
        groups.setdefault(t if _costly_text(t) else StringType(), []).append(c)
    parts = []
    for t, names in groups.items():
        typed = df.select(*[(ref(c) if _costly_text(t) else ref(c).cast("string")).alias(c) for c in names])
        stacked = typed.unpivot([], list(names), "column_name", "v").where(F.col("v").isNotNull())
        keys = ["column_name", "v"]
        text = F.col("v").cast("string")
        if isinstance(t, (FloatType, DoubleType)):
            stacked = stacked.withColumn("z", F.when(F.col("v") == F.lit(0.0), F.col("v").cast("string")))
            keys.append("z")
            text = F.coalesce(F.col("z"), text)
        counts = stacked.groupBy(*keys).agg(F.count(F.lit(1)).alias("frequency"))
        parts.append(counts.select("column_name", text.alias("value"), "frequency"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def value_frequencies(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    k: int = 100,
) -> DataFrame:
    """Top-``k`` non-NULL values per column: (column, value, frequency, rank).

    One job for all columns: values are stacked into (column, value) per
    column type, counted on typed keys with map-side partial aggregation,
    cast to text once per distinct value, and ranked by count descending,
    value text ascending. The rank filter lets Spark cut each partition to its own top
    ``k`` per column before the per-column exchange, so a near-unique column
    never sends all of its values to one task.
    """
    cols = list(columns) if columns is not None else df.columns
    counts = _typed_counts(df, cols)
    w = Window.partitionBy("column_name").orderBy(F.desc("frequency"), F.asc("value"))
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


def distinct_values(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Distinct values of each string column: (column, value, n_values).

    NULL counts as a value. The per-column number of values comes from an
    aggregate of the same distinct rows (one row per column, a size bounded
    by the schema) joined back, so no column's values meet in one task.
    """
    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        raise ValueError("no column to list")
    values = _long_format(df, cols).distinct()
    per_column = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_values"))
    return values.join(F.broadcast(per_column), "column_name")


def distinct_count(df: DataFrame, columns: Sequence[str], approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Number of distinct non-NULL values (or tuples): one row, ``n_distinct``."""
    cols = [ref(c) for c in columns]
    if approx:
        key = cols[0] if len(cols) == 1 else F.when(
            reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.struct(*cols)
        )
        return df.agg(F.approx_count_distinct(key, rsd).alias("n_distinct"))
    return df.agg(F.count_distinct(*cols).alias("n_distinct"))


def distinct_sketch(df: DataFrame, columns: Iterable[str], by: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """(by..., column_name, n_rows, sketch): per group and column a mergeable
    HyperLogLog sketch of its non-NULL values, as text.

    Kept as a table (per state and month, say), the sketches of old months
    need not be made again: ``merge_sketches`` adds up any groups. One scan
    makes the sketches of all columns; a sketch has at most ``2**lg_k``
    bytes, whatever its group. A column without values has a NULL sketch.
    """
    cols = list(columns)
    if not cols:
        raise ValueError("no column to sketch")
    sketches = [F.hll_sketch_agg(ref(c).cast("string"), lg_k).alias(f"s{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*[ref(c) for c in by]).agg(F.count(F.lit(1)).alias("n"), *[F.count(ref(c)).alias(f"n{i}") for i, c in enumerate(cols)], *sketches)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")).alias("sketch"))
        for i, c in enumerate(cols)
    ]
    return wide.select(*[ref(c) for c in by], F.inline(F.array(*entries)))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, n_rows, sketch) of coarser groups, from the
    sketches alone."""
    return sketches.groupBy(*[ref(c) for c in by], "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch")
    )


def sketch_estimate(sketches: DataFrame) -> DataFrame:
    """(by..., column_name, n_rows, n_distinct): estimates of the sketches, 0
    for a column without values."""
    keep = [ref(c) for c in sketches.columns if c != "sketch"]
    return sketches.select(*keep, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("bigint")).alias("n_distinct"))


def duplicate_groups(
    df: DataFrame, keys: Sequence[str], k: int | None = 100, count_col: str = "n"
) -> DataFrame:
    """Rows per key combination, largest first: (keys..., n).

    NULL keys form their own group. Ties are broken by the keys ascending
    (NULL first) so the top ``k`` is deterministic. The top ``k`` is taken
    per task before one small final merge (``TakeOrderedAndProject``).
    """
    if count_col in keys:
        raise ValueError(f"count column {count_col!r} is also a key; pass another count_col")
    grouped = df.groupBy(*[ref(c) for c in keys]).agg(F.count(F.lit(1)).alias(count_col))
    ordered = grouped.orderBy(F.desc(count_col), *[ref(c).asc_nulls_first() for c in keys])
    return ordered.limit(k) if k is not None else ordered


class MalformedSplit(NamedTuple):
    valid: DataFrame
    malformed: DataFrame
    malformed_values: DataFrame


def with_coordinates(df: DataFrame, lat: str, lon: str, lat_out: str = "lat_d", lon_out: str = "lon_d") -> DataFrame:
    """Add parsed coordinates next to the raw ones."""
    return df.withColumn(lat_out, parse_decimal_of(df, lat)).withColumn(lon_out, parse_decimal_of(df, lon))


def split_malformed(df: DataFrame, lat: str, lon: str) -> MalformedSplit:
    """Rows with both coordinates parsed, rows without, and the distinct bad pairs.

    The three frames share one parse; persist ``df`` first if all three are
    consumed, or use ``malformed_summary`` for the counts in one pass.
    """
    parsed = with_coordinates(df, lat, lon)
    ok = F.col("lat_d").isNotNull() & F.col("lon_d").isNotNull()
    malformed = parsed.where(~ok)
    return MalformedSplit(
        valid=parsed.where(ok),
        malformed=malformed,
        malformed_values=malformed.select(ref(lat), ref(lon)).distinct(),
    )


def write_split(df: DataFrame, lat: str, lon: str, path: str) -> MalformedSplit:
    """The same three frames from one scan and one parse of ``df``: every row
    is written once under ``path``, in a folder per verdict, and the frames
    read their folder. The distinct bad values read two columns of the
    malformed rows only."""
    parsed = with_coordinates(df, lat, lon)
    verdict = "verdict"
    while verdict.lower() in {c.lower() for c in parsed.columns}:
        verdict += "_"
    ok = F.col("lat_d").isNotNull() & F.col("lon_d").isNotNull()
    judged = parsed.withColumn(verdict, F.when(ok, "valid").otherwise("malformed"))
    judged.write.mode("overwrite").partitionBy(verdict).parquet(path)
    # A declared schema: either folder may be missing.
    written = df.sparkSession.read.schema(judged.schema).parquet(path)
    malformed = written.where(F.col(verdict) == "malformed").drop(verdict)
    return MalformedSplit(
        valid=written.where(F.col(verdict) == "valid").drop(verdict),
        malformed=malformed,
        malformed_values=malformed.select(ref(lat), ref(lon)).distinct(),
    )


def malformed_summary(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """(n_rows, n_valid, n_malformed, n_malformed_values) in one aggregate."""
    lat_d = parse_decimal_of(df, lat)
    lon_d = parse_decimal_of(df, lon)
    bad = lat_d.isNull() | lon_d.isNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~bad).alias("n_valid"),
        F.count_if(bad).alias("n_malformed"),
        F.count_distinct(
            F.when(bad, F.struct(ref(lat).cast("string").alias("lat"), ref(lon).cast("string").alias("lon")))
        ).alias("n_malformed_values"),
    )


def preview(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``keys`` (NULLs first), the same on every run;
    rows equal in the keys are ordered by their whole text."""
    text = F.to_json(F.struct(*[ref(c) for c in df.columns]))
    return df.orderBy(*[ref(k).asc_nulls_first() for k in keys], text).limit(n)


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column_name, type, nullable) of every column, from 0."""
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(fields, "position int, column_name string, type string, nullable boolean")


def sample_by_key(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The rows whose keys' MD5 falls below ``share`` of its range. The choice
    depends on the keys alone: not on splits, order or the engine. Rows with
    equal keys go together; NULL keys count as empty."""
    if not 0.0 <= share <= 1.0:
        raise ValueError("share must be within [0, 1]")
    text = F.concat_ws(":", *[F.coalesce(ref(c).cast("string"), F.lit("")) for c in keys])
    value = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(value < F.lit(int(share * 2**32)))


def sample_rows(df: DataFrame, fraction: float, seed: int = 0, with_replacement: bool = False) -> DataFrame:
    """Bernoulli sample of ``fraction`` of the rows, reproducible through ``seed``.

    Each task samples its own split, so the sample costs one scan and no
    shuffle; the same seed over the same input splits gives the same rows.
    """
    if not 0.0 <= fraction <= 1.0 and not with_replacement:
        raise ValueError("fraction must be within [0, 1] without replacement")
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)
