"""Registered queries: one Spark plan per operator, each with a DuckDB oracle.

Every query reads whole driver tables (or data Spark derives from them) and
returns a DataFrame; nothing is collected. ``ORACLE_SQL`` holds the same
computation in plain SQL over the driver's tables, with identical output
column names, for the side-by-side correctness check.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reglink.operators import link as L
from reglink.operators import profile as P
from reglink.plans import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


# --- SQL twins of the fixtures ------------------------------------------------

PROFILED_PART_SQL = """
profiled as (
  select p_partkey,
         case when p_size > 48 then null else p_name end as p_name,
         case when p_brand = 'Brand#13' then '' else p_brand end as p_brand,
         case when p_type = 'PROMO' then 'VAGO'
              when p_type = 'SMALL' and p_size < 10 then 'RUA SEM DENOMINACAO'
              else p_type end as p_type,
         case when p_size = 1 then null else p_size end as p_size,
         p_retailprice
  from part
)"""

REGISTRIES_SQL = r"""
est as (
  select p_partkey as CO_UNIDADE,
         p_name as NO_FANTASIA,
         concat_ws(' ', p_brand, p_type) as NO_LOGRADOURO,
         cast(p_size as varchar) as NU_ENDERECO,
         p_size * 1000 + cast(regexp_extract(p_brand, '#(\d+)', 1) as integer) as CO_CEP,
         case when p_type = 'PROMO' then 'S/N'
              else '-' || cast(p_size as varchar) || ',25' end as NU_LATITUDE,
         case when p_type = 'LARGE' then '1.' || regexp_extract(p_brand, '#(\d+)', 1) || ',5'
              else '-' || regexp_extract(p_brand, '#(\d+)', 1) || ',' end as NU_LONGITUDE
  from part where p_partkey % 2 = 0
),
adr as (
  select p_partkey as COD_UNICO_ENDERECO,
         p_name as DSC_ESTABELECIMENTO,
         p_brand as NOM_TIPO_SEGLOGR,
         cast(null as varchar) as NOM_TITULO_SEGLOGR,
         p_type as NOM_SEGLOGR,
         p_size as NUM_ENDERECO,
         lpad(cast(p_size * 1000 + cast(regexp_extract(p_brand, '#(\d+)', 1) as integer) as varchar), 8, '0') as CEP,
         -(p_size + 0.25) as LATITUDE,
         -cast(regexp_extract(p_brand, '#(\d+)', 1) as double) as LONGITUDE,
         case when p_size <= 45 then 5 else 9 end as COD_ESPECIE
  from part where p_partkey % 2 = 1
)"""

# Both registries over every part, for queries that look at one of them only.
WHOLE_SQL = REGISTRIES_SQL.replace(" where p_partkey % 2 = 0", "").replace(" where p_partkey % 2 = 1", "")


def _decimal_sql(x: str) -> str:
    cleaned = f"regexp_replace(replace(trim({x}), ',', '.'), '\\.$', '.0')"
    return (
        f"case when regexp_matches({cleaned}, '^-?\\d+(\\.\\d+)?([eE][+-]?\\d+)?$') "
        f"then try_cast({cleaned} as double) end"
    )


def _postal_sql(x: str) -> str:
    digits = f"nullif(regexp_replace(cast({x} as varchar), '[^0-9]', '', 'g'), '')"
    return f"case when length({digits}) < 8 then lpad({digits}, 8, '0') else {digits} end"


KEYED_SQL = f"""
lk as (
  select CO_UNIDADE as id, NO_FANTASIA as name, NO_LOGRADOURO as street,
         NU_ENDERECO as num, {_postal_sql('CO_CEP')} as pc,
         {_decimal_sql('NU_LATITUDE')} as lat, {_decimal_sql('NU_LONGITUDE')} as lon
  from est
),
rk as (
  select COD_UNICO_ENDERECO as id, DSC_ESTABELECIMENTO as name,
         nullif(concat_ws(' ', NOM_TIPO_SEGLOGR, NOM_TITULO_SEGLOGR, NOM_SEGLOGR), '') as street,
         cast(NUM_ENDERECO as varchar) as num, {_postal_sql('CEP')} as pc,
         LATITUDE as lat, LONGITUDE as lon
  from adr where COD_ESPECIE = 5
)"""

RULE_CONDITIONS = {
    "coordinates": "lk.lat = rk.lat and lk.lon = rk.lon",
    "name": "lk.name = rk.name",
    "name_street": "lk.name = rk.name and lk.street = rk.street",
    "name_street_number": "lk.name = rk.name and lk.street = rk.street and lk.num = rk.num",
    "name_postal": "lk.name = rk.name and lk.pc = rk.pc",
}


# --- profiling ---------------------------------------------------------------

def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.profiled_part(X.table(spark, sf_dir, "part"))


PROFILE_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
STRING_COLUMNS = ["p_name", "p_brand", "p_type"]


def _per_column_sql(select_for: Callable[[str], str], columns: list[str]) -> str:
    return "\n  union all\n".join(select_for(c) for c in columns)


def _strict_sql(c: str) -> str:
    if c in STRING_COLUMNS:
        return f"{c} is not null and not (contains({c}, 'SEM DENOMINACAO') or contains({c}, 'VAGO'))"
    return f"{c} is not null"


@register(
    "fill_profile",
    f"with {PROFILED_PART_SQL}\nselect * from (\n"
    + _per_column_sql(
        lambda c: f"  select '{c}' as column_name, count({c}) / count(*) * 100 as fulfillment_pct from profiled",
        PROFILE_COLUMNS,
    )
    + "\n) order by fulfillment_pct desc, column_name",
)
def q_fill_profile(spark, sf_dir):
    return P.fill_profile(_profiled(spark, sf_dir))


@register(
    "strict_fill_profile",
    f"with {PROFILED_PART_SQL}\nselect * from (\n"
    + _per_column_sql(
        lambda c: f"  select '{c}' as column_name, count_if({_strict_sql(c)}) / count(*) * 100 as fulfillment_pct from profiled",
        PROFILE_COLUMNS,
    )
    + "\n) order by fulfillment_pct desc, column_name",
)
def q_strict_fill_profile(spark, sf_dir):
    return P.strict_fill_profile(_profiled(spark, sf_dir))


_COMPARISON_SQL = (
    f"with {PROFILED_PART_SQL},\nrates as (\n"
    + _per_column_sql(
        lambda c: (
            f"  select '{c}' as column_name, count({c}) / count(*) * 100 as b, "
            f"count_if({_strict_sql(c)}) / count(*) * 100 as s from profiled"
        ),
        PROFILE_COLUMNS,
    )
    + "\n),\ncmp as (select column_name, round(b, 4) as pct_basic, round(s, 4) as pct_strict, "
    "round(s - b, 4) as diff from rates)\n"
)


@register("fill_comparison", _COMPARISON_SQL + "select * from cmp order by pct_strict desc, column_name")
def q_fill_comparison(spark, sf_dir):
    return P.fill_comparison(_profiled(spark, sf_dir))


@register(
    "fill_losses",
    _COMPARISON_SQL + "select column_name, diff from cmp where diff <> 0 order by diff, column_name",
)
def q_fill_losses(spark, sf_dir):
    return P.fill_losses(P.fill_comparison(_profiled(spark, sf_dir)))


@register(
    "empty_profile",
    f"with {PROFILED_PART_SQL}\nselect * from (\n"
    + _per_column_sql(
        lambda c: f"  select '{c}' as column_name, count_if({c} = '') as empty_count from profiled",
        STRING_COLUMNS,
    )
    + "\n) order by empty_count desc, column_name",
)
def q_empty_profile(spark, sf_dir):
    return P.empty_profile(_profiled(spark, sf_dir))


_LONG_SQL = (
    f"with {PROFILED_PART_SQL},\nlong as (\n"
    + _per_column_sql(
        lambda c: f"  select '{c}' as column_name, cast({c} as varchar) as value from profiled",
        PROFILE_COLUMNS,
    )
    + "\n)\n"
)


@register(
    "value_frequencies",
    _LONG_SQL
    + """select column_name, value, frequency, rank from (
  select column_name, value, count(*) as frequency,
         row_number() over (partition by column_name order by count(*) desc, value asc) as rank
  from long where value is not null group by column_name, value
) where rank <= 10""",
)
def q_value_frequencies(spark, sf_dir):
    return P.value_frequencies(_profiled(spark, sf_dir), k=10)


@register(
    "distinct_values",
    f"with {PROFILED_PART_SQL},\nvals as (\n"
    + _per_column_sql(
        lambda c: f"  select distinct '{c}' as column_name, {c} as value from profiled",
        STRING_COLUMNS,
    )
    + "\n)\nselect v.column_name, v.value, c.n_values from vals v "
    "join (select column_name, count(*) as n_values from vals group by column_name) c using (column_name)",
)
def q_distinct_values(spark, sf_dir):
    return P.distinct_values(_profiled(spark, sf_dir)).select("column_name", "value", "n_values")


@register("distinct_count", "select count(distinct o_custkey) as n_distinct from orders")
def q_distinct_count(spark, sf_dir):
    return P.distinct_count(X.table(spark, sf_dir, "orders"), ["o_custkey"])


@register(
    "distinct_count_pair",
    "select count(distinct (p_name, p_brand)) as n_distinct from part",
)
def q_distinct_count_pair(spark, sf_dir):
    return P.distinct_count(X.table(spark, sf_dir, "part"), ["p_name", "p_brand"])


@register(
    "duplicate_groups",
    """select c_nationkey, c_mktsegment, count(*) as n from customer
group by c_nationkey, c_mktsegment
order by n desc, c_nationkey asc nulls first, c_mktsegment asc nulls first
limit 100""",
)
def q_duplicate_groups(spark, sf_dir):
    return P.duplicate_groups(X.table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], k=100)


# --- expressions ---------------------------------------------------------------

@register(
    "parse_decimal",
    f"with {WHOLE_SQL}\nselect CO_UNIDADE, NU_LATITUDE, NU_LONGITUDE, "
    f"{_decimal_sql('NU_LATITUDE')} as lat_d, {_decimal_sql('NU_LONGITUDE')} as lon_d from est",
)
def q_parse_decimal(spark, sf_dir):
    est = X.establishments(X.table(spark, sf_dir, "part"), whole=True)
    return P.with_coordinates(est, "NU_LATITUDE", "NU_LONGITUDE").select(
        "CO_UNIDADE", "NU_LATITUDE", "NU_LONGITUDE", "lat_d", "lon_d"
    )


@register(
    "compose_key",
    f"with {WHOLE_SQL}\nselect COD_UNICO_ENDERECO, "
    "concat_ws(' ', NOM_TIPO_SEGLOGR, NOM_TITULO_SEGLOGR, NOM_SEGLOGR) as street, "
    "nullif(concat_ws(' ', NOM_TITULO_SEGLOGR, NOM_TITULO_SEGLOGR), '') as empty_key from adr",
)
def q_compose_key(spark, sf_dir):
    from reglink.functions.expr import compose_key

    adr = X.addresses(X.table(spark, sf_dir, "part"), whole=True)
    return adr.select(
        "COD_UNICO_ENDERECO",
        compose_key("NOM_TIPO_SEGLOGR", "NOM_TITULO_SEGLOGR", "NOM_SEGLOGR").alias("street"),
        compose_key("NOM_TITULO_SEGLOGR", "NOM_TITULO_SEGLOGR", as_key=True).alias("empty_key"),
    )


@register(
    "split_malformed",
    f"""with {WHOLE_SQL},
p as (select NU_LATITUDE, NU_LONGITUDE, {_decimal_sql('NU_LATITUDE')} as lat,
             {_decimal_sql('NU_LONGITUDE')} as lon from est)
select count(*) as n_rows,
       count_if(lat is not null and lon is not null) as n_valid,
       count_if(lat is null or lon is null) as n_malformed,
       count(distinct (NU_LATITUDE, NU_LONGITUDE)) filter (where lat is null or lon is null) as n_malformed_values
from p""",
)
def q_split_malformed(spark, sf_dir):
    est = X.establishments(X.table(spark, sf_dir, "part"), whole=True)
    return P.malformed_summary(est, "NU_LATITUDE", "NU_LONGITUDE")


@register(
    "malformed_values",
    f"""with {WHOLE_SQL}
select distinct NU_LATITUDE, NU_LONGITUDE from est
where {_decimal_sql('NU_LATITUDE')} is null or {_decimal_sql('NU_LONGITUDE')} is null""",
)
def q_malformed_values(spark, sf_dir):
    est = X.establishments(X.table(spark, sf_dir, "part"), whole=True)
    return P.split_malformed(est, "NU_LATITUDE", "NU_LONGITUDE").malformed_values


def _split_sql(where: str) -> str:
    return f"""with {WHOLE_SQL},
p as (select est.*, {_decimal_sql('NU_LATITUDE')} as lat_d, {_decimal_sql('NU_LONGITUDE')} as lon_d from est)
select * from p where {where}"""


def _written_split(spark, sf_dir):
    from reglink.session import staging_dir

    est = X.establishments(X.table(spark, sf_dir, "part"), whole=True)
    return P.write_split(est, "NU_LATITUDE", "NU_LONGITUDE", staging_dir(spark, "verdicts"))


@register("valid_rows", _split_sql("lat_d is not null and lon_d is not null"))
def q_valid_rows(spark, sf_dir):
    """Rows with both coordinates, from one write by verdict."""
    return _written_split(spark, sf_dir).valid


@register("malformed_rows", _split_sql("lat_d is null or lon_d is null"))
def q_malformed_rows(spark, sf_dir):
    return _written_split(spark, sf_dir).malformed


@register("bad_values", ORACLE_SQL["malformed_values"])
def q_bad_values(spark, sf_dir):
    return _written_split(spark, sf_dir).malformed_values


# --- sketches kept per state and month --------------------------------------------

_SKETCHED = ("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
# A sketch of 2**14 registers has a relative error of about 0.8 %.
_SKETCH_ERROR = 0.05


@register(
    "merged_sketches",
    "select o_orderstatus, column_name, count(*) as n_rows, count(distinct v) as n_distinct, true as within_error from (\n"
    + "\nunion all\n".join(f"select o_orderstatus, '{c}' as column_name, cast({c} as varchar) as v from orders" for c in _SKETCHED)
    + "\n) group by 1, 2",
)
def q_merged_sketches(spark, sf_dir):
    """Sketches per state and month, written, then merged to states without
    the rows; beside them the exact counts they are held against."""
    from reglink.session import staging_dir

    orders = X.table(spark, sf_dir, "orders")
    monthly = orders.withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    kept = staging_dir(spark, "sketches")
    P.distinct_sketch(monthly, _SKETCHED, ["o_orderstatus", "month"]).write.parquet(kept)
    estimate = P.sketch_estimate(P.merge_sketches(spark.read.parquet(kept), ["o_orderstatus"])).withColumnRenamed("n_distinct", "estimate")
    exact = orders.groupBy("o_orderstatus").agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).unpivot(["o_orderstatus"], list(_SKETCHED), "column_name", "n_distinct")
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.ceil(F.col("n_distinct") * _SKETCH_ERROR)
    return estimate.join(exact, ["o_orderstatus", "column_name"]).select("o_orderstatus", "column_name", "n_rows", "n_distinct", near.alias("within_error"))


# --- linkage -------------------------------------------------------------------

def registries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = X.table(spark, sf_dir, "part")
    return X.establishments(part), L.health_addresses(X.addresses(part))


def _link_query(rule_name: str) -> Query:
    def q(spark, sf_dir):
        est, adr = registries(spark, sf_dir)
        rule = L.rule_by_name(L.registry_rules(), rule_name)
        return L.link(est, adr, rule, right_id="COD_UNICO_ENDERECO")

    return q


for _rule, _cond in RULE_CONDITIONS.items():
    register(
        f"link_{_rule}",
        f"""with {REGISTRIES_SQL},{KEYED_SQL}
select est.*, coalesce(m.n, 0) as r_matches, m.first_id as r_first_id
from est left join (
  select lk.id, count(*) as n, min(rk.id) as first_id
  from lk join rk on {_cond} group by lk.id
) m on est.CO_UNIDADE = m.id""",
    )(_link_query(_rule))


def _all_rules_sql() -> str:
    parts = [
        f"""select est.CO_UNIDADE, '{rule}' as rule, coalesce(m.n, 0) as matches, m.first_id
from est left join (select lk.id, count(*) as n, min(rk.id) as first_id from lk join rk on {cond} group by lk.id) m on est.CO_UNIDADE = m.id"""
        for rule, cond in RULE_CONDITIONS.items()
    ]
    return f"with {REGISTRIES_SQL},{KEYED_SQL}\n" + "\nunion all\n".join(parts)


@register("link_all_rules", _all_rules_sql())
def q_link_all_rules(spark, sf_dir):
    """Every establishment's partners under each of the five rules, by one join."""
    est, adr = registries(spark, sf_dir)
    return L.link_all(est, adr, L.registry_rules(), "CO_UNIDADE", "COD_UNICO_ENDERECO")


def _report_sql() -> str:
    parts = []
    for rule, cond in RULE_CONDITIONS.items():
        parts.append(
            f"""  select '{rule}' as rule,
         (select count(*) from est) as left_total,
         (select count(*) from rk) as right_total,
         (select count(*) from lk join rk on {cond}) as pairs,
         (select count(distinct lk.id) from lk join rk on {cond}) as matched_left,
         (select count(distinct rk.id) from lk join rk on {cond}) as matched_right"""
        )
    body = "\n  union all\n".join(parts)
    return (
        f"with {REGISTRIES_SQL},{KEYED_SQL},\nr as (\n{body}\n)\n"
        "select *, pairs / left_total * 100 as pair_coverage_pct, "
        "matched_left / left_total * 100 as record_coverage_pct from r"
    )


@register("match_report", _report_sql())
def q_match_report(spark, sf_dir):
    est, adr = registries(spark, sf_dir)
    return L.match_report(est, adr, L.registry_rules())


# --- sources and sinks ---------------------------------------------------------

from reglink.session import staging_dir  # noqa: E402
from reglink.sources import registry as R  # noqa: E402
from reglink.sources import store as S  # noqa: E402

_STATE_LABEL_SQL = "o_orderstatus || o_orderstatus"
_ORDERS_FILE_COLS = "o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority"


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.load_partitioned(spark, X.stage_state_folders(spark, sf_dir), X.orders_file_schema())


@register(
    "load_partitioned",
    f"select {_ORDERS_FILE_COLS}, {_STATE_LABEL_SQL} as UF from orders",
)
def q_load_partitioned(spark, sf_dir):
    return _loaded(spark, sf_dir)


_COUNTS_SQL = (
    f"select UF, count(*) as n_rows from (select {_STATE_LABEL_SQL} as UF from orders) "
    "group by rollup (UF) order by UF nulls last"
)


@register("source_counts", _COUNTS_SQL)
def q_source_counts(spark, sf_dir):
    return R.source_counts(_loaded(spark, sf_dir))


@register("integrate", _COUNTS_SQL)
def q_integrate(spark, sf_dir):
    """Folders of delimited files -> one Parquet table partitioned by state;
    the per-state and total counts are metrics of that write, so one job
    reads the data."""
    raw = X.stage_state_folders(spark, sf_dir)
    return S.write_counted(R.load_partitioned(spark, raw, X.orders_file_schema()), staging_dir(spark, "integrated"), "UF", R.state_labels(spark, raw))


@register("replace_state", f"select {_ORDERS_FILE_COLS}, {_STATE_LABEL_SQL} as UF from orders")
def q_replace_state(spark, sf_dir):
    """The whole table committed, then one state ingested again: its
    partition is replaced, the others keep their files."""
    out = staging_dir(spark, "states-table")
    loaded = _loaded(spark, sf_dir)
    S.replace_partitions(loaded, out, "UF")
    S.replace_partitions(loaded.where(F.col("UF") == "FF"), out, "UF")
    return R.read_table(spark, out)


@register("committed_files", f"select {_STATE_LABEL_SQL} as label, count(*) as n_rows, 0 as n_faults from orders group by 1")
def q_committed_files(spark, sf_dir):
    """Rows per state by the manifest of such a table, and files that differ
    from it (none)."""
    out = staging_dir(spark, "states-table")
    loaded = _loaded(spark, sf_dir)
    S.replace_partitions(loaded, out, "UF")
    S.replace_partitions(loaded.where(F.col("UF") == "FF"), out, "UF")
    listed = S.manifest(spark, out).select("label", "n_rows", F.lit(0).alias("fault"))
    faults = S.verify_partitions(spark, out, "UF").select("label", F.lit(0).alias("n_rows"), F.lit(1).alias("fault"))
    return listed.unionByName(faults).groupBy("label").agg(F.sum("n_rows").alias("n_rows"), F.sum("fault").alias("n_faults"))


@register(
    "read_rejects",
    "select count(*) as n_rows, count_if(o_orderstatus = 'P') as n_rejected, "
    "count_if(o_orderstatus <> 'P') as n_accepted from orders",
)
def q_read_rejects(spark, sf_dir):
    df = R.read_registry(spark, X.stage_typed_rejects(spark, sf_dir), X.orders_file_schema(), keep_rejects=True)
    return R.rejected_summary(df)


@register("union_sources", "select * from orders")
def q_union_sources(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus").eqNullSafe("F")
    finished = orders.where(done)
    rest = orders.where(~done).select(*reversed(orders.columns))
    return R.union_sources([finished, rest])


@register("write_table", "select * from part")
def q_write_table(spark, sf_dir):
    part = X.table(spark, sf_dir, "part")
    out = staging_dir(spark, "part")
    R.write_table(part, out, partition_by=["p_type"])
    return R.read_table(spark, out, schema=part.schema)


@register("export_distinct", "select distinct p_brand, p_type from part")
def q_export_distinct(spark, sf_dir):
    part = X.table(spark, sf_dir, "part")
    out = staging_dir(spark, "brand_type")
    R.export_distinct(part, ["p_brand", "p_type"], out)
    return R.read_registry(spark, out, part.select("p_brand", "p_type").schema, sep=",")


@register("export_distinct_values", ORACLE_SQL["distinct_values"])
def q_export_distinct_values(spark, sf_dir):
    out = staging_dir(spark, "distinct_values")
    R.export_distinct_values(_profiled(spark, sf_dir), out)
    return spark.read.schema("value string, n_values bigint, column_name string").json(out).select(
        "column_name", "value", "n_values"
    )


# --- acquisition re-aimed as Spark jobs -----------------------------------------

from reglink.operators import ingest as I  # noqa: E402
from reglink.operators import landing as LD  # noqa: E402
from reglink.sources import archives as Z  # noqa: E402
from reglink.sources.schemas import STATE_FOLDER_GLOB  # noqa: E402

_BOUNDS_SQL = (
    "bounds as (select o_custkey, min(o_orderdate) as first_ts, max(o_orderdate) as last_ts "
    "from orders group by o_custkey)"
)
_CALENDAR_SQL = (
    "calendar as (select o_custkey, strftime(m, '%Y%m') as period from ("
    "select o_custkey, unnest(generate_series(date_trunc('month', first_ts), "
    "date_trunc('month', last_ts), interval 1 month)) as m from bounds))"
)


@register("month_calendar", f"with {_BOUNDS_SQL}, {_CALENDAR_SQL} select o_custkey, period from calendar")
def q_month_calendar(spark, sf_dir):
    """Every month of each customer's active span (first to last order)."""
    bounds = I.period_bounds(X.table(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"])
    return I.month_calendar(bounds, "first_ts", "last_ts", ["o_custkey"])


@register(
    "missing_periods",
    f"""with {_BOUNDS_SQL}, {_CALENDAR_SQL},
landed as (select distinct o_custkey, strftime(o_orderdate, '%Y%m') as period from orders)
select c.o_custkey, c.period from calendar c
where not exists (select 1 from landed l where l.o_custkey = c.o_custkey and l.period = c.period)""",
)
def q_missing_periods(spark, sf_dir):
    """Months inside each customer's span with no order (expected minus landed)."""
    return I.gap_report(X.table(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"])


@register(
    "landed_periods",
    "select distinct o_orderstatus, strftime(o_orderdate, '%Y%m') as period from orders",
)
def q_landed_periods(spark, sf_dir):
    return I.landed_periods(X.table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderstatus"])


_LANDING_RANGE = ("1991-07-01", "2003-06-30")


@register(
    "missing_landings",
    """select strftime(m, '%Y%m') as period
from (select unnest(generate_series(date '1991-07-01', date '2003-06-01', interval 1 month)) as m)
where strftime(m, '%Y%m') not in (select strftime(o_orderdate, '%Y%m') from orders where o_orderdate is not null)""",
)
def q_missing_landings(spark, sf_dir):
    """Months without a whole folder among monthly dumps of the orders, by a
    ledger brought up to date in two runs; an empty, a half-written and a
    zero-length folder lie among them."""
    root, ledger = X.stage_monthly_dumps(spark, sf_dir), staging_dir(spark, "ledger")
    start, end = _LANDING_RANGE
    LD.update_ledger(spark, root, ledger, start, "1996-12-31")
    LD.update_ledger(spark, root, ledger, start, end)
    return LD.missing_landings(spark, ledger, start, end)


def _entities_sql(x: str) -> str:
    for entity, char in I.HTML_ENTITIES:
        x = f"replace({x}, '{entity.replace(chr(39), chr(39) * 2)}', '{char.replace(chr(39), chr(39) * 2)}')"
    return x


def _links_sql() -> str:
    # Patterns of its own, not the module's.
    anchor = r"(?is)<a\s[^>]*>.*?</a>"
    href = r"""(?is)^<a\s[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""".replace("'", "''")
    text = r"(?is)^<a\s[^>]*>(.*)</a>$"
    return rf"""with a as (
  select page_id, url, unnest(l) as a, unnest(generate_series(0, len(l) - 1)) as link_no
  from (select page_id, url, regexp_extract_all(html, '{anchor}', 0) as l from pages)
),
h as (
  select page_id, url, link_no,
         regexp_extract(a, '{href}', 1) as raw_href,
         trim({_entities_sql("regexp_replace(regexp_extract(a, '" + text + "', 1), '<[^>]*>', '', 'g')")}) as text
  from a
),
k as (
  select page_id, link_no, {_entities_sql("regexp_replace(raw_href, '^[\"'']|[\"'']$', '', 'g')")} as href, text, url
  from h where raw_href <> ''
),
n as (
  select *, regexp_replace(href, '/+$', '') as name,
         regexp_replace(url, '[?#].*$', '') as page
  from k
),
o as (select *, regexp_extract(page, '{I.ORIGIN_REGEX}', 0) as origin from n)
select page_id, cast(link_no as bigint) as link_no, href, text, name,
       case when text <> 'Parent Directory' and ends_with(href, '/')
                 and regexp_matches(name, '{I.STATE_FOLDER_REGEX}') then 'folder'
            when text <> 'Parent Directory' and ends_with(href, '.zip') then 'archive'
            else 'other' end as kind,
       case when regexp_matches(name, '{I.SCHEME_REGEX}') then name
            when starts_with(name, '/') then origin || name
            when page = origin then page || '/' || name
            else regexp_extract(page, '^(.*/)', 1) || name end as link_url
from o"""


@register("extract_links", _links_sql())
def q_extract_links(spark, sf_dir):
    return I.extract_links(X.table(spark, sf_dir, "pages"), keys=["page_id"])


# The same links by another road: the listing's entries from their templates,
# the pages' own anchors (all written <a href="...">) by cutting at that text.
_INDEX_LINKS_SQL = """
u as (
  select page_id, url, html, split_part(split_part(url, '#', 1), '?', 1) as page, split_part(url, '#', 1) as whole, split_part(url, '/', 1) as scheme,
    split_part(url, '/', 1) || '//' || split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1) as origin,
    ['11_RO', '35_SP', '33_RJ'][page_id % 3 + 1] as state, cast(page_id as varchar) as p from pages
),
f as (
  select *, case when page = origin then origin || '/' else page[1:length(page) - strpos(reverse(page), '/') + 1] end as folder from u
),
g as (
  select *, case when folder = origin || '/' then folder
    else folder[1:length(folder) - 1][1:length(folder) - strpos(reverse(folder[1:length(folder) - 1]), '/')] end as parent from f
),
listing as (
  select page_id, unnest([
    {'link_no': 0, 'href': state || '/', 'text': state, 'name': state, 'kind': 'folder', 'link_url': folder || state},
    {'link_no': 1, 'href': '17_TO//', 'text': 'T&O', 'name': '17_TO', 'kind': 'folder', 'link_url': folder || '17_TO'},
    {'link_no': 2, 'href': 'data/m' || p || '.zip', 'text': 'm' || p, 'name': 'data/m' || p || '.zip', 'kind': 'archive', 'link_url': folder || 'data/m' || p || '.zip'},
    {'link_no': 3, 'href': '../up' || p || '.zip', 'text': 'up', 'name': '../up' || p || '.zip', 'kind': 'archive', 'link_url': parent || 'up' || p || '.zip'},
    {'link_no': 4, 'href': '../', 'text': 'Parent Directory', 'name': '..', 'kind': 'other', 'link_url': parent},
    {'link_no': 5, 'href': '/pub/12_AC/', 'text': 'nested', 'name': '/pub/12_AC', 'kind': 'other', 'link_url': origin || '/pub/12_AC'},
    {'link_no': 6, 'href': '//mirror.example.org/x.zip', 'text': 'mirror', 'name': '//mirror.example.org/x.zip', 'kind': 'archive', 'link_url': scheme || '//mirror.example.org/x.zip'},
    {'link_no': 7, 'href': '?C=N;O=D', 'text': 'Name', 'name': '?C=N;O=D', 'kind': 'other', 'link_url': page || '?C=N;O=D'},
    {'link_no': 8, 'href': '#top', 'text': 'top', 'name': '#top', 'kind': 'other', 'link_url': whole || '#top'},
    {'link_no': 10, 'href': 'x.ZIP', 'text': 'bare', 'name': 'x.ZIP', 'kind': 'other', 'link_url': folder || 'x.ZIP'},
    {'link_no': 11, 'href': './a/./b/../c.zip', 'text': 'dots', 'name': './a/./b/../c.zip', 'kind': 'archive', 'link_url': folder || 'a/c.zip'},
    {'link_no': 12, 'href': 'last.zip', 'text': 'Parent Directory', 'name': 'last.zip', 'kind': 'other', 'link_url': folder || 'last.zip'}
  ], recursive := true) from g
),
cut as (
  select page_id, origin, i, string_split(html, '<a href="')[i + 1] as piece
  from g, unnest(range(1, len(string_split(html, '<a href="')))) as t(i)
),
own as (
  select page_id, i + 12 as link_no, split_part(piece, '"', 1) as href, split_part(split_part(piece, '>', 2), '<', 1) as text, origin from cut
),
links as (
  select page_id, cast(link_no as bigint) as link_no, href, text, name, kind, link_url from listing
  union all
  select page_id, cast(link_no as bigint), href, text, rtrim(href, '/'), 'other', origin || rtrim(href, '/') from own
)"""


def _index_links(spark, sf_dir):
    return I.extract_links(X.index_pages(X.table(spark, sf_dir, "pages")), keys=["page_id"])


@register("extract_index_links", f"with {_INDEX_LINKS_SQL} select * from links")
def q_extract_index_links(spark, sf_dir):
    """Anchors of pages that begin with a folder listing: folders, archives,
    parent links, unclosed anchors, every way to write a relative link."""
    return _index_links(spark, sf_dir)


@register("state_folders", f"with {_INDEX_LINKS_SQL} select distinct name from links where kind = 'folder'")
def q_state_folders(spark, sf_dir):
    return I.state_folders(_index_links(spark, sf_dir))


@register("archive_links", f"with {_INDEX_LINKS_SQL} select distinct link_url from links where kind = 'archive'")
def q_archive_links(spark, sf_dir):
    return I.archive_links(_index_links(spark, sf_dir))


_ARCHIVED_COLS = ", ".join(n for n, _ in X.ORDERS_ARCHIVE_FIELDS)


def _expanded(spark, sf_dir):
    return Z.expand_archives(spark, X.stage_archives(spark, sf_dir))


@register("archived_orders", f"select {_ARCHIVED_COLS} from orders")
def q_archived_orders(spark, sf_dir):
    """Zip archives of ``;`` files -> lines on the executors, written once to
    the shared folder -> native CSV parse of the written lines."""
    parsed, _ = Z.ingest_archives(
        spark, X.stage_archives(spark, sf_dir), X.orders_archive_schema(), staging_dir(spark, "expanded")
    )
    return parsed


_BLOCKS_SQL = f"select distinct o_orderstatus || o_orderstatus as UF, o_orderkey // {X.STATE_ARCHIVE_KEYS} as block from orders"


@register(
    "ingest_tally",
    f"select count(*) + 2 as n_archives, count(*) + 1 as n_succeeded, 1 as n_failed from ({_BLOCKS_SQL})",
)
def q_ingest_tally(spark, sf_dir):
    """(n_archives, n_succeeded, n_failed) over state folders of archives: one
    per status and range of keys, one broken, one empty."""
    return Z.ingest_tally(Z.expand_archives(spark, X.stage_state_archives(spark, sf_dir) + "/" + STATE_FOLDER_GLOB))


@register(
    "ingest_tally_states",
    f"""select UF, count(*) + case when UF = 'FF' then 2 else 0 end as n_archives,
  count(*) + case when UF = 'FF' then 1 else 0 end as n_succeeded, case when UF = 'FF' then 1 else 0 end as n_failed
from ({_BLOCKS_SQL}) group by UF""",
)
def q_ingest_tally_states(spark, sf_dir):
    """Archives read and failed per state folder, from the road below."""
    return _archived_states(spark, sf_dir)[1]


@register("archived_states", f"select {_ORDERS_FILE_COLS}, {_STATE_LABEL_SQL} as UF from orders")
def q_archived_states(spark, sf_dir):
    """State folders of archives -> lines packed into tasks by size -> one
    table with a state column, read back whole."""
    return R.read_table(spark, _archived_states(spark, sf_dir)[0])


@register("archived_state_counts", _COUNTS_SQL)
def q_archived_state_counts(spark, sf_dir):
    return R.source_counts(R.read_table(spark, _archived_states(spark, sf_dir)[0]))


def _archived_states(spark, sf_dir):
    out = staging_dir(spark, "archived-states")
    tally = Z.integrate_archives(spark, X.stage_state_archives(spark, sf_dir), out, X.orders_file_schema(), staging_dir(spark, "expanded"))
    return out, tally


# --- cleaning extensions ---------------------------------------------------------

from reglink.functions import clean as C  # noqa: E402

_DIRTY_SQL = (
    "dirty as (select o_orderkey, '  ' || ['"
    + "', '".join(X.DIRTY_WORDS)
    + "'][(o_custkey % "
    + str(len(X.DIRTY_WORDS))
    + ") + 1] || ' ' || o_orderpriority || '  #' || cast(o_orderkey as varchar) || chr(9) as street_raw, "
    "case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%d/%m/%Y') "
    "when o_orderkey % 3 = 1 then strftime(o_orderdate, '%Y%m%d') "
    "else strftime(o_orderdate, '%Y-%m-%d') end "
    "|| case when o_orderpriority = '5-LOW' then '?' else '' end as date_raw from orders)"
)

_SQL_DATE_LAYOUTS = {"yyyy-MM-dd": "%Y-%m-%d", "dd/MM/yyyy": "%d/%m/%Y", "dd-MM-yyyy": "%d-%m-%Y",
                     "dd.MM.yyyy": "%d.%m.%Y", "yyyyMMdd": "%Y%m%d"}


def _clean_sql(x: str) -> str:
    s = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}\\s]', '', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in C.STREET_ABBREVIATIONS.items())
    word = f"case upper(regexp_replace(w, '\\.$', '')) {cases} else w end"
    return f"nullif(array_to_string(list_transform(string_split({s}, ' '), lambda w: {word}), ' '), '')"


def _date_sql(x: str) -> str:
    tries = ", ".join(f"try_strptime({x}, '{_SQL_DATE_LAYOUTS[f]}')" for f in C.DATE_FORMATS)
    return f"strftime(coalesce({tries}), '%Y-%m-%d')"


@register(
    "clean_text",
    f"with {_DIRTY_SQL} select o_orderkey, street_raw, {_clean_sql('street_raw')} as street_clean, "
    f"date_raw, {_date_sql('date_raw')} as date_clean from dirty",
)
def q_clean_text(spark, sf_dir):
    dirty = X.dirty_orders(X.table(spark, sf_dir, "orders"))
    return dirty.select(
        "o_orderkey",
        "street_raw",
        C.clean_text("street_raw").alias("street_clean"),
        "date_raw",
        C.standardize_date("date_raw").alias("date_clean"),
    )


# --- filters and sampling ---------------------------------------------------------

@register("health_addresses", f"with {WHOLE_SQL} select * from adr where COD_ESPECIE = 5")
def q_health_addresses(spark, sf_dir):
    """Address rows of health establishments; the filter reaches the scan."""
    return L.health_addresses(X.addresses(X.table(spark, sf_dir, "part"), whole=True))


# A postal code present at every scale: size 22, brand 13.
POSTAL_PROBE = "00022013"


@register(
    "postal_filter",
    f"with {WHOLE_SQL} select * from est where {_postal_sql('CO_CEP')} = '{POSTAL_PROBE}'",
)
def q_postal_filter(spark, sf_dir):
    """Establishments with one postal code, compared on the normalised key
    (the raw column is an integer that lost its leading zeros)."""
    from reglink.functions.expr import postal_code

    est = X.establishments(X.table(spark, sf_dir, "part"), whole=True)
    return est.where(postal_code("CO_CEP") == F.lit(POSTAL_PROBE))


@register(
    "sample_rows",
    f"""select * from lineitem
where cast('0x' || substr(md5(l_orderkey || ':' || l_linenumber), 1, 8) as bigint) < {int(0.01 * 2**32)}""",
)
def q_sample_rows(spark, sf_dir):
    """One percent of ``lineitem``, chosen by its key (sampling is the feature)."""
    return P.sample_by_key(X.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 0.01)


# --- profiles of a whole wide table -------------------------------------------------

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINEITEM_STRINGS = {"l_returnflag", "l_linestatus"}


def _strict_of(c: str, strings: set[str]) -> str:
    if c in strings:
        return f"{c} is not null and not (contains({c}, 'SEM DENOMINACAO') or contains({c}, 'VAGO'))"
    return f"{c} is not null"


@register(
    "fill_comparison_lineitem",
    "with rates as (\n"
    + _per_column_sql(
        lambda c: (
            f"  select '{c}' as column_name, count({c}) / count(*) * 100 as b, "
            f"count_if({_strict_of(c, LINEITEM_STRINGS)}) / count(*) * 100 as s from lineitem"
        ),
        LINEITEM_COLUMNS,
    )
    + "\n)\nselect column_name, round(b, 4) as pct_basic, round(s, 4) as pct_strict, "
    "round(s - b, 4) as diff from rates order by pct_strict desc, column_name",
)
def q_fill_comparison_lineitem(spark, sf_dir):
    """Basic and strict fill rates of every column of the whole line-item table."""
    return P.fill_comparison(X.table(spark, sf_dir, "lineitem"))


@register(
    "value_frequencies_lineitem",
    "with long as (\n"
    + _per_column_sql(
        lambda c: f"  select '{c}' as column_name, cast({c} as varchar) as value from lineitem",
        LINEITEM_COLUMNS,
    )
    + """\n)
select column_name, value, frequency, rank from (
  select column_name, value, count(*) as frequency,
         row_number() over (partition by column_name order by count(*) desc, value asc) as rank
  from long where value is not null group by column_name, value
) where rank <= 100""",
)
def q_value_frequencies_lineitem(spark, sf_dir):
    """Top-100 values of every column of the whole line-item table, one job."""
    return P.value_frequencies(X.table(spark, sf_dir, "lineitem"), k=100)


@register(
    "range_gaps",
    """select strftime(m, '%Y%m') as period
from (select unnest(generate_series(date '1994-01-01', date '2002-12-01', interval 1 month)) as m) c
where not exists (
  select 1 from orders
  where strftime(o_orderdate, '%Y%m') = strftime(c.m, '%Y%m')
)""",
)
def q_range_gaps(spark, sf_dir):
    """Months of a fixed download range (1994-2002) with no order:
    the expected calendar minus the months that hold rows."""
    return I.range_gaps(X.table(spark, sf_dir, "orders"), "o_orderdate", "1994-01-01", "2002-12-31")


def _norm_number_sql(x: str) -> str:
    # Spark side: upper(trim), leading zeros dropped before a digit, '' -> NULL.
    t = f"upper(trim(cast({x} as varchar)))"
    return f"nullif(regexp_replace({t}, '^0+([0-9])', '\\1'), '')"


_ROUNDED_KEYED_SQL = f"""
lk as (
  select CO_UNIDADE as id, NO_FANTASIA as name, NO_LOGRADOURO as street,
         {_norm_number_sql('NU_ENDERECO')} as num, {_postal_sql('CO_CEP')} as pc,
         round({_decimal_sql('NU_LATITUDE')}, 0) as lat, round({_decimal_sql('NU_LONGITUDE')}, 0) as lon
  from est
),
rk as (
  select COD_UNICO_ENDERECO as id, DSC_ESTABELECIMENTO as name,
         nullif(concat_ws(' ', NOM_TIPO_SEGLOGR, NOM_TITULO_SEGLOGR, NOM_SEGLOGR), '') as street,
         {_norm_number_sql('NUM_ENDERECO')} as num, {_postal_sql('CEP')} as pc,
         round(LATITUDE, 0) as lat, round(LONGITUDE, 0) as lon
  from adr where COD_ESPECIE = 5
)"""


# The establishments of ``fixtures.rough_establishments``.
_ROUGH_SQL = REGISTRIES_SQL.replace("est as (", "plain as (", 1) + """,
est as (
  select * replace (' 00' || NU_ENDERECO as NU_ENDERECO, case when NU_LATITUDE = 'S/N' then 'S/N' else left(NU_LATITUDE, length(NU_LATITUDE) - 2) || '27' end as NU_LATITUDE)
  from plain
)"""


def _rounded_report_sql() -> str:
    return _report_sql().replace(KEYED_SQL, _ROUNDED_KEYED_SQL).replace(REGISTRIES_SQL, _ROUGH_SQL)


@register("match_report_normalized", _rounded_report_sql())
def q_match_report_normalized(spark, sf_dir):
    """All rules with house numbers normalised and coordinates rounded to
    whole degrees, over establishments that match in no other way."""
    part = X.table(spark, sf_dir, "part")
    rules = L.registry_rules(normalize_number=True, coordinate_digits=0)
    return L.match_report(X.rough_establishments(part), L.health_addresses(X.addresses(part)), rules)


@register(
    "match_report_cleaned",
    """with l as (select p_partkey, p_partkey // 2 % 3 = 0 as written_out, upper(p_name) as name, p_type as kind from part where p_partkey % 2 = 0),
r as (select p_partkey, upper(p_name) as name, p_type as kind from part where p_partkey % 2 = 1 and p_size <= 45)
select 'name' as rule, (select count(*) from l) as left_total,
  (select count(*) from l where written_out and name in (select name from r)) as matched_raw,
  (select count(*) from l where name in (select name from r)) as matched_clean,
  (select count(*) from l join r using (name)) as pairs_clean
union all
select 'name_street', (select count(*) from l),
  (select count(*) from l where written_out and (name, kind) in (select (name, kind) from r)),
  (select count(*) from l where (name, kind) in (select (name, kind) from r)),
  (select count(*) from l join r using (name, kind))""",
)
def q_match_report_cleaned(spark, sf_dir):
    """What cleaning adds to the name and street rules, where two thirds of
    the establishments abbreviate what the addresses write out."""
    est, adr = X.messy_registries(X.table(spark, sf_dir, "part"))
    adr = L.health_addresses(adr)
    reports = []
    for clean in (False, True):
        rules = [L.rule_by_name(L.registry_rules(clean=clean), n) for n in ("name", "name_street")]
        reports.append(L.match_report(est, adr, rules))
    raw, cleaned = reports
    raw = raw.select("rule", F.col("matched_left").alias("matched_raw"))
    return cleaned.select("rule", "left_total", F.col("matched_left").alias("matched_clean"), F.col("pairs").alias("pairs_clean")).join(F.broadcast(raw), "rule")


# --- declared and inferred reads ---------------------------------------------------

from reglink.sources.schemas import ADDRESS_SCHEMA  # noqa: E402

_ADR_COLS = ("COD_UNICO_ENDERECO", "DSC_ESTABELECIMENTO", "NOM_TIPO_SEGLOGR", "NOM_SEGLOGR", "NUM_ENDERECO", "CEP", "LATITUDE", "LONGITUDE", "COD_ESPECIE")
_DOTTED_SQL = WHOLE_SQL.replace("est as (", "plain as (", 1) + """,
est as (
  select * replace (case when CO_UNIDADE // 2 % 3 = 0 then replace(rtrim(NU_LATITUDE, ','), ',', '.') else NU_LATITUDE end as NU_LATITUDE,
    case when CO_UNIDADE // 2 % 3 = 0 then replace(rtrim(NU_LONGITUDE, ','), ',', '.') else NU_LONGITUDE end as NU_LONGITUDE) from plain
)"""


@register(
    "address_schema",
    f"with {WHOLE_SQL} select "
    + ", ".join(f.name if f.name in _ADR_COLS else f"null as {f.name}" for f in ADDRESS_SCHEMA.fields)
    + ", case when NUM_ENDERECO % 2 = 0 then 'RO' else 'SP' end as UF from adr",
)
def q_address_schema(spark, sf_dir):
    """State folders of files with the 34 declared fields, read typed."""
    return R.load_partitioned(spark, X.stage_address_files(spark, sf_dir), ADDRESS_SCHEMA)


@register(
    "inferred_read",
    f"""with {_DOTTED_SQL}
select CO_UNIDADE, NO_FANTASIA, NO_LOGRADOURO, cast(NU_ENDERECO as integer) as NU_ENDERECO, lpad(cast(CO_CEP as varchar), 8, '0') as CO_CEP,
  NU_LATITUDE, NU_LONGITUDE from est""",
)
def q_inferred_read(spark, sf_dir):
    """Types inferred over the whole file, the postal code kept as text."""
    return R.read_registry(spark, X.stage_establishment_file(spark, sf_dir), infer=True, as_string=["CO_CEP"])


@register("preview", "select * from orders order by o_orderdate nulls first, o_orderkey limit 20")
def q_preview(spark, sf_dir):
    return P.preview(X.table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 20)


@register(
    "match_report_raw",
    f"""with {_DOTTED_SQL},
l as (select *, try_cast(NU_LATITUDE as double) as raw_lat, try_cast(NU_LONGITUDE as double) as raw_lon,
  {_decimal_sql('NU_LATITUDE')} as lat, {_decimal_sql('NU_LONGITUDE')} as lon from est where CO_UNIDADE % 2 = 0),
r as (select * from adr where COD_ESPECIE = 5 and COD_UNICO_ENDERECO % 2 = 1)
select 'coordinates_raw' as rule, (select count(*) from l) as left_total, (select count(*) from l join r on raw_lat = LATITUDE and raw_lon = LONGITUDE) as pairs,
  (select count(*) from l where (raw_lat, raw_lon) in (select (LATITUDE, LONGITUDE) from r)) as matched_left
union all
select 'coordinates', (select count(*) from l), (select count(*) from l join r on lat = LATITUDE and lon = LONGITUDE),
  (select count(*) from l where (lat, lon) in (select (LATITUDE, LONGITUDE) from r))""",
)
def q_match_report_raw(spark, sf_dir):
    """Coordinates compared as written and after parsing."""
    part = X.table(spark, sf_dir, "part")
    rules = [L.raw_coordinates_rule(), L.rule_by_name(L.registry_rules(), "coordinates")]
    report = L.match_report(X.dotted_establishments(part), L.health_addresses(X.addresses(part)), rules)
    return report.select("rule", "left_total", "pairs", "matched_left")
