"""Registry linkage by equi-join rules, counted without materialising pairs.

A rule is a conjunction of key equalities between a left registry
(establishments) and a right one (addresses). Join pairs on hot names grow
with the product of the group sizes, so nothing here emits pairs: each side
is first grouped by its key with map-side partial aggregation, and the
grouped sides are joined one row per key. From (n_left, n_right) per key:

* pairs        = sum(n_left * n_right)   -- what a plain inner join counts
* matched_left = sum(n_left) over keys present on both sides

A key with any NULL part never matches, as in an equi-join, but its rows
still count in the totals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from reglink.functions.clean import clean_text
from reglink.functions.expr import compose_key, house_number, parse_decimal_of, postal_code
from reglink.operators.profile import ref
from reglink.sources import schemas as S

KeyFn = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Rule:
    """Named conjunction of key equalities; each part maps a frame to a column."""

    name: str
    left: Sequence[KeyFn]
    right: Sequence[KeyFn]
    # Which parts hold doubles: they are compared as numbers (-0.0 = 0.0).
    numeric: Sequence[bool] = field(default_factory=tuple)

    def __post_init__(self):
        if len(self.left) != len(self.right) or not self.left:
            raise ValueError(f"rule {self.name}: left and right keys must pair up")


def _double_key(c: Column, digits: int | None) -> Column:
    """A double as an exact string key; -0.0 folded into 0.0 like a join would."""
    x = F.round(c, digits) if digits is not None else c
    x = F.when(x == F.lit(0.0), F.lit(0.0)).otherwise(x)
    return x.cast("string")


def _typed_parts(df: DataFrame, fns: Sequence[KeyFn], numeric: Sequence[bool]) -> list[Column]:
    """Key parts as strings (doubles through ``_double_key``)."""
    return [
        _double_key(fn(df), None) if i < len(numeric) and numeric[i] else fn(df).cast("string")
        for i, fn in enumerate(fns)
    ]


def _part_columns(df: DataFrame, rules: Sequence[Rule], side: str) -> tuple[DataFrame, list[list[str]]]:
    """Every key part of every rule as its own column, computed once.

    Parts are typed to strings here (doubles through ``_double_key``) so the
    exploded rows below only reference columns: the parse of a coordinate is
    not repeated inside each NULL test and struct field.
    """
    cols, names = [], []
    for j, r in enumerate(rules):
        parts = _typed_parts(df, r.left if side == "left" else r.right, r.numeric)
        part_names = [f"__r{j}p{i}" for i in range(len(parts))]
        cols += [c.alias(n) for c, n in zip(parts, part_names)]
        names.append(part_names)
    return df.select(*cols), names


def _keyed(df: DataFrame, rules: Sequence[Rule], side: str, width: int) -> DataFrame:
    """One row per (input row, rule): (rule, k0..k{width-1}), in one scan."""
    parts, names = _part_columns(df, rules, side)
    entries = []
    for r, part_names in zip(rules, names):
        cols = [F.col(n) for n in part_names]
        complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
        keys = [F.when(complete, c) for c in cols]
        keys += [F.when(complete, F.lit("")) for _ in range(width - len(cols))]
        entries.append(F.struct(F.lit(r.name).alias("rule"), *[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    return parts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _key_counts(df: DataFrame, rules: Sequence[Rule], side: str, width: int, alias: str) -> DataFrame:
    keys = [f"k{i}" for i in range(width)]
    return _keyed(df, rules, side, width).groupBy("rule", *keys).agg(F.count(F.lit(1)).alias(alias))


def match_report(left: DataFrame, right: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Coverage of every rule in one job.

    (rule, left_total, right_total, pairs, matched_left, matched_right,
    pair_coverage_pct, record_coverage_pct). ``pair_coverage_pct`` is pairs
    over left rows (it exceeds 100 when keys repeat); ``record_coverage_pct``
    is the share of left rows with at least one partner. Each side is
    scanned once for all rules; the join sees one row per distinct key.
    """
    if not rules:
        raise ValueError("no rule")
    width = max(len(r.left) for r in rules)
    keys = [f"k{i}" for i in range(width)]
    lc = _key_counts(left, rules, "left", width, "n_left")
    rc = _key_counts(right, rules, "right", width, "n_right")
    joined = lc.join(rc, on=["rule", *keys], how="full_outer")
    both = F.col("n_left").isNotNull() & F.col("n_right").isNotNull()
    nl = F.coalesce(F.col("n_left"), F.lit(0).cast("bigint"))
    nr = F.coalesce(F.col("n_right"), F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    # NULL keys never match: the full outer join keeps them unmatched on each side.
    contributions = joined.select(
        "rule",
        nl.alias("left_total"),
        nr.alias("right_total"),
        F.when(both, nl * nr).otherwise(zero).alias("pairs"),
        F.when(both, nl).otherwise(zero).alias("matched_left"),
        F.when(both, nr).otherwise(zero).alias("matched_right"),
    )
    # One zero row per rule (literals, built in the JVM) so every rule gets a
    # row even on empty input; it joins the same partial aggregate, no join.
    measures = ("left_total", "right_total", "pairs", "matched_left", "matched_right")
    zeros = left.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(r.name) for r in rules])).alias("rule"), *[zero.alias(m) for m in measures]
    )
    out = contributions.unionByName(zeros).groupBy("rule").agg(*[F.sum(m).alias(m) for m in measures])
    return out.select(
        "*",
        (F.try_divide(F.col("pairs"), F.col("left_total")) * F.lit(100)).alias("pair_coverage_pct"),
        (F.try_divide(F.col("matched_left"), F.col("left_total")) * F.lit(100)).alias("record_coverage_pct"),
    )


def _hashable(df: DataFrame) -> list[Column]:
    """The columns Spark can hash (maps cannot), for a deterministic row salt."""

    def ok(t) -> bool:
        if isinstance(t, MapType):
            return False
        if isinstance(t, ArrayType):
            return ok(t.elementType)
        if isinstance(t, StructType):
            return all(ok(f.dataType) for f in t.fields)
        return True

    cols = [ref(f.name) for f in df.schema.fields if ok(f.dataType)]
    return cols or [F.lit(0)]


def hot_keys(keyed: DataFrame, names: Sequence[str], hot_fraction: float) -> DataFrame:
    """Keys holding at least ``hot_fraction`` of the rows: (names..., __hot)."""
    return _hot_salts(keyed, names, hot_fraction).drop("__salts")


def _hot_salts(keyed: DataFrame, names: Sequence[str], hot_fraction: float) -> DataFrame:
    """The hot keys with the number of such shares of all rows that each
    holds: (names..., __hot, __salts).

    The threshold is a scalar subquery over the key counts (no driver action).
    Since the counts add up to the row total, at most ``1 / hot_fraction``
    keys can pass, which is what makes the result safe to broadcast.
    """
    counts = keyed.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])).groupBy(
        *names
    ).agg(F.count(F.lit(1)).alias("__cnt"))
    total = counts.agg(F.sum("__cnt")).scalar()
    threshold = F.greatest(F.ceil(total * F.lit(hot_fraction)), F.lit(1))
    return counts.where(F.col("__cnt") >= threshold).select(*names, F.lit(True).alias("__hot"), F.ceil(F.col("__cnt") / threshold).alias("__salts"))


def link(
    left: DataFrame,
    right: DataFrame,
    rule: Rule,
    right_id: str,
    prefix: str = "r_",
    hot_fraction: float | None = 0.001,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Left rows enriched with their partners under ``rule``.

    Adds ``{prefix}matches`` (number of right rows with an equal key, 0 when
    none) and ``{prefix}first_id`` (smallest partner id). The right side is
    grouped by key first, so the output has exactly one row per left row
    however hot a key is on the right.

    A hot key on the left (one name holding a third of the rows) would put
    all its rows in one join task; adaptive skew splitting does not apply
    here because the right input is an aggregate, not a plain shuffle. So
    keys holding at least ``hot_fraction`` of the left rows are salted: their
    rows are spread over as many buckets as the key holds such shares by its
    measured count (or over ``salt_buckets``) by a hash of the whole row (the
    same on a task retry), and their single grouped right row is copied once
    per bucket. So a bucket has about ``hot_fraction`` of the rows, whatever
    the key's size. At most ``1 / hot_fraction`` keys are hot, so the hot-key
    list is broadcast with a proven bound. Rows whose key has a NULL part match
    nothing and are spread the same way. ``hot_fraction=None`` disables it.
    ``link_all`` does all rules at once.
    """
    if hot_fraction is not None and not 1e-5 <= hot_fraction <= 1.0:
        raise ValueError("hot_fraction must be in [1e-5, 1]: its inverse bounds the broadcast hot-key list")
    width = len(rule.left)
    # A NULL part never satisfies the equality, so no completeness test is needed.
    lkeys = _typed_parts(left, rule.left, rule.numeric)
    rkeys = _typed_parts(right, rule.right, rule.numeric)
    lnames = [f"__lk{i}" for i in range(width)]
    rnames = [f"__rk{i}" for i in range(width)]
    grouped = (
        right.select(*[k.alias(n) for k, n in zip(rkeys, rnames)], ref(right_id).alias("__rid"))
        .where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in rnames]))
        .groupBy(*rnames)
        .agg(F.count(F.lit(1)).alias("__n"), F.min("__rid").alias("__first"))
    )
    keyed = left.select("*", *[k.alias(n) for k, n in zip(lkeys, lnames)])
    cond = reduce(lambda a, b: a & b, [F.col(l) == F.col(r) for l, r in zip(lnames, rnames)])
    if hot_fraction is not None:
        hot = F.broadcast(_hot_salts(keyed, lnames, hot_fraction))
        spread = F.xxhash64(*_hashable(left))
        buckets = F.col("__salts") if salt_buckets is None else F.lit(salt_buckets).cast("bigint")
        no_key = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in lnames])
        keyed = keyed.join(hot, on=lnames, how="left").select(
            *[ref(c) for c in left.columns],
            *lnames,
            F.when(F.col("__hot"), F.pmod(spread, buckets))
            .when(no_key, F.pmod(spread, F.lit(salt_buckets or math.ceil(1 / hot_fraction))))
            .otherwise(F.lit(0))
            .alias("__lsalt"),
        )
        hot_r = hot.select(*[F.col(l).alias(r) for l, r in zip(lnames, rnames)], "__hot", "__salts")
        grouped = grouped.join(hot_r, on=rnames, how="left").select(
            *rnames,
            "__n",
            "__first",
            F.explode(
                F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), buckets - 1))
                .otherwise(F.array(F.lit(0).cast("bigint")))
            ).alias("__rsalt"),
        )
        cond = cond & (F.col("__lsalt") == F.col("__rsalt"))
    joined = keyed.join(grouped, cond, "left")
    return joined.select(
        *[ref(c) for c in left.columns],
        F.coalesce(F.col("__n"), F.lit(0).cast("bigint")).alias(f"{prefix}matches"),
        F.col("__first").alias(f"{prefix}first_id"),
    )


def _rule_keys(df: DataFrame, rules: Sequence[Rule], side: str, width: int, row_id: str, salt: bool) -> DataFrame:
    """(row_id, hash, rule, k0...): one row per (input row, rule). A key with
    a NULL part is NULL throughout, as it matches nothing."""
    cols, entries = [ref(row_id).alias("row_id"), (F.xxhash64(*_hashable(df)) if salt else F.lit(0).cast("bigint")).alias("hash")], []
    for j, r in enumerate(rules):
        names = [f"r{j}p{i}" for i in range(len(r.left))]
        cols += [c.alias(n) for c, n in zip(_typed_parts(df, r.left if side == "left" else r.right, r.numeric), names)]
        complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
        keys = [F.when(complete, F.col(names[i]) if i < len(names) else F.lit("")).alias(f"k{i}") for i in range(width)]
        entries.append(F.struct(F.lit(r.name).alias("rule"), *keys))
    return df.select(*cols).select("row_id", "hash", F.inline(F.array(*entries)))


def link_all(
    left: DataFrame,
    right: DataFrame,
    rules: Sequence[Rule],
    left_id: str,
    right_id: str,
    target_rows: int = 1_000_000,
    max_hot: int = 50_000,
) -> DataFrame:
    """Partners of every left row under every rule, in one join.

    (left_id, rule, matches, first_id): one row per left row and rule, with
    the number of right rows of equal key (0 when none) and the smallest of
    their ids. Every row becomes one (rule, key) per rule; the right side is
    grouped by (rule, key) and joined once. The right side is read once, the
    left one twice (its keys are counted first; its number of rows comes from
    file footers).

    The join is salted by each key's measured count: a key of n left rows is
    dealt to ``ceil(n / target)`` tasks by a hash of the row, with a copy of
    its one right row for each. NULL keys count as a key per rule and are
    dealt the same way. ``target`` is ``target_rows``, or so much more that at
    most ``max_hot`` keys lie above it: the list of these keys is collected
    and broadcast, and ``max_hot`` bounds it. So no key sends more than
    ``target_rows`` or a share of ``1 / max_hot`` of all rows to a task;
    left rows equal in all columns share a hash and stay together.
    """
    if not rules or len({r.name for r in rules}) < len(rules):
        raise ValueError("rules have to be given, under different names")
    if target_rows < 1 or max_hot < 1:
        raise ValueError("target_rows and max_hot must be positive")
    spark, width = left.sparkSession, max(len(r.left) for r in rules)
    keys = ["rule", *[f"k{i}" for i in range(width)]]
    lk = _rule_keys(left, rules, "left", width, left_id, True)
    rk = _rule_keys(right, rules, "right", width, right_id, False)
    target = max(target_rows, -(-left.count() * len(rules) // max_hot))
    counted = lk.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > target)
    # Counts above the target add up to the total at most: max_hot rows or fewer.
    hot_rows = [(*(r[k] for k in keys), -(-r.n // target)) for r in counted.collect()]
    hot = spark.createDataFrame(hot_rows, ", ".join(f"`h_{k}` string" for k in keys) + ", salts bigint")

    def salted(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"h_{k}")) for k in keys])
        return df.join(F.broadcast(hot), same, "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("bigint")))

    grouped = rk.where(F.col("k0").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_id"))
    partners = salted(grouped).select(*keys, "n", "first_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"))
    rows = salted(lk).select("row_id", *keys, F.pmod("hash", "salts").alias("salt"))
    joined = rows.join(partners, [*keys, "salt"], "left")
    return joined.select(
        F.col("row_id").alias(left_id), "rule", F.coalesce("n", F.lit(0).cast("bigint")).alias("matches"), "first_id"
    )


def _c(name: str) -> KeyFn:
    return lambda df: ref(name)


def registry_rules(
    normalize_number: bool = False,
    coordinate_digits: int | None = None,
    left_street: str = S.ESTABLISHMENT_STREET,
    clean: bool = False,
) -> list[Rule]:
    """The five establishment-to-address rules: coordinates, name, name+street,
    name+street+number, name+postal code. With ``clean``, names and streets
    are compared after ``clean_text`` in upper case: without symbols and
    stray white space, abbreviations expanded."""

    def text(fn: KeyFn) -> KeyFn:
        return (lambda df: clean_text(fn(df), upper=True)) if clean else fn

    def coord(df: DataFrame, name: str) -> Column:
        x = parse_decimal_of(df, name)
        return F.round(x, coordinate_digits) if coordinate_digits is not None else x

    name = (text(_c(S.ESTABLISHMENT_NAME)), text(_c("DSC_ESTABELECIMENTO")))
    street = (
        text(_c(left_street)),
        text(lambda df: compose_key(*[ref(p) for p in S.ADDRESS_STREET_PARTS], as_key=True)),
    )
    number = (
        lambda df: house_number(ref(S.ESTABLISHMENT_NUMBER), normalize_number),
        lambda df: house_number(ref("NUM_ENDERECO"), normalize_number),
    )
    postal = (
        lambda df: postal_code(ref(S.ESTABLISHMENT_POSTAL)),
        lambda df: postal_code(ref("CEP")),
    )
    coords = Rule(
        "coordinates",
        left=[lambda df: coord(df, S.ESTABLISHMENT_LAT), lambda df: coord(df, S.ESTABLISHMENT_LON)],
        right=[lambda df: coord(df, "LATITUDE"), lambda df: coord(df, "LONGITUDE")],
        numeric=(True, True),
    )

    def rule(rname: str, *pairs) -> Rule:
        return Rule(rname, left=[p[0] for p in pairs], right=[p[1] for p in pairs])

    return [
        coords,
        rule("name", name),
        rule("name_street", name, street),
        rule("name_street_number", name, street, number),
        rule("name_postal", name, postal),
    ]


def raw_coordinates_rule() -> Rule:
    """Coordinates as they are written: only text that is a plain number
    already matches (``-20.3``, not ``-20,3``). What cleaning adds shows
    against the ``coordinates`` rule."""

    def number(name: str) -> KeyFn:
        return lambda df: ref(name).try_cast("double")

    return Rule(
        "coordinates_raw",
        left=[number(S.ESTABLISHMENT_LAT), number(S.ESTABLISHMENT_LON)],
        right=[number("LATITUDE"), number("LONGITUDE")],
        numeric=(True, True),
    )


def health_addresses(addresses: DataFrame, species: int = S.HEALTH_SPECIES) -> DataFrame:
    """Address rows of health establishments (pushed down to the scan)."""
    return addresses.where(F.col("COD_ESPECIE") == F.lit(species))


def rule_by_name(rules: Sequence[Rule], name: str) -> Rule:
    for r in rules:
        if r.name == name:
            return r
    raise KeyError(name)

