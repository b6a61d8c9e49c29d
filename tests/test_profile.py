import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_text, rows
from reglink.operators import profile as P
from reglink.plans import fixtures as X

DATA = [
    (1, "VAGO", None, 1.0),
    (2, "RUA SEM DENOMINACAO", "x", None),
    (3, "", "y", 2.0),
    (4, "RUA A", None, 3.0),
]
SCHEMA = "id int, street string, name string, v double"


def _df(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_fill_profile(spark):
    got = dict(rows(P.fill_profile(_df(spark))))
    assert got == {"id": 100.0, "street": 100.0, "name": 50.0, "v": 75.0}


def test_fill_profile_is_one_scan(spark):
    plan = plan_text(P.fill_profile(_df(spark)))
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1


def test_empty_input_gives_null_rates(spark):
    # Zero rows give NULL, not a division error.
    empty = spark.createDataFrame([], SCHEMA)
    assert {r[1] for r in rows(P.fill_profile(empty))} == {None}
    assert {(r[1], r[2], r[3]) for r in rows(P.fill_comparison(empty))} == {(None, None, None)}


def test_strict_fill_and_comparison(spark):
    df = _df(spark)
    strict = dict(rows(P.strict_fill_profile(df)))
    assert strict["street"] == 50.0  # VAGO and the SEM DENOMINACAO street are undefined
    assert strict["name"] == 50.0 and strict["id"] == 100.0
    cmp = {r[0]: r[1:] for r in rows(P.fill_comparison(df))}
    for basic, stricter, diff in cmp.values():
        assert stricter <= basic  # property: strict never above basic
        assert diff == round(stricter - basic, 4)
    assert cmp["street"] == (100.0, 50.0, -50.0)
    losses = rows(P.fill_losses(P.fill_comparison(df)))
    assert losses == [("street", -50.0)]


def test_blank_option_counts_empty_strings(spark):
    strict = dict(rows(P.strict_fill_profile(_df(spark), blank_is_undefined=True)))
    assert strict["street"] == 25.0


def test_empty_profile_counts_real_empty_strings(spark):
    got = dict(rows(P.empty_profile(_df(spark))))
    assert got == {"street": 1, "name": 0}


def test_value_frequencies_tie_break_and_k(spark):
    # Ties ordered by value ascending.
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    got = rows(P.value_frequencies(df, k=2).orderBy("rank"))
    assert got == [("s", "a", 2, 1), ("s", "b", 2, 2)]


def test_value_frequencies_mixed_types_one_job(spark):
    out = P.value_frequencies(_df(spark), k=1)
    got = {r[0]: r[1:] for r in rows(out)}
    assert set(got) == {"id", "street", "name", "v"}
    plan = plan_text(out)
    assert "WindowGroupLimit" in plan  # per-task top-k before the per-column exchange


def test_value_frequencies_reports_near_unique_columns(spark):
    assert {r[0] for r in rows(P.value_frequencies(_df(spark)))} == {"id", "street", "name", "v"}


def test_distinct_values_counts_null_as_value(spark):
    got = rows(P.distinct_values(_df(spark), ["name"]).orderBy(F.col("value").asc_nulls_first()))
    assert got == [("name", None, 3), ("name", "x", 3), ("name", "y", 3)]


def test_distinct_count_exact_and_approx(spark):
    df = _df(spark)
    assert rows(P.distinct_count(df, ["name"])) == [(2,)]
    assert rows(P.distinct_count(df, ["name", "v"])) == [(1,)]  # tuples with a NULL are skipped
    assert rows(P.distinct_count(df, ["name"], approx=True)) == [(2,)]


def test_duplicate_groups_null_group_and_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, None), (None, None), ("b", 2)], "name string, cep int")
    got = rows(P.duplicate_groups(df, ["name", "cep"], k=2))
    assert got == [(None, None, 2), ("a", 1, 2)]
    with pytest.raises(ValueError):
        P.duplicate_groups(df.withColumnRenamed("cep", "n"), ["name", "n"])


def test_malformed_split_and_summary(spark):
    df = spark.createDataFrame(
        [("-20,3", "-40,1"), ("S/N", "-40,1"), ("S/N", "-40,1"), ("1,0", None), ("5", "6")], "lat string, lon string"
    )
    split = P.split_malformed(df, "lat", "lon")
    assert split.valid.count() == 2 and split.malformed.count() == 3
    assert split.malformed_values.count() == 2
    assert rows(P.malformed_summary(df, "lat", "lon")) == [(5, 2, 3, 2)]


def test_profiles_on_driver_table(spark):
    part = X.profiled_part(X.table(spark, SMALL, "part"))
    basic = dict(rows(P.fill_profile(part)))
    strict = dict(rows(P.strict_fill_profile(part)))
    assert all(strict[c] <= basic[c] for c in basic)
    assert basic["p_partkey"] == 100.0 and basic["p_name"] < 100.0


def test_sample_is_reproducible_with_seed(spark):
    line = X.table(spark, SMALL, "lineitem")
    a = sorted(rows(P.sample_rows(line, 0.1, seed=3), "l_orderkey", "l_linenumber"))
    b = sorted(rows(P.sample_rows(line, 0.1, seed=3), "l_orderkey", "l_linenumber"))
    assert a == b and 0 < len(a) < line.count()
    with pytest.raises(ValueError):
        P.sample_rows(line, 1.5)


def test_value_frequencies_typed_matches_text_semantics(spark):
    # -0.0 and 0.0 are different texts; NaN is one value; maps fall back to text.
    df = spark.createDataFrame(
        [(0.0, 1, {"a": 1}), (-0.0, 1, {"a": 1}), (-0.0, 2, None), (float("nan"), None, None), (float("nan"), 3, None)],
        "x double, n int, m map<string,int>",
    )
    got = {(r[0], r[1]): r[2] for r in rows(P.value_frequencies(df, k=10))}
    assert got[("x", "-0.0")] == 2 and got[("x", "0.0")] == 1 and got[("x", "NaN")] == 2
    assert got[("n", "1")] == 2 and ("n", None) not in got
    assert got[("m", "{a -> 1}")] == 2


def test_approx_distinct_count_of_pairs(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), ("b", None)], "s string, n int")
    assert rows(P.distinct_count(df, ["s", "n"], approx=True)) == [(2,)]  # tuples with a NULL skipped


def test_split_written_once(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "-20,3", "-40,1", "a"), (2, "S/N", "-40,1", "b"), (3, "S/N", "-40,1", "c"), (4, None, "x", "d"), (5, "1", "2", "e")],
        "id int, lat string, lon string, verdict string",
    )
    out = P.write_split(df, "lat", "lon", str(tmp_path / "split"))
    plain = P.split_malformed(df, "lat", "lon")
    for a, b in zip(out, plain, strict=True):
        assert a.columns == b.columns and sorted(rows(a), key=str) == sorted(rows(b), key=str)
    assert "PartitionFilters: [isnotnull(verdict_" in plan_text(out.malformed_values)
    valid = P.write_split(df.where("id in (1, 5)"), "lat", "lon", str(tmp_path / "one"))
    assert valid.valid.count() == 2 and valid.malformed.count() == 0 and valid.malformed_values.count() == 0


def test_sketches_merge_to_the_sketch_of_all(spark):
    df = spark.range(30_000).selectExpr("concat('v', id % 9000) as a", "if(id % 2 = 0, id, null) as b", "cast(null as string) as c", "id % 3 as state", "id % 7 as month")
    fine = P.distinct_sketch(df, ["a", "b", "c"], ["state", "month"])
    merged = {(r.state, r.column_name): (r.n_rows, r.n_distinct) for r in P.sketch_estimate(P.merge_sketches(fine, ["state"])).collect()}
    direct = {(r.state, r.column_name): (r.n_rows, r.n_distinct) for r in P.sketch_estimate(P.distinct_sketch(df, ["a", "b", "c"], ["state"])).collect()}
    assert {k: v[0] for k, v in merged.items()} == {k: v[0] for k, v in direct.items()}
    for state in range(3):
        assert abs(merged[state, "a"][1] - 3000) <= 90 and abs(merged[state, "b"][1] - 5000) <= 150 and merged[state, "c"][1] == 0
    # A month that arrives later is added without the old rows.
    new = P.distinct_sketch(spark.range(30_000).selectExpr("concat('w', id) as a", "id as b", "cast(null as string) as c"), ["a", "b", "c"])
    total = {r.column_name: r.n_distinct for r in P.sketch_estimate(P.merge_sketches(fine.select("column_name", "n_rows", "sketch").unionByName(new))).collect()}
    assert abs(total["a"] - 39_000) <= 1200
    assert P.sketch_estimate(P.merge_sketches(P.distinct_sketch(df.where("state > 9"), ["a"], ["state"]), ["state"])).count() == 0
    with pytest.raises(ValueError):
        P.distinct_sketch(df, [])


def test_preview_and_schema_listing(spark):
    df = spark.createDataFrame([(2, "b"), (None, "c"), (1, "z"), (1, "a"), (3, "d")], "k int, v string")
    assert rows(P.preview(df, ["k"], 3)) == [(None, "c"), (1, "a"), (1, "z")]
    assert P.preview(df.where("k > 9"), ["k"]).count() == 0
    assert rows(P.schema_listing(df)) == [(0, "k", "int", True), (1, "v", "string", True)]
