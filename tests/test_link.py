import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_text, rows
from reglink.operators import link as L
from reglink.operators.profile import ref
from reglink.plans import catalog
from reglink.plans import fixtures as X


def _names(spark):
    left = spark.createDataFrame([(1, "A"), (2, "A"), (3, None)], "id int, n string")
    right = spark.createDataFrame([(10, "A"), (11, "A"), (12, None), (13, "B")], "rid int, m string")
    return left, right


def test_pairs_and_matched_records(spark):
    # 4 pairs (over 100% of left rows), 2 of 3 left rows matched; NULL never matches.
    left, right = _names(spark)
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])
    r = L.match_report(left, right, [rule]).first().asDict()
    assert (r["left_total"], r["right_total"], r["pairs"], r["matched_left"], r["matched_right"]) == (3, 4, 4, 2, 2)
    assert abs(r["pair_coverage_pct"] - 400 / 3) < 1e-9
    assert abs(r["record_coverage_pct"] - 200 / 3) < 1e-9


def test_report_on_empty_input_keeps_rules(spark):
    left = spark.createDataFrame([], "id int, n string")
    right = spark.createDataFrame([], "rid int, m string")
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])
    r = L.match_report(left, right, [rule]).first().asDict()
    assert r["pairs"] == 0 and r["pair_coverage_pct"] is None


def test_link_one_row_per_left_row(spark):
    left, right = _names(spark)
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])
    got = sorted(rows(L.link(left, right, rule, right_id="rid")))
    assert got == [(1, "A", 2, 10), (2, "A", 2, 10), (3, None, 0, None)]


def test_report_equals_brute_force_joins(spark):
    est, adr = catalog.registries(spark, SMALL)
    report = {r["rule"]: r for r in L.match_report(est, adr, L.registry_rules()).collect()}
    lk = est.select(
        "CO_UNIDADE",
        F.col("NO_FANTASIA").alias("name"),
        F.col("NO_LOGRADOURO").alias("street"),
        F.col("NU_ENDERECO").alias("num"),
    )
    rk = adr.select(
        F.col("DSC_ESTABELECIMENTO").alias("name"),
        F.nullif(F.concat_ws(" ", "NOM_TIPO_SEGLOGR", "NOM_TITULO_SEGLOGR", "NOM_SEGLOGR"), F.lit("")).alias("street"),
        F.col("NUM_ENDERECO").cast("string").alias("num"),
    )
    for rule, keys in {"name": ["name"], "name_street": ["name", "street"],
                       "name_street_number": ["name", "street", "num"]}.items():
        joined = lk.join(rk, keys)
        assert report[rule]["pairs"] == joined.count(), rule
        assert report[rule]["matched_left"] == joined.select("CO_UNIDADE").distinct().count(), rule
    # Properties: more key parts never add pairs; matched never above the total.
    assert report["name_street_number"]["pairs"] <= report["name_street"]["pairs"] <= report["name"]["pairs"]
    assert all(r["matched_left"] <= r["left_total"] for r in report.values())


def test_report_does_not_join_pairs(spark):
    est, adr = catalog.registries(spark, SMALL)
    plan = plan_text(L.match_report(est, adr, L.registry_rules()))
    # Both sides are aggregated per key before the one join of key counts.
    assert plan.count("Aggregate") >= 3


def test_coordinates_rule_parses_comma_decimals(spark):
    left = spark.createDataFrame([("-20,3", "-40,"), ("x", "1")], "NU_LATITUDE string, NU_LONGITUDE string")
    right = spark.createDataFrame([(-20.3, -40.0), (-0.0, 1.0)], "LATITUDE double, LONGITUDE double")
    rule = L.rule_by_name(L.registry_rules(), "coordinates")
    r = L.match_report(left, right, [rule]).first()
    assert (r["pairs"], r["matched_left"]) == (1, 1)


def test_health_filter_pushed_to_scan(spark, tmp_path):
    part = X.table(spark, SMALL, "part")
    path = str(tmp_path / "adr")
    X.addresses(part).write.parquet(path)
    plan = plan_text(L.health_addresses(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(COD_ESPECIE), EqualTo(COD_ESPECIE,5)]" in plan


def test_link_salts_a_hot_left_key(spark):
    # One name holds a third of the left rows: same result salted or not.
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("n")
    )
    right = spark.range(200).select(
        F.col("id").alias("rid"), F.when(F.col("id") < 5, F.lit("HOT")).otherwise(F.concat(F.lit("n"), F.col("id") % 60)).alias("m")
    )
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])
    salted = L.link(left, right, rule, right_id="rid", hot_fraction=0.1, salt_buckets=8)
    plain = L.link(left, right, rule, right_id="rid", hot_fraction=None)
    assert salted.count() == 3000
    assert sorted(rows(salted)) == sorted(rows(plain))
    assert rows(salted.where(F.col("n") == "HOT").select(F.min("r_matches"), F.max("r_first_id"))) == [(5, 0)]
    hot = rows(L.hot_keys(left.select(F.col("n").alias("k")), ["k"], 0.1))
    assert hot == [("HOT", True)]
    plan = plan_text(salted)
    assert "xxhash64" in plan


def test_link_salt_ignores_map_columns(spark):
    left = spark.range(30).select(F.lit("HOT").alias("n"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    right = spark.createDataFrame([(1, "HOT")], "rid int, m2 string")
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m2")])
    out = L.link(left, right, rule, right_id="rid", hot_fraction=0.5, salt_buckets=4)
    assert rows(out.groupBy("r_matches").count()) == [(1, 30)]


def test_salting_spreads_a_hot_key_over_join_tasks(spark):
    # A third of the left rows share one name. With broadcasts and partition
    # coalescing off, the join must shuffle: unsalted, one task gets the whole
    # hot key; salted, no task gets more than a small share.
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    saved = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        left = spark.range(30_000).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("n"), (F.col("id") % 997).cast("string"))).alias("n"),
        )
        right = spark.range(2000).select(
            F.col("id").alias("rid"), F.concat(F.lit("n"), (F.col("id") % 997).cast("string")).alias("m")
        ).union(spark.range(3).select(F.col("id").alias("rid"), F.lit("HOT").alias("m")))
        rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])

        def largest_share(df):
            # r_matches is used so the optimizer keeps the join (with unique
            # right keys and no right column read, it would drop it).
            per_task = df.select(F.spark_partition_id().alias("p"), "r_matches").groupBy("p").agg(
                F.count(F.lit(1)).alias("n"), F.sum("r_matches").alias("m")
            )
            sizes = [r["n"] for r in per_task.collect()]
            return max(sizes) / sum(sizes)

        plain = L.link(left, right, rule, right_id="rid", hot_fraction=None)
        salted = L.link(left, right, rule, right_id="rid", hot_fraction=0.01, salt_buckets=16)
        assert largest_share(plain) >= 1 / 3
        assert largest_share(salted) < 0.15
        assert sorted(rows(salted)) == sorted(rows(plain))
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_numeric_keys_follow_join_semantics(spark):
    # D17 at the operator level: NaN meets NaN, -0.0 meets 0.0, NULL meets nothing.
    left = spark.createDataFrame([(1, float("nan")), (2, -0.0), (3, None), (4, 1.5)], "id int, x double")
    right = spark.createDataFrame([(10, float("nan")), (11, 0.0), (12, None), (13, 2.5)], "rid int, y double")
    rule = L.Rule("num", left=[lambda df: ref("x")], right=[lambda df: ref("y")], numeric=(True,))
    r = L.match_report(left, right, [rule]).first()
    assert (r["pairs"], r["matched_left"], r["matched_right"]) == (2, 2, 2)
    linked = dict(rows(L.link(left, right, rule, right_id="rid").select("id", "r_first_id")))
    assert linked == {1: 10, 2: 11, 3: None, 4: None}


def test_report_join_reuses_the_key_count_partitioning(spark):
    # Three hash exchanges: left key counts, right key counts, per-rule totals.
    # The join of key counts must reuse their partitioning (double join keys
    # would be re-wrapped for NaN/-0.0 normalisation and shuffled again).
    est, adr = catalog.registries(spark, SMALL)
    plan = plan_text(L.match_report(est, adr, L.registry_rules()))
    assert plan.count("Exchange hashpartitioning") == 3


def test_null_keys_are_spread_over_join_tasks(spark):
    """A third of the left keys NULL: they match nothing, and no task gets
    them all."""
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, null, concat('k', id)) AS name", "id AS payload")
    right = spark.range(500).selectExpr("id AS rid", "concat('k', id * 4) AS name")
    rule = L.Rule("n", left=[lambda df: F.col("name")], right=[lambda df: F.col("name")])
    out = L.link(left, right, rule, "rid", salt_buckets=16)
    assert out.where("name IS NULL AND r_matches > 0").count() == 0
    assert out.count() == 3000


# --- all rules in one pass ------------------------------------------------------


def _hot_registries(spark, tmp_path, n=12_000):
    """A third of the left rows under one name, a third without a name."""
    name = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("N"), (F.col("id") % 500).cast("string")))
    left = spark.range(n).select(F.col("id").alias("a"), name.alias("name"), (F.col("id") % 7).cast("string").alias("street"), F.lit("x").alias("rule"), F.lit(1).alias("salt"))
    right = spark.range(900).select(F.col("id").alias("b"), F.when(F.col("id") < 20, "HOT").when(F.col("id") < 800, F.concat(F.lit("N"), F.col("id").cast("string"))).alias("name"), (F.col("id") % 7).cast("string").alias("street"))
    for df, at in ((left, "left"), (right, "right")):
        df.write.parquet(str(tmp_path / at))
    return spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right"))


def _named(*columns):
    return [lambda df, c=c: df[c] for c in columns]


RULES = [L.Rule("name", _named("name"), _named("name")), L.Rule("name_street", _named("name", "street"), _named("name", "street")), L.Rule("street", _named("street"), _named("street"))]


def test_all_rules_in_one_pass_match_one_by_one(spark, tmp_path):
    left, right = _hot_registries(spark, tmp_path)
    for target in (50, 1_000_000):
        out = L.link_all(left, right, RULES, "a", "b", target_rows=target)
        assert out.columns == ["a", "rule", "matches", "first_id"] and out.count() == 3 * 12_000
        for rule in RULES:
            one = L.link(left, right, rule, right_id="b").select("a", "r_matches", "r_first_id")
            assert sorted(rows(out.where(F.col("rule") == rule.name), "a", "matches", "first_id"), key=str) == sorted(rows(one), key=str)


def test_all_rules_read_the_left_side_twice(spark, tmp_path):
    left, right = _hot_registries(spark, tmp_path)
    out = L.link_all(left, right, RULES, "a", "b", target_rows=50)
    # The keys were counted by the call itself: that is the other time.
    plan = plan_text(out)
    assert plan.count(f"{tmp_path}/left") == 1 and plan.count(f"{tmp_path}/right") == 1
    assert plan.count("Join") - plan.count("BroadcastHashJoin") <= 1


def test_hot_and_null_keys_are_dealt_to_many_tasks(spark, tmp_path):
    left, right = _hot_registries(spark, tmp_path)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = L.link_all(left, right, RULES[:2], "a", "b", target_rows=100)
        # A column of the right side keeps the optimizer from dropping the join.
        sizes = [n for _, n in rows(out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.coalesce("first_id", "matches"))))]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 24_000 and max(sizes) <= 0.15 * sum(sizes)


def test_all_rules_on_empty_sides_and_bad_input(spark, tmp_path):
    left, right = _hot_registries(spark, tmp_path, 30)
    assert L.link_all(left.where("a < 0"), right, RULES, "a", "b").count() == 0
    alone = L.link_all(left, right.where("b < 0"), RULES, "a", "b", target_rows=1)
    assert set(rows(alone, "matches", "first_id")) == {(0, None)} and alone.count() == 90
    for bad in ({"rules": []}, {"rules": [RULES[0], RULES[0]]}, {"rules": RULES, "target_rows": 0}, {"rules": RULES, "max_hot": 0}):
        with pytest.raises(ValueError):
            L.link_all(left, right, left_id="a", right_id="b", **bad)
    # Fewer keys than asked are broadcast when the list is bounded tightly.
    bounded = L.link_all(left, right, RULES, "a", "b", target_rows=1, max_hot=1)
    assert sorted(rows(bounded), key=str) == sorted(rows(L.link_all(left, right, RULES, "a", "b")), key=str)


def test_raw_coordinates_match_plain_numbers_only(spark):
    left = spark.createDataFrame([(1, "-20.3", "-40.1"), (2, "-20,3", "-40,1"), (3, "S/N", "-40.1"), (4, None, None)], "CO_UNIDADE int, NU_LATITUDE string, NU_LONGITUDE string")
    right = spark.createDataFrame([(9, -20.3, -40.1), (8, None, None)], "b int, LATITUDE double, LONGITUDE double")
    found = L.match_report(left, right, [L.raw_coordinates_rule(), L.rule_by_name(L.registry_rules(), "coordinates")])
    assert dict(rows(found, "rule", "matched_left")) == {"coordinates_raw": 1, "coordinates": 2}


def test_salts_follow_the_measured_count(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 600, "A").when(F.col("id") < 700, "B").otherwise(F.col("id").cast("string")).alias("n"))
    assert sorted(rows(L._hot_salts(left, ["n"], 0.05))) == [("A", True, 12), ("B", True, 2)]
    right = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "rid int, m string")
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])
    by_count, plain = L.link(left, right, rule, "rid", hot_fraction=0.05), L.link(left, right, rule, "rid", hot_fraction=None)
    assert sorted(rows(by_count)) == sorted(rows(plain))
