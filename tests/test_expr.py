import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reglink.functions.expr import (
    compose_key,
    house_number,
    is_undefined,
    parse_decimal,
    parse_decimal_of,
    postal_code,
    string_columns,
)

# Tolerant decimal parse corner cases.
DECIMALS = [
    (" -20,3 ", -20.3),
    ("12,", 12.0),
    ("12.", 12.0),
    ("1e3", 1000.0),
    ("1.234,56", None),
    ("+5", None),
    (".5", None),
    ("NaN", None),
    ("", None),
    (None, None),
    ("12\n", 12.0),
    ("\t7", None),
    ("1e400", float("inf")),
]


def test_parse_decimal_table(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(DECIMALS)], "i int, s string")
    got = dict(rows(df.select("i", parse_decimal("s").alias("x"))))
    for i, (s, want) in enumerate(DECIMALS):
        assert got[i] == want, (s, got[i], want)


def test_parse_decimal_finite_and_bounds(spark):
    df = spark.createDataFrame([("1e400",), ("-95,0",), ("45,5",)], "s string")
    out = rows(df.select(parse_decimal("s", finite_only=True, bounds=(-90, 90)).alias("x")))
    assert out == [(None,), (None,), (45.5,)]


def test_parse_decimal_numeric_input_only_drops_non_finite(spark):
    # A double column is not round-tripped through text.
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "x double")
    out = [r[0] for r in rows(df.select(parse_decimal_of(df, "x").alias("y")))]
    assert out == [1.5, None, None, None]


def test_compose_key_null_and_empty_parts(spark):
    # NULL parts are skipped, empty strings kept, all-NULL is '' (or NULL as a key).
    df = spark.createDataFrame([("A", None, "B"), (None, None, None), ("A", "", "B")], "a string, b string, c string")
    plain = [r[0] for r in rows(df.select(compose_key("a", "b", "c").alias("k")))]
    assert plain == ["A B", "", "A  B"]
    keyed = [r[0] for r in rows(df.select(compose_key("a", "b", "c", as_key=True).alias("k")))]
    assert keyed == ["A B", None, "A  B"]


MARKERS = ["VAGO", "VAGO X", "vago", "SEM DENOMINACAO", "", None, "ok", "RUA SEM DENOMINACAO"]


def test_is_undefined_contains_is_case_sensitive_substring(spark):
    # Substring containment, case-sensitive; D5: two markers only.
    df = spark.createDataFrame([(m,) for m in MARKERS], "s string")
    out = [r[0] for r in rows(df.select(is_undefined("s").alias("u")))]
    assert out == [True, True, False, True, False, None, False, True]


def test_is_undefined_exact_and_blank(spark):
    df = spark.createDataFrame([(m,) for m in MARKERS], "s string")
    out = [r[0] for r in rows(df.select(is_undefined("s", mode="exact", blank_is_undefined=True).alias("u")))]
    assert out == [True, False, False, True, True, None, False, False]


def test_is_undefined_rejects_empty_marker():
    # An empty marker would make every string undefined.
    with pytest.raises(ValueError):
        is_undefined("s", markers=["VAGO", ""])
    with pytest.raises(ValueError):
        is_undefined("s", mode="fuzzy")


def test_postal_code_restores_leading_zeros(spark):
    # D3: an inferred int loses its leading zero; both sides meet after padding.
    df = spark.createDataFrame([(1310100, "01310100"), (29060120, "29060-120"), (None, "abc")], "i int, s string")
    out = rows(df.select(postal_code("i").alias("a"), postal_code("s").alias("b")))
    assert out == [("01310100", "01310100"), ("29060120", "29060120"), (None, None)]


def test_house_number_parity_and_normalized(spark):
    # Parity compares text; normalisation drops leading zeros.
    df = spark.createDataFrame([("0123",), ("S/N",), (" 7 ",), ("0",)], "s string")
    assert [r[0] for r in rows(df.select(house_number("s").alias("n")))] == ["0123", "S/N", " 7 ", "0"]
    assert [r[0] for r in rows(df.select(house_number("s", normalize=True).alias("n")))] == ["123", "S/N", "7", "0"]


def test_string_columns_from_schema(spark):
    df = spark.createDataFrame([], "a int, b string, c double, d string")
    assert string_columns(df) == ["b", "d"]


def test_nan_and_negative_zero_join_keys(spark):
    # NaN = NaN and -0.0 = 0.0 in equi-joins; NULL never matches.
    left = spark.createDataFrame([(float("nan"),), (-0.0,), (None,)], "x double")
    right = spark.createDataFrame([(float("nan"),), (0.0,), (None,)], "x double")
    assert left.join(right, "x").count() == 2
    assert math.isnan(left.join(right, "x").where(F.isnan("x")).first()[0])
