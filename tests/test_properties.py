"""Property tests: operators against plain-Python models on random inputs.

Each example is one small Spark job over a whole generated table, so the
example counts stay low; the generators favour repeated keys, NULLs and ties.
"""

import math
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from reglink.functions.expr import DECIMAL_REGEX, parse_decimal
from reglink.operators import link as L
from reglink.operators import profile as P
from reglink.operators.profile import ref

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D"]))


@SETTINGS
@given(left=st.lists(keys, max_size=25), right=st.lists(keys, max_size=25))
def test_report_equals_nested_loop(spark, left, right):
    lf = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "id int, n string")
    rf = spark.createDataFrame([(i, k) for i, k in enumerate(right)], "rid int, m string")
    rule = L.Rule("name", left=[lambda df: ref("n")], right=[lambda df: ref("m")])
    r = L.match_report(lf, rf, [rule]).first()
    pairs = [(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if a is not None and a == b]
    assert r["left_total"] == len(left) and r["right_total"] == len(right)
    assert r["pairs"] == len(pairs)
    assert r["matched_left"] == len({i for i, _ in pairs})
    assert r["matched_right"] == len({j for _, j in pairs})
    assert r["matched_left"] <= r["left_total"]


def _model_decimal(s):
    # The D15 rules: spaces trimmed, comma to dot, a trailing dot gets a zero,
    # then a plain or scientific decimal (Java and Python agree on this regex).
    if s is None:
        return None
    t = s.strip(" ").replace(",", ".")
    t = re.sub(r"\.$", ".0", t)
    if not re.search(DECIMAL_REGEX, t):
        return None
    return float(t)


decimal_text = st.text(alphabet="0123456789,.-eE+ \t\n", max_size=8)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), decimal_text), min_size=1, max_size=40))
def test_parse_decimal_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = dict(rows(df.select("i", parse_decimal("s").alias("x"))))
    for i, v in enumerate(values):
        want = _model_decimal(v)
        assert (got[i] is None and want is None) or (
            got[i] is not None and want is not None and (got[i] == want or math.isinf(got[i]) and math.isinf(want))
        ), (v, got[i], want)


@SETTINGS
@given(
    a=st.lists(st.one_of(st.none(), st.sampled_from(["x", "y", "z", "w"])), min_size=1, max_size=30),
    k=st.integers(min_value=1, max_value=3),
)
def test_value_frequencies_match_counter(spark, a, k):
    df = spark.createDataFrame([(v, (i % 3)) for i, v in enumerate(a)], "s string, n int")
    got = sorted(rows(P.value_frequencies(df, k=k)))
    want = []
    for name, values in (("s", a), ("n", [i % 3 for i in range(len(a))])):
        counts = Counter(str(v) for v in values if v is not None)
        ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        want += [(name, v, c, r + 1) for r, (v, c) in enumerate(ranked)]
    assert got == sorted(want)
