"""Property tests: operators against small plain-Python models."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions import columns as C
from strata.operators import quality as Q
from strata.operators.tables import dedup_by_key

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))

ids = st.one_of(st.none(), st.from_regex(r"[Oo]?0{0,4}[0-9]{0,4}(-I[0-9])?", fullmatch=True))
money_text = st.decimals(min_value=Decimal("-999999999.999"), max_value=Decimal("999999999.999"),
                         places=3, allow_nan=False, allow_infinity=False).map(str)


@SETTINGS
@given(st.lists(ids, min_size=1, max_size=20))
def test_strip_prefix_matches_python_regex(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(C.strip_prefix("v", "O")).collect()]
    assert got == [None if v is None else re.sub(r"^O0*", "", v) for v in values]


@SETTINGS
@given(st.lists(money_text, min_size=1, max_size=20))
def test_money_is_half_up_and_bounded(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(C.to_money("v")).collect()]
    want = []
    for v in values:
        q = Decimal(v).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        want.append(q if abs(q) < Decimal("100000000") else None)
    assert got == want


rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.text("xyz", max_size=2))),
                min_size=1, max_size=30)


def _least(group):
    # Spark orders NULL first within a struct; compare field by field
    return min(group, key=lambda r: tuple((v is not None, v if v is not None else 0 if isinstance(v, int) else "")
                                          for v in r[1:]))


@SETTINGS
@given(rows, st.integers(1, 4))
def test_dedup_keeps_least_row_per_key(spark, data, parts):
    df = spark.createDataFrame(data, "k string, n int, s string").repartition(parts)
    got = sorted(map(tuple, dedup_by_key(df, ["k"]).collect()), key=repr)
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    want = sorted((_least(g) for g in groups.values()), key=repr)
    assert got == want


@SETTINGS
@given(rows)
def test_counters_and_uniqueness_match_python(spark, data):
    df = spark.createDataFrame(data, "k string, n int, s string")
    suite = [("t", Q.not_empty()), ("t", Q.unique("k"))] + [("t", r) for r in Q.not_null("n", "s")]
    suite += [("t", Q.in_range("n", -1, 1)), ("t", Q.non_negative("n")), ("t", Q.in_set("s", ["x", "y"]))]
    got = {r.check: r.violations for r in Q.QualityReport("x", Q.check_tables(spark, {"t": df}, suite, "x")).rows()}
    n = [r[1] for r in data]
    s = [r[2] for r in data]
    assert got["unique(k)"] == len(data) - len({r[0] for r in data})
    assert got["not_null(n)"] == sum(v is None for v in n)
    assert got["not_null(s)"] == sum(v is None for v in s)
    assert got["range(n, -1..1)"] == sum(v is not None and not -1 <= v <= 1 for v in n)
    assert got["non_negative(n)"] == sum(v is not None and v < 0 for v in n)
    assert got["in_set(s)"] == sum(v is not None and v not in ("x", "y") for v in s)
