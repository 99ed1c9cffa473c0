"""The as-of join of two tables against a loop over all rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlens.operators.asof import asof_join

LEFT, RIGHT = "k string, t int, id int", "k string, t int, v string, w int"


def slow(left, right, strict=False, tolerance=None):
    out = []
    for k, t, i in left:
        seen = [r for r in right if None not in (k, t, r[0], r[1]) and r[0] == k and (r[1] < t if strict else r[1] <= t)]
        best = max(seen, key=lambda r: (r[1], (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or 0)), default=None)
        if best and tolerance is not None and t - best[1] > tolerance:
            best = None
        out.append((k, t, i, *(best[1:] if best else (None, None, None))))
    return sorted(out, key=str)


def fast(spark, left, right, **how):
    out = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", prefix="r_", **how)
    assert out.columns == ["k", "t", "id", "r_t", "r_v", "r_w"]
    return sorted((tuple(r) for r in out.collect()), key=str)


ROWS = ([("a", 1, 1), ("a", 5, 2), ("a", 5, 3), ("a", 9, 4), ("b", 0, 5), ("c", 3, 6), (None, 5, 7), ("a", None, 8), ("a", 5, 2)],
        [("a", 5, "x", 1), ("a", 5, "y", None), ("a", 5, None, 9), ("a", 2, "p", 0), ("b", 1, "q", 0), (None, 1, "n", 0), ("a", None, "m", 0), ("d", 1, "z", 0), ("a", 5, "y", None)])


@pytest.mark.parametrize("how", [{}, {"strict": True}, {"tolerance": 0}, {"tolerance": 3}, {"strict": True, "tolerance": 3}])
@pytest.mark.parametrize("limit", [None, 2])
def test_cases(spark, how, limit):
    assert fast(spark, *ROWS, limit=limit, **how) == slow(*ROWS, **how)


KEYS, TIMES = st.sampled_from(["a", "a", "a", "b", None]), st.one_of(st.none(), st.integers(0, 6))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(KEYS, TIMES, st.integers(0, 3)), max_size=15), st.lists(st.tuples(KEYS, TIMES, st.sampled_from(["x", "y", None]), st.integers(0, 2)), max_size=15), st.booleans(), st.sampled_from([None, 1]), st.sampled_from([None, 3]))
def test_any_rows(spark, left, right, strict, tolerance, limit):
    assert fast(spark, left, right, strict=strict, tolerance=tolerance, limit=limit) == slow(left, right, strict, tolerance)


def test_times_and_several_keys(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([(1, "s", at(10)), (1, "s", at(11.000001)), (2, "s", at(10))], "u int, s string, t timestamp")
    right = spark.createDataFrame([(1, "s", at(1), 0.5), (2, "x", at(1), 0.7)], "u int, s string, made timestamp, p double")
    got = asof_join(left, right, ["u", "s"], "t", "made", tolerance=10)
    assert sorted((r.u, r.t, r.p) for r in got.collect()) == [(1, at(10), 0.5), (1, at(11.000001), None), (2, at(10), None)]


def test_clashing_names_and_one_exchange_a_side(spark):
    left, right = spark.createDataFrame(ROWS[0], LEFT), spark.createDataFrame(ROWS[1], RIGHT)
    with pytest.raises(ValueError, match="'t'"):
        asof_join(left, right, ["k"], "t")
    plan = asof_join(left, right, ["k"], "t", prefix="r_")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
