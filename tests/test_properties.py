"""Property checks on random inputs (few examples: each runs Spark jobs)."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskspark.operators import features as fe
from riskspark.operators.quantiles import exact_quantiles

ROWS = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 400), st.one_of(st.none(), st.integers(0, 50).map(float))),
    min_size=1, max_size=60,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, window=st.integers(1, 120), ranges=st.integers(1, 5))
def test_velocity_equals_brute_force(spark, rows, window, ranges):
    data = [(i, c, t, a) for i, (c, t, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, card long, t long, amount double")
    out = fe.add_velocity_features(df, windows_seconds={"w": window}, ranges=ranges)
    got = {r["id"]: (r["card_txn_count_w"], r["card_amt_sum_w"]) for r in out.collect()}
    for i, c, t, _ in data:
        win = [a for j, cc, tt, a in data if cc == c and t - window < tt and (tt < t or (tt == t and j <= i))]
        vals = [a for a in win if a is not None]
        cnt, s = got[i]
        assert cnt == len(vals)
        assert (s is None) if not vals else math.isclose(s, sum(vals))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.integers(-20, 20).map(float), min_size=1, max_size=80), buckets=st.integers(1, 6))
def test_exact_quantiles_equal_numpy(spark, vals, buckets):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.0, 0.2, 0.5, 0.75, 1.0]
    got = {r["q"]: r["quantile"] for r in exact_quantiles(df, "x", qs, buckets=buckets).collect()}
    for q in qs:
        assert math.isclose(got[q], float(np.quantile(vals, q)), abs_tol=1e-9)


SCORED = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda v: v / 6)), min_size=2, max_size=60).filter(
    lambda r: 0 < sum(y for y, _ in r) < len(r)
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=SCORED, buckets=st.integers(1, 4))
def test_metrics_equal_brute_force(spark, rows, buckets):
    from riskspark.operators import metrics as mt

    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    df = spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(rows)], "id long, y int, score double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert math.isclose(mt.auc_roc(df).first()[0], auc, abs_tol=1e-12)
    # KS walking rows by score desc, ties in id order (stable)
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][1], i))
    cp = cn = 0
    best = (-1.0, None)
    for i in order:
        cp += rows[i][0]
        cn += 1 - rows[i][0]
        gap = abs(cp / len(pos) - cn / len(neg))
        if gap > best[0]:
            best = (gap, rows[i][1])
    k = mt.ks_statistic(df).first()
    assert math.isclose(k["ks_statistic"], best[0], abs_tol=1e-12) and k["ks_threshold"] == best[1]
    # average precision, step rule over distinct thresholds
    ap = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        pp = sum(1 for y, s in rows if s >= t)
        ap += sum(1 for y, s in rows if s == t and y == 1) / len(pos) * (tp / pp)
    assert math.isclose(mt.average_precision(df).first()[0], ap, abs_tol=1e-12)
