import math

import pytest
from pyspark.sql import functions as F

from riskspark.functions.columns import iv_strength, psi_verdict, right_closed_bin
from riskspark.operators import metrics as mt
from riskspark.operators import merge as mg
from riskspark.operators import profile as pr
from riskspark.operators import split as sp


def scored(spark, ys, ps):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(zip(ys, ps))], "id long, y int, score double")


LABELS = [int((i * 7 + 3) % 11 < 4) for i in range(33)]
SCORES = [((i * 13) % 17) / 17 for i in range(33)]  # with ties


def test_ks_auc_gini_equal_their_definitions(spark):
    df = scored(spark, LABELS, SCORES)
    ones, zeros = ([s for s, y in zip(SCORES, LABELS) if y == v] for v in (1, 0))
    pairs = [(a > b) + (a == b) / 2 for a in ones for b in zeros]
    auc = sum(pairs) / len(pairs)
    assert math.isclose(mt.auc_roc(df).first()[0], auc) and math.isclose(mt.gini(df).first()[0], 2 * auc - 1)
    gap = {c: abs(sum(s >= c for s in ones) / len(ones) - sum(s >= c for s in zeros) / len(zeros)) for c in SCORES}
    k = mt.ks_statistic(df).first()
    assert math.isclose(k["ks_statistic"], max(gap.values())) and math.isclose(gap[k["ks_threshold"]], max(gap.values()))
    flat = scored(spark, LABELS, [0.3] * len(LABELS))
    assert math.isclose(mt.gini(flat).first()[0], 0.0, abs_tol=1e-12)


def test_f1_threshold_and_average_precision(spark):
    df = scored(spark, LABELS, SCORES)
    points = {}
    for c in sorted(set(SCORES)):
        hit, taken = sum(y for s, y in zip(SCORES, LABELS) if s >= c), sum(s >= c for s in SCORES)
        points[c] = (hit / taken, hit / sum(LABELS))
    f1 = {c: 2 * p * r / (p + r) if p + r else 0.0 for c, (p, r) in points.items()}
    got = mt.f1_threshold(df).first()
    assert math.isclose(got["f1"], max(f1.values())) and math.isclose(f1[got["threshold"]], max(f1.values()))
    steps = [(r, p) for c, (p, r) in sorted(points.items(), reverse=True)]
    ap = sum((r - r0) * p for (r0, _), (r, p) in zip([(0, 0), *steps], steps))
    assert math.isclose(mt.average_precision(df).first()[0], ap)


def test_metrics_validate_binary(spark):
    with pytest.raises(ValueError):
        mt.auc_roc(scored(spark, [1, 1], [0.2, 0.3]))


def test_label_rate_missing_time_patterns(spark):
    rows = [(i, 500 + i * 9_000, int(i % 4 == 1), "v" if i % 3 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, t long, label int, b string")
    r = pr.label_rate(df).first()
    assert (r["n_total"], r["n_positive"], r["n_negative"], r["rate"]) == (40, 10, 30, 0.25)
    miss = {x["column"]: x["missing_rate"] for x in pr.missing_rates(df).collect()}
    assert math.isclose(miss["b"], 14 / 40) and miss["id"] == 0.0
    days, hours = {}, {}
    for _, t, y, _ in rows:
        days.setdefault((t - 500) // 86_400, []).append(y)
        hours[t // 3600 % 24] = hours.get(t // 3600 % 24, 0) + 1
    got = {x["day"]: (x["n_transactions"], x["rate"]) for x in pr.rate_by_elapsed_day(df).collect()}
    assert {d: (len(ys), sum(ys) / len(ys)) for d, ys in days.items()} == got
    assert {x["hour"]: x["n_transactions"] for x in pr.rate_by_hour(df).collect()} == hours


def test_chronological_split(spark):
    rows = [(i, (i * 59) % 83) for i in range(83)]
    df = spark.createDataFrame(rows, "id long, t long")
    train = {r["id"] for r in sp.chronological_split(df, test_size=0.3).collect() if r["split"] == "train"}
    assert train == {i for i, t in rows if t < round(83 * 0.7)}


def test_stratified_split_exact_share(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "id long, y int")
    c = {(r["y"], r["split"]): r["n"] for r in sp.stratified_split(df, "y", test_size=0.2).groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert c[(1, "test")] == 10 and c[(0, "test")] == 30


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(1.5,), (1.5000001,), (40.0,), (-2.0,)], "x double")
    got = [r[0] for r in df.select(right_closed_bin("x", [1.5, 8.0])).collect()]
    assert got == [0, 1, 2, 0]


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in [0.01, 0.05, 0.2, 0.4, 0.9]], "v double")
    assert [r[0] for r in df.select(iv_strength("v")).collect()] == ["not_useful", "weak", "medium", "strong", "suspicious"]
    df2 = spark.createDataFrame([(v,) for v in [0.0, 0.05, 0.10, 0.15, 0.25, 0.5]], "v double")
    assert [r[0] for r in df2.select(psi_verdict("v")).collect()] == ["stable"] * 2 + ["moderate_shift"] * 2 + ["significant_shift"] * 2


def test_merge_left_flag(spark):
    orders = spark.createDataFrame([(i, i * 0.5) for i in range(9)], "key long, amt double")
    side = spark.createDataFrame([(i, "x") for i in (2, 3, 5, 7, 30)], "key long, extra string")
    m = mg.merge_left_flag(orders, side, "key", "found")
    assert {r["key"] for r in m.collect() if r["found"]} == {2, 3, 5, 7} and m.count() == 9
    assert math.isclose(mg.match_rate(m, "found").first()["match_rate"], 4 / 9)
    with pytest.raises(ValueError, match="duplicate"):
        mg.merge_left_flag(orders, side.unionByName(side), "key")


def test_chronological_split_ties_at_cut(spark):
    df = spark.createDataFrame([(5, 200), (4, 100), (1, 0), (3, 100), (2, 100)], "id long, t long")
    s = {r["id"]: r["split"] for r in sp.chronological_split(df, test_size=0.4).collect()}
    assert [i for i in sorted(s) if s[i] == "train"] == [1, 2, 3]
