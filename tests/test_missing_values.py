"""NaN is a missing value, and empty inputs are errors."""

import math

import pytest

from riskspark.operators import drift, features, learners, profile, registry
from riskspark.operators.quantiles import exact_quantiles
from riskspark.sources.contracts import load_checked

NAN = float("nan")


def test_describe_skips_nan(spark):
    df = spark.createDataFrame([(1, 0, 4.0), (2, 0, 8.0), (3, 0, NAN), (4, 0, None)], "id long, label int, x double")
    r = profile.describe_by_label(df, columns=["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"], r["p50"]) == (2, 6.0, 4.0, 8.0, 6.0)


def test_medians_skip_nan_and_keep_fractions(spark):
    df = spark.createDataFrame([(10, 3.0), (11, NAN), (None, 9.0), (14, 6.0), (15, 1.0)], "a long, b double")
    assert learners.fit_medians(df, ["a", "b"]) == {"a": 12.5, "b": 4.5}
    rows = learners.impute_median(df, ["a", "b"]).collect()
    assert rows[2]["a"] == 12.5 and rows[1]["b"] == 4.5
    m, s = learners.fit_standardizer(df, ["b"])["b"]
    assert math.isclose(m, 4.75) and s > 0


def test_quantiles_skip_nan(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, NAN, 1.0, 3.0)], "x double")
    assert exact_quantiles(df, "x", [0.5]).first()["quantile"] == 3.0


def test_velocity_ignores_nan_amounts(spark):
    df = spark.createDataFrame([(1, "k", 10, 2.0), (2, "k", 20, NAN), (3, "k", 30, 5.0)], "id long, card string, t long, amount double")
    for windows in ({"w": 100}, {"w": None}):
        got = {r["id"]: (r["card_txn_count_w"], r["card_amt_sum_w"]) for r in features.add_velocity_features(df, windows_seconds=windows).collect()}
        assert got == {1: (1, 2.0), 2: (1, 2.0), 3: (2, 7.0)}


def test_psi_by_batch_agrees_with_psi_by_feature(spark):
    old = spark.createDataFrame([(float(i % 17),) for i in range(200)] + [(NAN,)] * 9, "x double")
    new = spark.createDataFrame([(0, float(i % 11)) for i in range(150)] + [(0, NAN)] * 30 + [(0, None)] * 3, "b long, x double")
    one = drift.psi_by_feature(old, new.select("x"), ["x"]).first()
    batch = registry.psi_by_batch(old, new, "x", "b").first()
    assert math.isclose(one["psi"], batch["psi"]) and one["verdict"] == batch["verdict"]


def test_load_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, NAN), (2, 1.5)], "id long, x double").write.parquet(path)
    assert {r["id"]: r["x"] for r in load_checked(spark, path, ["id", "x"], ["id"]).collect()} == {1: None, 2: 1.5}


def test_empty_inputs_are_errors(spark):
    df = spark.createDataFrame([], "id long, card string, t long, amount double")
    for build in (features.add_velocity_features, features.add_card_usage_features, features.engineer_features):
        with pytest.raises(ValueError, match="no rows"):
            build(df)
    some = spark.createDataFrame([(float(i),) for i in range(9)], "x double")
    for old, new in ((some, some.filter("x < 0")), (some.filter("x < 0"), some)):
        with pytest.raises(ValueError):
            drift.psi_by_feature(old, new, ["x"])


def plain(rows, window):
    """Sums added up row by row, in (t, id) order."""
    out = {}
    for i, card, t, _ in rows:
        seen = [r[3] for r in sorted(rows, key=lambda r: (r[2], r[0])) if r[1] == card and t - window < r[2] and (r[2], r[0]) <= (t, i) and r[3] is not None]
        out[i] = (len(seen), sum(seen) if seen else None)
    return out


@pytest.mark.parametrize("ranges", [1, 4])
def test_velocity_sums_do_not_cancel(spark, ranges):
    rows = [(1, "a", 0, 1e17), (2, "a", 7200, 1.5), (3, "a", 7300, 2.5), (4, "b", 0, math.inf), (5, "b", 10, 1.0), (6, "b", 3600, 2.0), (7, "b", 90_000, 4.0)]
    rows += [(8, "c", 5, -math.inf), (9, "c", 9, 1e300), (10, "c", 3606, 0.1), (11, "c", 3607, 0.2)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double")
    out = features.add_velocity_features(df, ranges=ranges).collect()
    for label, seconds in features.DEFAULT_WINDOWS.items():
        assert {r["id"]: (r[f"card_txn_count_{label}"], r[f"card_amt_sum_{label}"]) for r in out} == plain(rows, seconds)
    assert {r["id"]: r["card_amt_sum_1h"] for r in out if r["card"] == "a"} == {1: 1e17, 2: 1.5, 3: 4.0}


def test_prior_average_does_not_cancel(spark):
    rows = [(1, "a", 0, 1.5), (2, "a", 1, 1e17), (3, "b", 0, 2.0), (4, "b", 1, math.inf), (5, "b", 2, 3.0)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double")
    out = {r["id"]: (r["card_prior_txn_count"], r["card_running_avg_amt"], r["card_amt_ratio_to_own_avg"]) for r in features.add_card_usage_features(df).collect()}
    assert out[2] == (1, 1.5, 1e17 / 1.5) and out[4] == (1, 2.0, math.inf)
    assert out[1] == out[3] == (0, None, None) and out[5][1] == math.inf


def kept(monkeypatch):
    """What ``deal`` has written."""
    from riskspark.operators import ordering

    seen, real = [], ordering.deal
    for where in (ordering, features):
        monkeypatch.setattr(where, "deal", lambda *a: seen.append(real(*a)) or seen[-1])
    return seen


@pytest.mark.parametrize("step", [0, 1])
def test_card_with_a_third_of_all_rows_spreads(spark, monkeypatch, step):
    """All its rows within one window length, or even (step 0) within a few seconds."""
    n, seen = 6000, kept(monkeypatch)
    df = spark.range(n).selectExpr("id", "if(id % 3 = 0, 'hot', concat('c', id % 500)) card", f"100 + if(id % 3 = 0, id % 5 + id * {step} div 3, id * 40) t", "double(id % 7) amount")
    out = features.add_velocity_features(df, ranges=24)
    got = {r["id"]: (r["card_txn_count_1d"], r["card_amt_sum_1d"]) for r in out.collect()}
    shares = sorted(r["count"] for r in seen[0].groupBy("__rng").count().collect())
    hot = seen[0].where("__c = 'hot' and __q < 0").groupBy("__rng").count().collect()
    assert len(hot) >= 3 and shares[-1] < 3 * shares[len(shares) // 2]
    rows = sorted((r["t"], r["id"], r["amount"]) for r in df.where("card = 'hot'").collect())
    counted = added = 0
    for _, i, amount in rows:
        counted, added = counted + 1, added + amount
        assert got[i] == (counted, added)


def test_repeated_rows_and_null_keys(spark):
    rows = [(1, "a", 5, 2.0)] * 2 + [(None, "a", 6, 1.0), (None, "a", 6, 1.0), (2, "a", None, 4.0), (3, None, 7, 1.0)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double")
    for windows in ({"w": 100}, {"w": None}, {}):
        assert features.add_velocity_features(df, windows_seconds=windows).count() == len(rows)
    assert features.add_card_usage_features(df).count() == len(rows)


def test_payload_is_not_dealt(spark, monkeypatch):
    seen = kept(monkeypatch)
    df = spark.range(50).selectExpr("id", "id % 3 card", "id * 100 t", "1.0D amount", "repeat('x', 1000) note", "1 diversity")
    out = features.add_card_usage_features(features.add_velocity_features(df))
    assert out.select("note").distinct().count() == 1 and out.count() == 50
    assert seen and not any("note" in x.columns for x in seen)


def test_offsets_are_two_rows_per_range_at_most(spark):
    from pyspark.sql import functions as F

    from riskspark.operators import ordering

    df = spark.range(3000).selectExpr("id", "if(id % 2 = 0, 7, id % 400) g", "id % 5 v")
    dealt = ordering.deal(df, 8, F.col("g"), F.col("id"))
    offsets = ordering.edge_offsets(dealt, F.struct("g"), {"v": F.col("v")})
    assert offsets.count() <= 16
    parts = {(r["__rng"], r["g"]): r["s"] for r in dealt.groupBy("__rng", "g").agg(F.sum("v").alias("s")).collect()}
    for r in offsets.collect():
        assert r["v"] == sum(s for (k, g), s in parts.items() if g == r["__seg"]["g"] and k < r["__rng"])
    reached = {(r["__rng"], r["__seg"]["g"]) for r in offsets.collect()}
    assert all((k, g) in reached for k, g in parts if any(g2 == g and k2 < k for k2, g2 in parts))


def test_one_hot_card_costs_linear_time(spark):
    import time

    took = []
    for n in (20_000, 20_000, 60_000):  # the first one warms up
        df = spark.range(n).selectExpr("id", "'k' card", "id * 80000 div %d t" % n, "1.0D amount")
        began = time.time()
        r = features.add_velocity_features(df).agg({"card_txn_count_1d": "max"}).first()
        took.append(time.time() - began)
        assert r[0] == n
    assert took[2] < 3 * took[1]
