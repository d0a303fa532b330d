import bisect
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift, profile, woe
from riskspark.operators import quantiles as qu


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(2)
    rows = [("a", rng.lognormvariate(0, 2)) for _ in range(20_000)] + [("b", float(rng.randrange(50))) for _ in range(5000)] + [("c", 7.0), ("d", None), ("d", float("nan"))]
    return rows, spark.createDataFrame(rows, "g string, x double").repartition(7).cache()


def worst(rows, found):
    """Largest distance of a wanted rank from the ranks that the answer has."""
    values, out = {}, 0.0
    for g, x in rows:
        if x is not None and x == x:
            values.setdefault(g, []).append(x)
    for v in values.values():
        v.sort()
    for r in found:
        v = values[r["g"]]
        low, high = bisect.bisect_left(v, r["quantile"]) / len(v), bisect.bisect_right(v, r["quantile"]) / len(v)
        out = max(out, low - r["q"], r["q"] - high)
    return out


QS = [i / 40 for i in range(41)]


@pytest.mark.parametrize("k", [100, 400])
def test_rank_error_is_within_the_bound(skewed, k):
    rows, df = skewed
    found = qu.quantiles(df, "x", QS, ["g"], sketch=k).collect()
    assert {r["g"] for r in found} == {"a", "b", "c"}
    assert worst(rows, found) <= 1.5 * qu.rank_error(k)  # the bound holds in 99 of 100 cases; many are asked
    exact = qu.quantiles(df, "x", QS, ["g"]).collect()
    ends = lambda f: {(r["g"], r["q"]): r["quantile"] for r in f if r["q"] in (0.0, 1.0)}
    assert ends(found) == ends(exact)


def test_stored_sketches_merge(skewed):
    rows, df = skewed
    days = df.withColumn("day", F.pmod(F.xxhash64("x"), F.lit(6)))
    merged = qu.merge_sketches(qu.quantile_sketch(days, "x", 400, ["g", "day"]), ["g"])
    assert worst(rows, qu.sketch_quantiles(merged, QS, ["g"]).collect()) <= 1.5 * qu.rank_error(400)


def test_bad_sizes_and_ranks(skewed):
    _, df = skewed
    with pytest.raises(ValueError):
        qu.quantile_sketch(df, "x", 2)
    with pytest.raises(ValueError):
        qu.sketch_quantiles(qu.quantile_sketch(df, "x", 100), [1.5])


def test_options_agree_with_the_exact_ones(spark):
    """Below k values a sketch holds them all, so its answers are values next to the exact ones."""
    rows = [(i, float(i), int(i % 3 == 0 or i > 150)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, label int")
    exact, near = (woe.fit_edges(df, ["x"], 5, sketch=k)["x"] for k in (None, 4000))
    assert len(exact) == len(near) == 4 and all(abs(a - b) <= 1 for a, b in zip(exact, near))
    assert woe.fit_woe_bins(df, ["x"], [], "label", sketch=4000).edges["x"] == near
    report = drift.psi_by_feature_report(df, df.where("id > 50"), ["x"], sketch=4000)
    assert report.agg(F.sum("n_expected")).first()[0] == 200
    a, b = ({r["label"]: r["p50"] for r in profile.describe_by_label(df, "label", ["x"], sketch=k).collect()} for k in (None, 4000))
    assert all(abs(a[k] - b[k]) <= 3 for k in a)
