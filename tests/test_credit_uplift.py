import math
import random

import pytest

from riskspark.operators import drift as dr
from riskspark.operators import sampling as sa
from riskspark.operators import uplift as up
from riskspark.operators import woe as wo


def test_woe_iv_of_three_categories(spark):
    counts = {"north": (37, 5), "south": (21, 21), "west": (6, 30)}  # (zeros, ones)
    rows = [(c, y) for c, pair in counts.items() for y, n in enumerate(pair) for _ in range(n)]
    m = wo.fit_woe_bins(spark.createDataFrame(rows, "cat string, y int"), [], ["cat"], "y")
    t = {r["bin"]: r for r in m.table.collect()}
    zeros, ones = (sum(p[k] for p in counts.values()) for k in (0, 1))
    for c, (n0, n1) in counts.items():
        plain = math.log((n0 / zeros) / (n1 / ones))  # without smoothing
        assert math.isclose(t[c]["woe"], plain, rel_tol=0.2, abs_tol=0.05)
    assert t["north"]["woe"] > t["south"]["woe"] > t["west"]["woe"]
    assert all(r["iv"] >= 0 for r in t.values())
    other = spark.createDataFrame([("east", 0), (None, 1)], "cat string, y int")
    assert [r["cat_woe"] for r in wo.transform_woe(other, m).collect()] == [0.0, 0.0]
    assert {r["cat_bin"] for r in wo.assign_bins(other, m).collect()} == {wo.UNSEEN_LABEL, wo.MISSING_LABEL}


def test_woe_special_values_and_missing_have_own_bins(spark):
    rows = [(float(i % 13), i % 3 % 2) for i in range(130)] + [(-9.0, 1)] * 4 + [(-9.0, 0)] * 2 + [(None, 0)] * 3
    m = wo.fit_woe_bins(spark.createDataFrame(rows, "x double, y int"), ["x"], [], "y", special_values={"x": [-9.0]})
    bins = {r["bin"]: r for r in m.table.collect()}
    assert {wo.MISSING_LABEL, "special=-9.0"} <= set(bins)
    assert all(0 <= e <= 12 for e in m.edges["x"]) and m.edges["x"] == sorted(m.edges["x"])


def test_psi_equals_its_formula(spark):
    rng = random.Random(4)
    old = [rng.gauss(0, 1) for _ in range(600)]
    new = [rng.gauss(0.4, 1.3) for _ in range(500)]
    e, a = (spark.createDataFrame([(v,) for v in side], "x double") for side in (old, new))
    edges = dr.psi_edges(e, ["x"], 5)["x"]
    share = lambda side: [sum(sum(c < v for c in edges) == k for v in side) / len(side) for k in range(len(edges) + 1)]
    want = sum((q - p) * math.log(q / p) for p, q in zip(share(old), share(new), strict=True))
    assert math.isclose(dr.psi_by_feature(e, a, ["x"], bins=5).first()["psi"], want, rel_tol=1e-3)
    assert abs(dr.psi_by_feature(e, e, ["x"], bins=5).first()["psi"]) < 1e-12


CAMPAIGN = [(i, int(random.Random(i).random() < 0.4 + 0.02 * (i % 5)), i * i % 3 % 2, ((i * 29) % 41) / 41) for i in range(41)]


def campaign(spark):
    return spark.createDataFrame(CAMPAIGN, "id long, outcome int, treatment int, score double")


def plain_qini():
    out, nt, nc, yt, yc = [], 0, 0, 0, 0
    for _, y, t, _ in sorted(CAMPAIGN, key=lambda r: (-r[3], r[0])):
        nt, nc, yt, yc = nt + t, nc + 1 - t, yt + t * y, yc + (1 - t) * y
        out.append(yt - yc * nt / nc if nc else yt)
    return out


def test_qini_curve_and_area(spark):
    curve = [r["qini"] for r in up.qini_curve(campaign(spark)).orderBy("rank").collect()]
    want = plain_qini()
    assert all(math.isclose(g, w, abs_tol=1e-12) for g, w in zip(curve, want, strict=True))
    n = len(want)
    area = sum((a + b) / 2 for a, b in zip([0, *want], want)) / n - want[-1] / 2
    assert math.isclose(up.qini_coefficient(campaign(spark)).first()[0], area / n, abs_tol=1e-12)


@pytest.mark.parametrize("k", [0.3, 0.65, 1.0])
def test_uplift_at_k(spark, k):
    top = sorted(CAMPAIGN, key=lambda r: (-r[3], r[0]))[: round(k * len(CAMPAIGN))]
    rate = lambda arm: sum(r[1] for r in top if r[2] == arm) / sum(r[2] == arm for r in top)
    assert math.isclose(up.uplift_at_k(campaign(spark), k).first()["uplift"], rate(1) - rate(0), abs_tol=1e-12)


def test_uplift_needs_both_arms_and_flags(spark):
    c = campaign(spark)
    for bad in (c.filter("treatment = 1"), c.filter("id < 0"), c.selectExpr("id", "2 outcome", "treatment", "score")):
        with pytest.raises(ValueError):
            up.qini_curve(bad)
    with pytest.raises(ValueError):
        up.uplift_at_k(c.filter("id < 2"), 0.01)


def test_uncertainty_scores(spark):
    rng = random.Random(8)
    vectors = [[0.25, 0.25, 0.25, 0.25], [0.0, 1.0, 0.0, 0.0]]
    for _ in range(20):
        raw = [rng.random() for _ in range(4)]
        vectors.append([x / sum(raw) for x in raw])
    df = spark.createDataFrame(list(enumerate(vectors)), "id long, probs array<double>")
    entropies = {}
    for r in sa.uncertainty_scores(df).collect():
        first, second, *_ = sorted(vectors[r["id"]], reverse=True)
        entropies[r["id"]] = -sum(x * math.log(x) for x in vectors[r["id"]] if x)
        assert math.isclose(r["least_confidence"], 1 - first, abs_tol=1e-12)
        assert math.isclose(r["margin"], 1 - (first - second), abs_tol=1e-12)
        assert math.isclose(r["entropy"], entropies[r["id"]], abs_tol=1e-9)
    want = sorted(entropies, key=lambda i: (-round(entropies[i], 12), i))[:5]
    assert [r["id"] for r in sa.select_query_batch(df, 5).collect()] == want


@pytest.mark.parametrize("vector", [[0.7, 0.7], [1.0], [1.2, -0.2], [float("nan"), 1.0]])
def test_unusable_probabilities(spark, vector):
    with pytest.raises(ValueError):
        sa.validate_probabilities(spark.createDataFrame([(0, vector)], "id long, probs array<double>"))
