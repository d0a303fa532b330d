import math
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import resample as rs


def test_exact_knn_matches_brute_force_with_small_blocks(spark):
    rnd = random.Random(3)
    pts = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = {}
    for r in rs.exact_knn(df, 4, block_size=5).collect():
        got.setdefault(r["id"], []).append((r["neighbor_rank"], r["neighbor_id"]))
    for i, v in pts:
        d = sorted((math.dist(v, w), j) for j, w in pts if j != i)[:4]
        assert [j for _, j in d] == [j for _, j in sorted(got[i])]


def brute(pts, k):
    out = {}
    for i, v in pts:
        d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), j) for j, w in pts if j != i)[:k]
        out[i] = [j for _, j in d]
    return out


def found(df, k, **how):
    got = {}
    for r in rs.exact_knn(df, k, **how).orderBy("neighbor_rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    return got


def groups(n, centres, dims=64, spread=0.04, seed=5):
    rnd = random.Random(seed)
    middle = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    return [(i, [x + rnd.gauss(0, spread) for x in middle[i % centres]]) for i in range(n)]


def surface(n, dims=64, seed=6):
    """Points of three free coordinates, turned into 64."""
    rnd = random.Random(seed)
    turn = [[rnd.gauss(0, 1) for _ in range(3)] for _ in range(dims)]
    free = [[rnd.random() for _ in range(3)] for _ in range(n)]
    return [(i, [sum(a * b for a, b in zip(t, f)) for t in turn]) for i, f in enumerate(free)]


@pytest.mark.parametrize("made, share", [(groups(1200, 40), 0.1), (surface(1200), 0.25)])
def test_few_pairs_are_compared_in_64_dimensions(spark, made, share):
    df = spark.createDataFrame(made, "id long, vec array<double>").repartition(4)
    compared = rs._candidates(df, 5, 256).agg(F.sum("compared")).first()[0]
    assert compared < share * len(made) ** 2
    got, want = found(df, 5), brute(made, 5)
    assert got == want


def test_directions_drawn_evenly_are_still_exact(spark):
    rnd = random.Random(8)
    made = [(i, [rnd.gauss(0, 1) for _ in range(64)]) for i in range(250)]
    assert found(spark.createDataFrame(made, "id long, vec array<double>"), 5) == brute(made, 5)


def test_equal_vectors_and_ties(spark):
    """A third of all points are one vector; a grid has many equal distances."""
    made = [(i, [0.5, 0.5]) if i % 3 == 0 else (i, [float(i % 7), float(i % 5)]) for i in range(300)]
    df = spark.createDataFrame(made, "id long, vec array<double>")
    assert found(df, 4, block_size=8) == brute(made, 4)
    compared = rs._candidates(rs._few_copies(df, 4)[0], 4, 8).agg(F.sum("compared")).first()[0]
    assert compared < 300 * 300 / 3


def test_ring_that_many_ask_is_handed_out_in_copies(spark, monkeypatch):
    monkeypatch.setattr(rs, "_ASKERS", 7)
    made = groups(150, 2, dims=3, spread=0.5)
    assert found(spark.createDataFrame(made, "id long, vec array<double>"), 3) == brute(made, 3)


def test_few_and_missing_points(spark):
    schema = "id string, vec array<double>"
    assert rs.exact_knn(spark.createDataFrame([], schema), 3).collect() == []
    assert rs.exact_knn(spark.createDataFrame([("a", [1.0]), ("b", None)], schema), 3).collect() == []
    assert found(spark.createDataFrame([("a", [1.0]), ("b", [3.0]), ("c", [1.5])], schema), 5) == {"a": ["c", "b"], "b": ["c", "a"], "c": ["a", "b"]}


def test_smote_interpolates_between_neighbours(spark):
    pts = [(i, [float(i), float(2 * i)], int(i < 6)) for i in range(20)]
    df = spark.createDataFrame(pts, "id long, vec array<double>, y int")
    syn, n_new = rs.oversample_to_parity(df, "y", 1, "id", "vec", k=3, seed=1)
    rows = syn.collect()
    assert n_new == 8 and len(rows) == 8
    for r in rows:
        assert 0.0 <= r["gap"] < 1.0 and r["base_id"] < 6 and r["neighbor_id"] < 6 and r["neighbor_id"] != r["base_id"]
        lo, hi = sorted([float(r["base_id"]), float(r["neighbor_id"])])
        assert lo - 1e-9 <= r["vec"][0] <= hi + 1e-9 and math.isclose(r["vec"][1], 2 * r["vec"][0])
