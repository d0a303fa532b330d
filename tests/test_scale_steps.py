"""Steps that are made once, and medians from the middle values only."""

import statistics

import pytest
from pyspark.sql import functions as F

from riskspark.functions.columns import right_closed_bin
from riskspark.operators import features as fe
from riskspark.operators import graph as gr
from riskspark.operators import quantiles as qu
from riskspark.operators import split as sp
from riskspark.operators.ordering import edge_offsets
from riskspark.plans import model_plans as plans


def test_sides_of_the_credit_split_are_read_not_made(spark, tmp_path):
    spark.range(400).select(
        F.col("id").alias("o_orderkey"), F.lit(1).alias("o_custkey"), F.when(F.col("id") % 3 == 0, "F").otherwise("O").alias("o_orderstatus"), F.col("id").cast("double").alias("o_totalprice"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.timestamp_seconds("id").alias("o_orderdate"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 5.0, "A")], "c_custkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    train, test = plans._credit_split(spark, str(tmp_path))
    for side in (train, test):
        assert "Exchange" not in side._jdf.queryExecution().executedPlan().toString()
    assert (train.count(), test.count()) == (320, 80)


def test_medians_order_only_the_middle(spark, monkeypatch):
    n = 4001
    values = {"a": [float(i * 37 % 4001) for i in range(n)], "b": [None if i % 2 else float(i) for i in range(n)], "c": [0.0 if i % 3 else float("inf") for i in range(n)], "d": [None] * n}
    df = spark.createDataFrame(list(zip(*values.values(), strict=True)), "a double, b double, c double, d double")
    seen, real = [], qu.prefix_sum
    monkeypatch.setattr(qu, "prefix_sum", lambda hist, *a, **k: seen.append(hist.count()) or real(hist, *a, **k))
    from riskspark.operators.learners import fit_medians

    got = fit_medians(df, list(values))
    assert got == {c: statistics.median(x for x in v if x is not None) if any(x is not None for x in v) else None for c, v in values.items()}
    assert seen and seen[0] < n / 10


@pytest.mark.parametrize("edges", [[], [1.0], [1.0, 2.5], [float(i) for i in range(40)]])
def test_bins_compile_or_not_alike(spark, edges):
    xs = [None, float("-inf"), -0.0, 1.0, 1.1, 2.5, 39.5, float("inf"), float("nan")]
    got = [r["b"] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(right_closed_bin("x", edges).alias("b")).collect()]
    assert got == [0 if x is None else sum(1 for e in edges if x != x or e < x) for x in xs]


def test_the_hops_checkpoint_no_edges(spark, monkeypatch):
    written, real = [], gr.cut_lineage
    monkeypatch.setattr(gr, "cut_lineage", lambda df: written.append(df.columns) or real(df))
    nodes = spark.createDataFrame([(i, float(i)) for i in range(20)], "id long, x double")
    edges = spark.createDataFrame([(i, "card", f"c{i % 4}") for i in range(20)], "txn long, entity_type string, entity string")
    assert gr.khop_features(nodes, edges, "id", ["x"], 2, 0.1).count() == 20
    assert written and not any("txn" in c for c in written)


def test_the_guard_builds_each_side_once(spark):
    df = spark.createDataFrame([(i, i * 10, 1.0) for i in range(50)] + [(7, 70, 1.0)], "id long, t long, x double").localCheckpoint()
    last = df.agg(F.max("t")).first()[0]
    r = fe.leakage_guard(df, 200, lambda d: d.withColumn("x", F.col("x") + F.col("t")))
    assert r._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    assert r.first().asDict() == {"n_checked": 22, "n_mismatch": 0}
    leaking = fe.leakage_guard(df, 200, lambda d: d.crossJoin(d.agg(F.max("t").alias("m"))))
    assert last == 490 and leaking.first().asDict() == {"n_checked": 22, "n_mismatch": 44}


@pytest.mark.parametrize("rows", [
    [(i, 10 * i) for i in range(41)],
    [(i * 7 % 41, i // 15) for i in range(41)],  # starts lie within a second
    [(i // 9, 3) for i in range(41)],  # rows on both sides of a start are alike
    [(None if i % 5 == 0 else i, None if i < 20 else i // 8) for i in range(41)],
])
def test_folds_cut_between_rows_without_moving_them(spark, monkeypatch, rows):
    """ranks are made of keys near the starts, not of whole rows."""
    df = spark.createDataFrame([(i, t, float(n)) for n, (i, t) in enumerate(rows)], "id long, t long, x double")
    ranked, real = [], sp.global_rank
    monkeypatch.setattr(sp, "global_rank", lambda d, *a, **k: ranked.append(set(d.columns)) or real(d, *a, **k))
    f = sp.time_series_folds(df, 3).collect()
    alike = len(set(rows)) < 20
    assert ({"id", "t", "x"} in ranked) == alike
    order = sorted(range(41), key=lambda n: (rows[n][1] is not None, rows[n][1] or 0, rows[n][0] is not None, rows[n][0] or 0))
    for k in range(3):
        start = 41 - (3 - k) * 10
        for role, want in (("train", order[:start]), ("test", order[start : start + 10])):
            got = [r for r in f if r["fold"] == k and r["role"] == role]
            assert sorted(map(str, ((r["id"], r["t"]) for r in got))) == sorted(str(rows[n]) for n in want)
            if not alike:
                assert sorted(r["x"] for r in got) == sorted(float(n) for n in want)


def test_only_edge_segments_of_a_range_are_added_up(spark):
    """the same offsets as from the totals of all segments."""
    rows = [(r, c, float(10 * r + c)) for r in range(4) for c in range(2 * r, 2 * r + 3) for _ in range(2)]
    dealt = spark.createDataFrame(rows, "__rng int, c int, a double")
    for later in (False, True):
        got, want = (sorted(map(tuple, edge_offsets(dealt, F.struct("c"), {"s": F.col("a")}, later, fine=fine).collect())) for fine in (True, False))
        assert got == want and len(got) == 8 and any(s for *_, s in got)


def test_windows_share_a_sort_where_blocks_nest(spark):
    assert fe._nested([3600, 86400, 5400], True) == [[1, 2], [0]] and fe._nested([3600, 86400], False) == [[1], [0]]
    df = spark.createDataFrame([(i, i % 3, i * 1500, float(i)) for i in range(90)], "id long, card long, t long, amount double")
    got = {r["id"]: r for r in fe.add_velocity_features(df, windows_seconds={"1h": 3600, "6h": 21600, "4h": 14400}).collect()}
    for i in range(90):
        for label, d in (("1h", 3600), ("6h", 21600), ("4h", 14400)):
            inside = [float(j) for j in range(i + 1) if j % 3 == i % 3 and j * 1500 > i * 1500 - d]
            assert (got[i][f"card_txn_count_{label}"], got[i][f"card_amt_sum_{label}"]) == (len(inside), sum(inside))
