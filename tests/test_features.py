import math

from pyspark.sql import functions as F

from riskspark.operators import features as fe
from riskspark.operators.ordering import global_rank, prefix_sum
from riskspark.operators.quantiles import exact_quantiles


def rows_by_id(df, cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in df.collect()}


def plain_velocity(rows, window):
    """(count, sum) of the card's rows in (t - window, t], in (t, id) order."""
    out = {}
    for i, card, t, _ in rows:
        seen = [r for r in rows if r[1] == card and t - window < r[2] and (r[2], r[0]) <= (t, i)]
        out[i] = (len(seen), sum(r[3] for r in seen if r[3] is not None)) if card is not None else (None, None)
    return out


def test_velocity_equals_brute_force(spark):
    rows = [(i, "pqr"[i * i % 3], (i * 1709) % 90_000 // 300 * 300, float(i % 11)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double")
    out = fe.add_velocity_features(df)
    for label, seconds in fe.DEFAULT_WINDOWS.items():
        assert rows_by_id(out, [f"card_txn_count_{label}", f"card_amt_sum_{label}"]) == plain_velocity(rows, seconds)


def test_velocity_window_edge_ties_and_nulls(spark):
    rows = [(1, "k", 50, 3.0), (2, "k", 650, 5.0), (3, "k", 650, 7.0), (4, "k", 651, 11.0), (5, "k", 1250, None), (6, None, 9, 2.0)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double")
    got = rows_by_id(fe.add_velocity_features(df, windows_seconds={"w": 600}, ranges=3), ["card_txn_count_w", "card_amt_sum_w"])
    # a transaction with a NULL amount is not counted
    want = plain_velocity([r for r in rows if r[3] is not None], 600)
    assert all(got[i] == want[i] for i in (1, 2, 3, 4)) and got[5] == (1, 11.0) and got[6] == (None, None)


def test_velocity_ranges_do_not_change_results(spark):
    rows = [(i, i % 3, (i * 977) % 20000, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, card long, t long, amount double")
    a = rows_by_id(fe.add_velocity_features(df, windows_seconds={"w": 1500}, ranges=1), ["card_txn_count_w", "card_amt_sum_w"])
    b = rows_by_id(fe.add_velocity_features(df, windows_seconds={"w": 1500}, ranges=37), ["card_txn_count_w", "card_amt_sum_w"])
    assert a == b
    # brute force
    for i, c, t, _ in rows[:50]:
        exp = [x for x in rows if x[1] == c and t - 1500 < x[2] and (x[2] < t or (x[2] == t and x[0] <= i))]
        assert a[i][0] == len(exp)


def test_card_usage_equals_brute_force(spark):
    rows = [(i, "uv"[i % 5 // 3], (i * 37) % 60 * 10, 1.0 + i % 4, i * 7 % 6) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double, diversity int")
    cols = ["card_prior_txn_count", "card_running_avg_amt", "card_amt_ratio_to_own_avg", "card_prior_distinct_diversity_count"]
    out = rows_by_id(fe.add_card_usage_features(df, buckets=3), cols)
    for i, card, t, amount, _ in rows:
        before = [r for r in rows if r[1] == card and (r[2], r[0]) < (t, i)]
        n, avg, ratio, kinds = out[i]
        assert (n, kinds) == (len(before), len({r[4] for r in before}))
        if before:
            mean = sum(r[3] for r in before) / len(before)
            assert math.isclose(avg, mean) and math.isclose(ratio, amount / mean)
        else:
            assert avg is None and ratio is None


def test_hour_of_day_and_frequency(spark):
    rows = [(i, (i * 5077) % 200_000, float(i % 9)) for i in range(70)]
    df = spark.createDataFrame(rows, "id long, t long, amount double")
    out = rows_by_id(fe.add_hour_of_day_aggregates(df), ["hour_of_day_avg_amt", "hour_of_day_txn_count"])
    for i, t, _ in rows:
        same = [a for _, u, a in rows if u // 3600 % 24 == t // 3600 % 24]
        assert math.isclose(out[i][0], sum(same) / len(same)) and out[i][1] == len(same)
    f = spark.createDataFrame([(i, [None, "m", "m", "n", "m"][i % 5]) for i in range(10)], "id long, c string")
    enc = rows_by_id(fe.frequency_encode(f, ["c"]), ["c_freq"])
    assert all(math.isclose(enc[i][0], [0.2, 0.6, 0.6, 0.2, 0.6][i % 5]) for i in range(10))
    other = spark.createDataFrame([(99, "never seen")], "id long, c string")
    assert rows_by_id(fe.frequency_encode(other, ["c"], fit_df=f), ["c_freq"])[99] == (0.0,)


def test_prefix_sum_buckets_equal_plain_window(spark):
    rows = [(i, (i * 37) % 11, float((i * 13) % 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g long, v double")
    a = prefix_sum(df, ["g", "id"], {"s": F.col("v")}, buckets=7).select("id", "s").collect()
    b = prefix_sum(df, ["g", "id"], {"s": F.col("v")}, buckets=1).select("id", "s").collect()
    assert sorted(a) == sorted(b)
    seg = prefix_sum(df, ["id"], {"s": F.col("v")}, partition_by=["g"], buckets=5, inclusive=False)
    got = {r["id"]: r["s"] for r in seg.collect()}
    for i, g, _ in rows[:60]:
        assert got[i] == sum(v for j, gg, v in rows if gg == g and j < i)
    r = global_rank(df, [("v", False), ("id", True)], buckets=4).collect()
    assert sorted(x["rank"] for x in r) == list(range(1, 501))


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    vals = [float((i * 7919) % 1000) / 7 for i in range(333)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.8, 1.0]
    got = {r["q"]: r["quantile"] for r in exact_quantiles(df, "x", qs, buckets=3).collect()}
    for q in qs:
        assert math.isclose(got[q], float(np.quantile(vals, q)), rel_tol=1e-12, abs_tol=1e-12)


def test_leakage_guard(spark):
    rows = [(i, i % 4, i * 600, float(i)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, card long, t long, amount double")
    r = fe.leakage_guard(df, 20000, lambda d: fe.add_velocity_features(d)).first()
    assert r["n_mismatch"] == 0 and r["n_checked"] > 0


def test_velocity_unbounded_window(spark):
    rows = [(1, "A", 0, 1.0), (2, "A", 50, None), (3, "A", 50, 2.0), (4, "B", 10, 4.0), (5, None, 20, 8.0)]
    df = spark.createDataFrame(rows, "id long, card string, t long, amount double")
    out = rows_by_id(fe.add_velocity_features(df, windows_seconds={"any": None}), ["card_txn_count_any", "card_amt_sum_any"])
    assert out[1] == (1, 1.0) and out[2] == (1, 1.0) and out[3] == (2, 3.0) and out[4] == (1, 4.0)
    assert out[5] == (None, None)
