import os

import pytest
from pyspark.sql import functions as F

from riskspark.operators import audit as au
from riskspark.operators import graph as gr
from riskspark.operators import policy as po
from riskspark.operators import registry as rg
from riskspark.operators import split as sp
from riskspark.sources import contracts as ct
from riskspark.streaming import jobs as sj


def test_contract_report_and_load_checked(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "e")], "k long, v string")
    r = ct.contract_report(df, "t", ["k", "v", "w"], ["k"]).first()
    assert (r["n_rows"], r["n_missing_columns"], r["missing_columns"], r["n_duplicate_rows"], r["n_duplicate_keys"]) == (5, 1, "w", 2, 2)
    path = str(tmp_path / "t.parquet")
    df.write.parquet(path)
    with pytest.raises(ValueError, match="lacks columns"):
        ct.load_checked(spark, path, ["k", "w"], ["k"])
    with pytest.raises(ValueError, match="2 duplicate"):
        ct.load_checked(spark, path, ["k"], ["k"])
    with pytest.raises(FileNotFoundError):
        ct.load_checked(spark, str(tmp_path / "nope"), ["k"], ["k"])


def test_policy(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.5), (3, 0.9)], "id long, score double")
    got = [r["decision"] for r in po.decide_probability(df, 0.4, 0.7).orderBy("id").collect()]
    assert got == ["approve", "review", "decline"]
    with pytest.raises(ValueError):
        po.validate_thresholds(0.7, 0.4)
    with pytest.raises(ValueError):
        po.decide_probability(spark.createDataFrame([(1, 1.5)], "id long, score double"), 0.4, 0.7)
    pts = spark.createDataFrame([(1, 600.0), (2, 550.0), (3, 500.0)], "id long, score double")
    assert [r["decision"] for r in po.decide_points(pts, 573.3, 544.0).orderBy("id").collect()] == ["approve", "review", "decline"]


def test_graph_fixture(spark):
    train = spark.createDataFrame(
        [(1, 0, 1.0, 2.0, "X", 10), (2, 1, 2.0, None, "Y", 10), (3, 0, 3.0, 1.0, "X", 20), (4, 1, 4.0, 3.0, "Z", None)],
        "id long, label int, f1 double, f2 double, card1 string, addr1 long",
    )
    test = spark.createDataFrame([(5, 0, 5.0, 4.0, "W", 30), (6, 1, None, 5.0, "X", 10)], "id long, label int, f1 double, f2 double, card1 string, addr1 long")
    nodes = gr.node_table(train, test, "id", ["f1", "f2"], "label")
    assert nodes.count() == 6
    tr = nodes.where("mask = 'train'").agg(F.avg("f1").alias("m"), F.stddev_pop("f1").alias("s")).first()
    assert abs(tr["m"]) < 1e-12 and abs(tr["s"] - 1.0) < 1e-12  # scaled with train stats
    edges = gr.edge_table(train.unionByName(test), "id", ["card1", "addr1"])
    ents = gr.entity_nodes(edges)
    assert ents.where("entity_type = 'card1'").count() == 4
    x_txns = sorted(r["txn"] for r in edges.where("entity_type = 'card1' AND entity = 'X'").collect())
    assert x_txns == [1, 3, 6]
    rev = gr.reverse_edges(edges)
    assert rev.count() == edges.count()
    reach = {(r["id"], r["entity_type"]): r["n_shared"] for r in gr.shared_entity_reach(edges, "id").collect()}
    assert reach[(1, "card1")] == 2 and reach[(5, "card1")] == 0
    hop = {r["id"]: r for r in gr.khop_mean(nodes, edges, "id", ["f1"]).collect()}
    assert len(hop) == 6


def test_audit_log_append_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.2, "approve", 10.0), (2, 0.8, "decline", None)], "id long, score double, decision string, amt double")
    rows = au.decision_rows(df, "fraud", "v1", "id", F.current_timestamp(), "score", "decision", ["amt"])
    path = str(tmp_path / "log")
    au.append_decisions(rows, path, batch_id=0)
    au.append_decisions(rows, path, batch_id=0)  # retried batch: no duplicates
    log = spark.read.parquet(path)
    assert log.count() == 2
    assert '"amt":null' in log.where("id = 2").first()["input_json"]
    piv = au.decision_pivot(log).first()
    assert (piv["approve"], piv["review"], piv["decline"]) == (1, 0, 1)
    assert [r["id"] for r in au.recent_decisions(log, 1).collect()] == [2]


def test_registry(spark):
    from datetime import datetime

    promos = spark.createDataFrame(
        [("m", "champion", "1", datetime(2020, 1, 1)), ("m", "champion", "3", datetime(2021, 1, 1)), ("m", "champion", "2", datetime(2022, 1, 1))],
        "name string, alias string, version string, promoted_at timestamp",
    )
    assert rg.champion(promos, "m").first()["version"] == "2"
    assert rg.champion(promos, "other").count() == 0
    versions = spark.createDataFrame([("m", "9"), ("m", "10"), ("m", "2")], "name string, version string")
    assert [r["version"] for r in rg.list_versions(versions, "m").collect()] == ["10", "9", "2"]
    a = spark.createDataFrame([("r1", datetime(2020, 1, 1), 0.1)], "run_id string, start_time timestamp, score_psi double")
    b = spark.createDataFrame([("r2", datetime(2021, 1, 1), 0.9)], "run_id string, start_time timestamp, auc double")
    runs = rg.union_runs([a, b])
    assert [r["run_id"] for r in runs.collect()] == ["r2", "r1"]
    assert [r["run_id"] for r in rg.metric_history(runs, "score_psi").collect()] == ["r1"]


def test_registered_versions_and_promotions(spark, tmp_path):
    root = str(tmp_path / "registry")
    assert rg.versions(spark, root).count() == 0 and rg.champion(rg.promotions(spark, root), "m").count() == 0
    made = [rg.register_version(spark, root, "m", {"auc": 0.5 + k / 10}, f"/models/{k}") for k in range(11)]
    assert made == [str(k + 1) for k in range(11)] and rg.register_version(spark, root, "other", {}, "/x") == "1"
    assert [r["version"] for r in rg.list_versions(rg.versions(spark, root), "m").collect()][:2] == ["11", "10"]
    for v in ("3", "11", "2"):
        rg.promote(spark, root, "m", v)
    assert rg.champion(rg.promotions(spark, root), "m").first()["version"] == "2"
    with pytest.raises(ValueError):
        rg.promote(spark, root, "m", "99")


def test_monitor_run_statuses(spark, tmp_path):
    old = spark.createDataFrame([(float(i % 40),) for i in range(400)], "x double")
    same, moved, none = old, old.selectExpr("x + 25 x"), old.where("x < 0")
    path = str(tmp_path / "runs")
    for run_id, ref, new in (("a", old, same), ("b", old, moved), ("c", old, none), ("d", none, old), ("b", old, moved)):
        runs = rg.monitor_run(ref, new, "x", path, run_id)
    assert {r["run_id"]: (r["status"], r["n_rows"]) for r in runs.collect()} == {"a": (0, 400), "b": (1, 400), "c": (2, 0), "d": (2, 400)}


def test_time_series_folds_and_permutation(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(12)], "id long, t long")
    f = sp.time_series_folds(df, 3)
    c = {(r["fold"], r["role"]): r["n"] for r in f.groupBy("fold", "role").agg(F.count("*").alias("n")).collect()}
    assert c == {(0, "train"): 3, (0, "test"): 3, (1, "train"): 6, (1, "test"): 3, (2, "train"): 9, (2, "test"): 3}
    p = spark.createDataFrame([(i, float(i), float(-i)) for i in range(50)], "id long, a double, b double")
    q = sp.permute_columns(p, ["a"], seed=1)
    assert sorted(r["a"] for r in q.collect()) == [float(i) for i in range(50)]
    assert q.where("a != id").count() > 0 and q.where("b != -id").count() == 0


def test_streaming_tumbling_window(spark, tmp_path):
    from datetime import datetime, timedelta

    src = tmp_path / "src"
    base = datetime(2024, 1, 1)
    rows = [(i, base + timedelta(hours=i), i % 2, 1.0) for i in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double").coalesce(1).write.parquet(str(src))
    ev = sj.file_stream(spark, str(src), "*.parquet")
    out = str(tmp_path / "out")
    sj.stream_velocity_tumbling(ev, "ts", "user_id", "value", "1 day", "1 hour", out, str(tmp_path / "chk"))
    got = spark.read.parquet(out)
    # events span 2.5 days; only windows closed by the watermark are emitted
    assert got.agg(F.sum("n_events")).first()[0] == 48


def _event_files(spark, folder, batches):
    """One Parquet file per batch, read in this order (by modification time)."""
    import glob
    import os
    import shutil

    (folder / "flat").mkdir()
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "id long, card long, t long, amount double").coalesce(1).write.parquet(str(folder / f"b{n}"))
        (part,) = glob.glob(str(folder / f"b{n}" / "*.parquet"))
        to = str(folder / "flat" / f"part-{n}.parquet")
        shutil.copy(part, to)
        os.utime(to, (1_700_000_000 + n, 1_700_000_000 + n))
    return sj.file_stream(spark, str(folder / "flat"), "*.parquet", max_files=1)


@pytest.mark.parametrize("later_first", [False, True])
def test_streaming_exact_velocity_across_batches(spark, tmp_path, later_first):
    from riskspark.operators import features as fe

    rows = [(i, i % 3, 1 + i * 700 + (i % 5) * 11, float(i % 7)) for i in range(120)]
    early, late = [r for r in rows if r[2] < 40_000], [r for r in rows if r[2] >= 40_000]
    batches = [late, early] if later_first else [early, late]
    delay = 50_000 if later_first else 600
    # one last event moves the watermark over all others
    batches.append([(999, 7, 400_000, 1.0)])
    ev = _event_files(spark, tmp_path, batches)
    out = str(tmp_path / "out")
    sj.stream_velocity_exact(ev, "card", "t", "id", "amount", {"w": 3000}, out, str(tmp_path / "chk"), delay=f"{delay} seconds")
    got = {r["id"]: (r["card_txn_count_w"], r["card_amt_sum_w"]) for r in spark.read.parquet(out).collect()}
    want = {r["id"]: (r["card_txn_count_w"], r["card_amt_sum_w"])
            for r in fe.add_velocity_features(spark.createDataFrame(rows, "id long, card long, t long, amount double"), windows_seconds={"w": 3000}).collect()}
    assert got == want


def test_closing_row_brings_out_what_the_watermark_holds(spark, tmp_path):
    from datetime import datetime, timedelta

    folder, base = str(tmp_path / "in"), datetime(2024, 1, 1)
    rows = [(i, base + timedelta(minutes=37 * i), i % 4, float(i % 5) if i % 6 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double")
    sj.feed(df, folder, F.floor(F.col("event_id") / 70), 3)
    sj.close(spark, folder, "ts", "1 hour", user_id=0)
    tumbling, exact = str(tmp_path / "tumbling"), str(tmp_path / "exact")
    stream = lambda: sj.file_stream(spark, folder, "*.parquet", max_files=2)
    sj.stream_velocity_tumbling(stream(), "ts", "user_id", "value", "1 day", "1 hour", tumbling, str(tmp_path / "c1"))
    assert spark.read.parquet(tumbling).agg(F.sum("n_events"), F.sum("amount_sum")).first() == df.agg(F.count("value"), F.sum("value")).first()
    ev = stream().select(F.col("event_id").alias("id"), F.col("user_id").alias("card"), F.unix_timestamp("ts").alias("t"), F.col("value").alias("amount"))
    sj.stream_velocity_exact(ev, "card", "t", "id", "amount", {"h": 7200}, exact, str(tmp_path / "c2"))
    got = spark.read.parquet(exact)
    assert sorted(r["id"] for r in got.collect()) == list(range(200))


def test_window_totals_equal_plain_sums():
    import numpy as np

    rng = np.random.default_rng(4)
    for d in (1, 7, 50):
        t = np.sort(rng.integers(0, 200, 90))
        amount = np.where(rng.random(90) < 0.2, np.nan, rng.integers(-9, 9, 90) * 1.0)
        count, total = sj.window_totals(t, amount, d)
        for i in range(90):
            seen = [a for s, a in zip(t[: i + 1], amount[: i + 1]) if s > t[i] - d and not np.isnan(a)]
            assert count[i] == len(seen) and (total[i] == sum(seen) if seen else np.isnan(total[i]))
    count, total = sj.window_totals(np.array([0, 7200, 7300]), np.array([1e17, 1.5, 2.5]), 3600)
    assert total.tolist() == [1e17, 1.5, 4.0]
    assert sj.window_totals(np.array([0, 10, 20]), np.array([np.inf, 1.0, 2.0]), 15)[1].tolist() == [np.inf, np.inf, 3.0]


def _card(train, model):
    from riskspark.operators import registry as rg
    from riskspark.operators import scorecard as sc
    from riskspark.operators import woe as wo

    coefs, intercept = wo.naive_bayes_scorecard(model, train)
    base, points = wo.points_table(model, coefs, intercept)
    scores = wo.score(train, model, base, points, model.features()).select("score")
    return sc.Scorecard(model, base, points, 520.0, 480.0, rg.PsiReference(scores, "score"))


def test_published_scorecard_scores_decides_and_monitors_alike(spark, tmp_path):
    from riskspark.operators import registry as rg
    from riskspark.operators import scorecard as sc
    from riskspark.operators import woe as wo

    rows = [(i, float(i % 10) if i % 11 else None, "xyz"[i % 3], int(i % 10 > 6 or i % 7 == 0)) for i in range(300)]
    train = spark.createDataFrame(rows, "id long, x double, c string, target int")
    card = _card(train, wo.fit_woe_bins(train, ["x"], ["c"], "target", special_values={"x": [3.0]}))
    root = str(tmp_path / "registry")
    with pytest.raises(ValueError, match="promoted"):
        sc.champion(spark, root, "card")
    assert sc.publish(spark, root, "card", card, {"auc": 0.7}) == "1"
    version, again = sc.champion(spark, root, "card")
    new = spark.createDataFrame([(1, 3.0, "x"), (2, None, "unseen"), (3, 99.0, None), (4, -5.0, "z")], "id long, x double, c string")
    key = lambda df: sorted((r["id"], r["score"], r["decision"]) for r in df.collect())
    assert version == "1" and key(again.decide(new)) == key(card.decide(new))
    assert (again.approve, again.decline, again.base_points) == (520.0, 480.0, card.base_points)
    batch = card.score(train.where("id % 2 = 0"))
    runs = [rg.monitor_run(c.reference, batch, "score", str(tmp_path / f"runs{k}"), "r").first() for k, c in enumerate((card, again))]
    assert runs[0] == runs[1] and runs[0]["status"] in (0, 1)
    empty = rg.monitor_run(again.reference, batch.limit(0), "score", str(tmp_path / "none"), "r").first()
    assert (empty["n_rows"], empty["status"]) == (0, 2)
    with pytest.raises(Exception, match="(?i)exist"):
        sc.save(spark, card, rg.versions(spark, root).first()["model_path"])


def test_two_writers_do_not_replace_each_other(spark, tmp_path, monkeypatch):
    from riskspark.operators import registry as rg

    root = str(tmp_path)
    none = rg.versions(spark, root)
    assert rg.register_version(spark, root, "m", {"a": 1.0}, "/x") == "1"
    monkeypatch.setattr(rg, "versions", lambda *_: none)  # a writer that has looked before
    with pytest.raises(FileExistsError):
        rg.register_version(spark, root, "m", {"a": 2.0}, "/y")
    monkeypatch.undo()
    assert rg.versions(spark, root).first()["metrics"] == {"a": 1.0}


def test_champion_in_force_is_the_latest_before_the_run(spark, tmp_path):
    from riskspark.operators import registry as rg

    root = str(tmp_path)
    for name, ats in (("m", ["2020-01-01", "2021-01-01", "2021-01-01"]), ("n", ["2022-01-01"])):
        for k, at in enumerate(ats):
            rg.promote(spark, root, name, rg.register_version(spark, root, name, {}, "/x"), at=at)
    rg.promote(spark, root, "m", "1", at="2023-01-01")  # back to the first
    runs = spark.createDataFrame([(i, n, d) for n in "mno" for i, d in enumerate(["2019-06-01", "2020-01-01", "2021-06-01", "2024-01-01"])], "run int, name string, at string")
    got = {(r["name"], r["run"]): r["champion"] for r in rg.in_force(runs, rg.promotions(spark, root), "name", "at").collect()}
    assert got == {("m", 0): None, ("m", 1): "1", ("m", 2): "3", ("m", 3): "1", ("n", 0): None, ("n", 1): None, ("n", 2): None, ("n", 3): "1", **{("o", i): None for i in range(4)}}


def test_request_sent_again_in_a_later_file_is_decided_once(spark, tmp_path):
    from riskspark.operators import woe as wo

    train = spark.createDataFrame([(i, float(i % 10), int(i % 10 > 6 or i % 7 == 0)) for i in range(200)], "id long, x double, target int")
    model = wo.fit_woe_bins(train, ["x"], [], "target")
    card = _card(train, model)
    folder = str(tmp_path / "in")
    sent = spark.createDataFrame([(i, float(i % 10), 100 * i, f) for i in range(30) for f in ({0, 1, 2} if i % 5 == 0 else {i % 3})], "id long, x double, t long, file int")
    twice = sent.unionByName(sent.where("id = 5 and file = 0"))  # and in the same file
    sj.feed(twice, folder, F.col("file"), 3)
    requests = sj.file_stream(spark, folder, "*.parquet", max_files=3)
    log = sj.stream_score_audit(spark, requests, card, "id", "t", ["x"], str(tmp_path / "log"), str(tmp_path / "chk"))
    assert sorted(r["id"] for r in log.collect()) == list(range(30))
    assert log.select("batch_id").distinct().count() > 1


def test_stream_psi_retry_replaces_its_batch(spark, tmp_path):
    from riskspark.operators.registry import PsiReference, monitor_status

    old = spark.createDataFrame([(float(i % 23),) for i in range(300)], "x double")
    src = tmp_path / "src"
    spark.createDataFrame([(float(i % 9),) for i in range(80)], "x double").coalesce(1).write.parquet(str(src))
    for attempt in range(2):  # the second run is a retry that has lost its checkpoint
        runs = sj.stream_psi(spark, sj.file_stream(spark, str(src), "*.parquet"), old, "x", str(tmp_path / "runs"), str(tmp_path / f"chk{attempt}"))
        (row,) = runs.collect()
    b = spark.createDataFrame([(0, float(i % 9)) for i in range(80)], "b long, x double")
    want = monitor_status(PsiReference(old, "x").batches(b, "b")).first()
    assert (row["batch_id"], row["n_rows"]) == (0, 80) and abs(row["psi"] - want["psi"]) < 1e-12 and row["status"] == want["status"]


def test_sinks(spark, tmp_path):
    from riskspark.sources import sinks

    df = spark.createDataFrame([("a", "k", "m", 1.0), ("b", "k", "m", float("nan"))], "section string, key string, metric string, value double")
    sinks.write_table(df, str(tmp_path / "t"), partition_by=["section"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    sinks.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2
    sinks.write_report(df, str(tmp_path / "r"))
    vals = {r["section"]: r["value"] for r in spark.read.json(str(tmp_path / "r")).collect()}
    assert vals == {"a": 1.0, "b": None}


def test_feature_catalog_selects_numeric_and_bool(spark):
    from riskspark.plans.graph_plans import feature_catalog_df

    df = spark.createDataFrame([(1, 0, 2.5, "x", True, 7)], "id long, target int, amt double, cat string, flag boolean, n int")
    got = [(r["position"], r["column"]) for r in feature_catalog_df(df).collect()]
    assert got == [(2, "amt"), (4, "flag"), (5, "n")]
