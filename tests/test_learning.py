"""Search, continued boosting and labelling rounds on planted data."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import boosting as bo
from riskspark.operators import labelling as lb
from riskspark.operators import learners as le
from riskspark.operators import resample as rs
from riskspark.operators import search as se
from riskspark.operators.sampling import labels_to_target


def crossed(spark, n, seed=1, share=0.5):
    """label = 1 where a and b lie on different sides of 0.5: no single split helps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.random(), rng.random()
        y = int((a > 0.5) != (b > 0.5))
        if y and rng.random() > 2 * share:
            a = 1 - a
            y = 0
        rows.append((i, 10 * i, a, b if i % 9 else None, y))
    return spark.createDataFrame(rows, "id long, t long, a double, b double, label int")


def test_parameters_are_drawn_by_hash():
    space = {"maxDepth": (1, 2, 3), "stepSize": (0.1, 0.2)}
    assert se.sample_params(space, 5, 7) == se.sample_params(space, 5, 7)
    assert len({tuple(m.items()) for m in se.sample_params(space, 40, 7)}) == 6


def test_search_picks_the_family_that_can_learn_it(spark, monkeypatch):
    df = crossed(spark, 500, share=0.3).cache()
    bases = []
    real = rs.smote
    monkeypatch.setattr(rs, "smote", lambda rows, *a, **k: bases.append({r["id"] for r in rows.select("id").collect()}) or real(rows, *a, **k))
    space = {"maxDepth": (1, 3), "maxIter": (4,)}
    n = next(n for n in range(2, 20) if len({m["maxDepth"] for m in se.sample_params(space, n)}) == 2)
    found = se.random_search(df, ["a", "b"], space, n, n_folds=2).cache()
    assert found.count() == 2 * n and se.best(found)["maxDepth"] == 3
    assert len(bases) == 2  # once for each fold, not for each map
    rows = {r["fold"]: r for r in found.collect()}
    for k, seen in enumerate(sorted(bases, key=len)):
        assert max(seen) < rows[k]["n_train"]  # ids are in order of time: none of the test side
        train = df.where(F.col("id") < rows[k]["n_train"])
        ones = train.where("label = 1").count()
        assert rows[k]["n_synthetic"] == rows[k]["n_train"] - 2 * ones > 0


def test_folds_without_positives(spark):
    df = crossed(spark, 60).withColumn("label", F.lit(0))
    rows = se.random_search(df, ["a", "b"], {"regParam": (0.1,)}, 1, kind="logistic", n_folds=2).collect()
    assert [(r["n_synthetic"], r["auc_roc"]) for r in rows] == [(0, None)] * 2


@pytest.fixture(scope="module")
def source(spark):
    src = crossed(spark, 400, 2).cache()
    return src, le.fit_source(src, ["a", "b"], "label", "gbt", maxIter=4, maxDepth=3)


def test_zero_rounds_are_the_source_model(spark, source, tmp_path):
    from pyspark.ml.functions import vector_to_array

    src, bundle = source
    own = bo.Ensemble.of_gbt(bundle.model, bundle.features, bundle.medians)
    same = own.extend(src, "label", 0)
    assert same == own and own.trees == 4
    own.save(spark, str(tmp_path / "m"))
    again = bo.Ensemble.load(spark, str(tmp_path / "m"))
    assert again == own
    target = crossed(spark, 200, 3)
    filled = le.assemble(le.fill_medians(target, bundle.medians), bundle.features)
    pred = bundle.model.transform(filled).select("id", vector_to_array("probability")[1].alias("p"))
    both = again.score(target).join(pred, "id")
    assert both.agg(F.max(F.abs(F.col("score") - F.col("p")))).first()[0] < 1e-9
    assert target.where("b IS NULL").count() > 0  # the source's medians stand in


def test_more_rounds_fit_the_target_better(spark, source):
    _, bundle = source
    own = bo.Ensemble.of_gbt(bundle.model, bundle.features, bundle.medians)
    shifted = crossed(spark, 600, 4).withColumn("label", 1 - F.col("label"))  # the opposite of the source
    train, test = shifted.where("id < 400"), shifted.where("id >= 400")
    few, more = own.extend(train, "label", 3, step=0.5), own.extend(train, "label", 8, step=0.5)
    assert (few.trees, more.trees) == (7, 12) and more.rows[: len(own.rows)] == own.rows
    losses = [bo.log_loss(test, "label", m.margin()) for m in (own, few, more)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.5


def side(spark, n, seed):
    """One in ten is 1; x tells them, and most of the pool is far from the border."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = rng.gauss(0, 1) + (2.5 if i % 10 == 0 else 0)
        rows.append((seed * 100_000 + i, x, int(i % 10 == 0)))
    return spark.createDataFrame(rows, "id long, x double, label int")


@pytest.mark.parametrize("strategy", ["entropy", "margin", "random"])
def test_labelling_moves_rows_and_learns(spark, strategy):
    pool, seed, test = side(spark, 300, 1), side(spark, 40, 2), side(spark, 200, 3)
    curve, labelled, left = lb.simulate(pool, seed, test, ["x"], 30, 2, strategy)
    rows = curve.orderBy("round").collect()
    assert [(r["round"], r["n_labeled"], r["n_pool"]) for r in rows] == [(0, 40, 300), (1, 70, 270), (2, 100, 240)]
    assert rows[0]["n_positives"] == 4 and all(r["metric"] > 0.5 for r in rows)
    ids = lambda df: {r["id"] for r in df.select("id").collect()}
    assert ids(labelled) | ids(left) == ids(pool) | ids(seed) and not ids(labelled) & ids(left)
    if strategy == "entropy":
        middle = labelled.join(pool, "id").agg(F.avg(pool["label"])).first()[0]
        assert middle > 0.15  # the border between the classes is asked about
    assert labels_to_target(curve, 0.5).first()[0] == 40


def test_labelling_without_positives_or_pool(spark):
    one = side(spark, 40, 1).where("label = 0")
    curve, _, left = lb.simulate(one, one.withColumn("id", -F.col("id") - 1), side(spark, 30, 2), ["x"], 25, 5)
    assert [r["metric"] for r in curve.collect()] == [None] * 3 and left.count() == 0
    with pytest.raises(ValueError):
        lb.simulate(one, one, one, ["x"], 0, 1)


def test_fold_sides_are_read_and_medians_made_once(spark, monkeypatch):
    """no side of a fold is a filter over all rows of all folds."""
    seen, real = [], le.fit_medians
    monkeypatch.setattr(le, "fit_medians", lambda rows, columns: seen.append(rows._jdf.queryExecution().executedPlan().toString()) or real(rows, columns))
    found = se.random_search(crossed(spark, 300, share=0.3), ["a", "b"], {"maxIter": (2,)}, 1, n_folds=2)
    assert found.count() == 2 and len(seen) == 2
    for k, plan in enumerate(seen):
        assert "Exchange" not in plan and "ExistingRDD" not in plan
        assert "PartitionFilters: [isnotnull(fold" in plan, (k, plan)


def test_large_fits_run_one_after_another():
    """four fits of 20 million rows at once do not fit in memory."""
    assert se._at_once([1000, 2000], 4) == 4 and se._at_once([], 4) == 4
    assert se._at_once([5_000_000, 7_000_000], 4) == 2 and se._at_once([20_000_000, 1000], 4) == 1
