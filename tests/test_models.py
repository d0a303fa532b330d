"""Fitted values of the learners on planted data."""

import random

import pytest

from riskspark.operators import learners as le
from riskspark.plans.model_plans import metrics_of


@pytest.fixture(scope="module")
def sides(spark):
    """label = 1 above 0.5 of ``signal`` with one in twenty flipped; ``noise`` says nothing."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        x = rng.random()
        rows.append((i, x, rng.random(), int((x > 0.5) != (rng.random() < 0.05))))
    df = spark.createDataFrame(rows, "id long, signal double, noise double, label int").cache()
    return df.where("id < 400"), df.where("id >= 400")


@pytest.mark.parametrize("kind,params", [("logistic", {}), ("tree", {}), ("forest", {}), ("gbt", {"maxIter": 5, "maxDepth": 3})])
def test_learners_find_the_planted_signal(sides, kind, params):
    _, pred = le.fit_and_score(*sides, ["signal", "noise"], "label", kind, **params)
    r = metrics_of(pred, kind).first()
    assert r.model == kind and r.n == 200 and r.auc_roc > 0.85 and r.ks_statistic > 0.75 and r.average_precision > 0.8
    _, blind = le.fit_and_score(*sides, ["noise"], "label", kind, **params)
    assert metrics_of(blind, kind).first().auc_roc < 0.65


def test_scorecard_coefficients_have_the_planted_signs(sides):
    train = sides[0].selectExpr("id", "label", "signal - 0.5 AS up", "0.5 - signal + noise * 0.1 AS down", "noise")
    one, _ = le.fit_scorecard_lr(train, ["up", "noise"], "label")
    other, _ = le.fit_scorecard_lr(train, ["down", "noise"], "label")
    assert one["up"] > 1 and other["down"] < -1 and abs(one["noise"]) < one["up"] / 3
