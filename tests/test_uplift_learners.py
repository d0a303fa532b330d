"""S- and T-learner with a given estimator on an effect that varies with x."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier

from riskspark.operators.uplift_learners import s_learner, t_learner


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(2)
    rows = []
    for i in range(4000):
        x, t = rng.random(), rng.randrange(2)
        # treatment helps above x = 0.5 and harms below
        rows.append((i, None if i % 50 == 0 else x, t, int(rng.random() < 0.5 + 0.3 * t * (1 if x > 0.5 else -1))))
    df = spark.createDataFrame(rows, "id long, x double, treatment int, outcome int")
    return df.where("id % 2 = 0"), df.where("id % 2 = 1")


@pytest.mark.parametrize("learner", [s_learner, t_learner])
def test_effects_that_vary(sides, learner):
    train, test = sides
    found = learner(train, test, ["x"], DecisionTreeClassifier(maxDepth=3, seed=1)).collect()
    assert len(found) == test.count() and {r["treatment"] for r in found} == {0, 1}
    high = [r["uplift"] for r in found if r["x"] is not None and r["x"] > 0.6]
    low = [r["uplift"] for r in found if r["x"] is not None and r["x"] < 0.4]
    assert sum(high) / len(high) > 0.15 and sum(low) / len(low) < -0.15
