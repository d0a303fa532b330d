"""UP1-UP2: S- and T-learner with any MLlib probabilistic classifier.

``estimator`` reads ``features`` and the outcome column as label; a learner
fits copies of it, so the same settings serve both arms.  Medians are fitted on
the train side.  The result is the test frame with ``uplift``, the difference
of the predicted response rates with and without treatment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learners import assemble, fill_medians, fit_medians, positive_probability


def _fit(estimator: Estimator, rows: DataFrame, features: Sequence[str], outcome: str):
    labelled = assemble(rows.withColumn(outcome, F.col(outcome).cast("double")), features)
    return estimator.copy({estimator.labelCol: outcome, estimator.featuresCol: "features"}).fit(labelled)


def _predict(model, rows: DataFrame, features: Sequence[str], out: str) -> DataFrame:
    scored = positive_probability(model.transform(assemble(rows, features)), out)
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def s_learner(train: DataFrame, test: DataFrame, features: Sequence[str], estimator: Estimator, outcome: str = "outcome", treatment: str = "treatment") -> DataFrame:
    """UP1: one model with the treatment among its features."""
    medians = fit_medians(train, features)
    columns = [*features, treatment]
    model = _fit(estimator, fill_medians(train, medians), columns, outcome)
    given = fill_medians(test, medians).withColumn("_given", F.col(treatment))
    treated = _predict(model, given.withColumn(treatment, F.lit(1)), columns, "_p1")
    both = _predict(model, treated.withColumn(treatment, F.lit(0)), columns, "_p0")
    return both.withColumn(treatment, F.col("_given")).withColumn("uplift", F.col("_p1") - F.col("_p0")).drop("_given", "_p1", "_p0")


def t_learner(train: DataFrame, test: DataFrame, features: Sequence[str], estimator: Estimator, outcome: str = "outcome", treatment: str = "treatment") -> DataFrame:
    """UP2: one model per arm; each arm has its own medians."""
    out = test
    for arm in (1, 0):
        rows = train.where(F.col(treatment) == arm)
        medians = fit_medians(rows, features)
        model = _fit(estimator, fill_medians(rows, medians), features, outcome)
        filled = out.withColumns({f"_raw_{c}": F.col(c) for c in features})
        scored = _predict(model, fill_medians(filled, medians), features, f"_p{arm}")
        out = scored.withColumns({c: F.col(f"_raw_{c}") for c in features}).drop(*[f"_raw_{c}" for c in features])
    return out.withColumn("uplift", F.col("_p1") - F.col("_p0")).drop("_p1", "_p0")
