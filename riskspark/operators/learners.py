"""ML1-ML8, W8, UP1-UP2, TL1-TL4: fitted transforms and MLlib learners.

Median imputation and standardisation are exact and fitted on train only
(ML1: exact distributed median; ``ml.Imputer`` uses an approximate
quantile.  ML2: population std, as the reference's scaler; ``ml``'s uses
the sample std).  Learners are MLlib estimators - distributed fits - and
their results are checked by ranges, not by an oracle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from .profile import numeric_columns
from .quantiles import column_medians


def fit_medians(fit_df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact train medians of all columns (the driver gets a few numbers per
    column)."""
    return column_medians(fit_df, columns)


def impute_median(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """ML1: NULL/NaN -> train median (a column with no train values is left
    as is)."""
    return fill_medians(df, fit_medians(fit_df if fit_df is not None else df, columns))


def fill_medians(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Columns of ``medians`` as double, missing values replaced."""
    clean = {c: number(F.col(c).cast("double")) for c in medians}
    return df.withColumns({c: F.coalesce(v, F.lit(medians[c])) if medians[c] is not None else v for c, v in clean.items()})


def fit_standardizer(fit_df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    r = fit_df.agg(*[x for c in columns for x in (F.avg(number(c)).alias(f"m_{c}"), F.stddev_pop(number(c)).alias(f"s_{c}"))]).first()
    out = {}
    for c in columns:
        s = r[f"s_{c}"]
        out[c] = (r[f"m_{c}"] or 0.0, s if s else 1.0)
    return out


def standardize(df: DataFrame, scaler: dict[str, tuple[float, float]], columns: Sequence[str]) -> DataFrame:
    """ML2: (x - train mean) / train population std; zero std -> 1."""
    out = df
    for c in columns:
        m, s = scaler[c]
        out = out.withColumn(c, (F.col(c) - F.lit(m)) / F.lit(s))
    return out


# ---------------------------------------------------------------------------
# MLlib learners (distributed fits); checked by ranges, not by an oracle
# ---------------------------------------------------------------------------

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def make_classifier(kind: str, label: str = "label", seed: int = 42, **params):
    """ML3/ML5: 'logistic', 'tree', 'forest' (100 trees), 'gbt'."""
    from pyspark.ml import classification as C

    if kind == "logistic":
        return C.LogisticRegression(featuresCol="features", labelCol=label, maxIter=params.get("maxIter", 100), regParam=params.get("regParam", 0.0))
    if kind == "tree":
        return C.DecisionTreeClassifier(featuresCol="features", labelCol=label, seed=seed, maxDepth=params.get("maxDepth", 5))
    if kind == "forest":
        return C.RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=params.get("numTrees", 100), seed=seed)
    if kind == "gbt":
        return C.GBTClassifier(
            featuresCol="features", labelCol=label, seed=seed, maxIter=params.get("maxIter", 20),
            maxDepth=params.get("maxDepth", 3), stepSize=params.get("stepSize", 0.1),
            subsamplingRate=params.get("subsamplingRate", 1.0), minInstancesPerNode=params.get("minInstancesPerNode", 1),
        )
    raise ValueError(f"unknown classifier {kind!r}")


def positive_probability(pred: DataFrame, out: str = "score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return pred.withColumn(out, vector_to_array("probability")[1])


def fit_and_score(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, kind: str, **params):
    """Impute (train medians) -> assemble -> fit -> P(label = 1) on test."""
    from ..session import cut_lineage

    med = fit_medians(train, features)
    med_train, med_test = fill_medians(train, med), fill_medians(test, med)
    # the fit reads the label and the vector, so no other column is written
    fit_in = cut_lineage(assemble(med_train.withColumn(label, F.col(label).cast("double")), features).select(label, "features"))
    model = make_classifier(kind, label, **params).fit(fit_in)
    pred = cut_lineage(positive_probability(model.transform(assemble(med_test, features))).drop("features", "rawPrediction", "probability"))
    return model, pred


def evaluate(pred: DataFrame, label: str, id_col: str) -> DataFrame:
    """MT7 record for a prediction frame."""
    from .metrics import metric_record

    return metric_record(pred.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), "score"))


def fit_scorecard_lr(train_woe: DataFrame, woe_cols: Sequence[str], target: str):
    """L2 logistic regression on WoE columns; C = 1 in the reference's
    library equals regParam = 1/n without standardisation here."""
    from pyspark.ml.classification import LogisticRegression

    n = train_woe.count()
    lr = LogisticRegression(featuresCol="features", labelCol=target, regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=200)
    m = lr.fit(assemble(train_woe.withColumn(target, F.col(target).cast("double")), woe_cols))
    return {c: float(v) for c, v in zip(woe_cols, m.coefficients.toArray())}, float(m.intercept)


@dataclass(frozen=True)
class SourceBundle:
    """TL1: what a source domain hands to a target domain: its feature list,
    its medians and its fitted model."""

    features: tuple[str, ...]
    medians: dict[str, float | None]
    model: object

    def require(self, df: DataFrame) -> None:
        """TL5: the target must have every feature, and as a number."""
        numeric = set(numeric_columns(df))
        absent = [c for c in self.features if c not in df.columns]
        other = [c for c in self.features if c in df.columns and c not in numeric]
        if absent or other:
            raise ValueError(f"the target domain lacks features {absent} and has no numbers in {other}")

    def margin(self, df: DataFrame, out: str = "__margin") -> DataFrame:
        """``df`` with the source model's log-odds; the source medians fill gaps."""
        from pyspark.ml.functions import vector_to_array

        self.require(df)
        scored = self.model.transform(assemble(fill_medians(df, self.medians), self.features))
        return scored.withColumn(out, vector_to_array("rawPrediction")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit_source(df: DataFrame, features: Sequence[str], label: str, kind: str = "logistic", **params) -> SourceBundle:
    medians = fit_medians(df, features)
    rows = fill_medians(df, medians).withColumn(label, F.col(label).cast("double"))
    return SourceBundle(tuple(features), medians, make_classifier(kind, label, **params).fit(assemble(rows, features)))
