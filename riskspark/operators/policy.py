"""PF2-PF6: decision policies over whole tables.

Thresholds are validated on the driver before the plan is built (PF4); the
decision is a ``when`` chain inside codegen (PF2, PF3); thresholds come
from the F1-optimal point (PF5) or train-score percentiles (PF6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import points_decision, probability_decision
from .metrics import f1_threshold
from .quantiles import quantile_columns


def validate_thresholds(review: float, decline: float) -> None:
    """PF4 (probability policy): both in [0, 1], review strictly below
    decline."""
    if not (0.0 <= review < decline <= 1.0):
        raise ValueError(f"thresholds need 0 <= review < decline <= 1; given {review} and {decline}")


def validate_cutoffs(approve: float, decline: float) -> None:
    """PF4 (points policy): approve strictly above decline."""
    if not decline < approve:
        raise ValueError(f"cut-offs need decline < approve; given {decline} and {approve}")


def decide_probability(df: DataFrame, review: float, decline: float, p: str = "score", out: str = "decision") -> DataFrame:
    """PF2: probabilities outside [0, 1] are counted in one aggregate and
    raised once; otherwise decline / review / approve."""
    validate_thresholds(review, decline)
    bad = df.agg(F.count_if((F.col(p) < 0) | (F.col(p) > 1) | F.col(p).isNull() | F.isnan(F.col(p).cast("double"))).alias("b")).first()["b"]
    if bad:
        raise ValueError(f"{bad} rows have no probability in 0..1")
    return df.withColumn(out, probability_decision(p, review, decline))


def decide_points(df: DataFrame, approve: float, decline: float, score: str = "score", out: str = "decision") -> DataFrame:
    """PF3: higher points are safer."""
    validate_cutoffs(approve, decline)
    return df.withColumn(out, points_decision(score, approve, decline))


def thresholds_from_f1(scored: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """PF5: review = F1-optimal threshold; decline = review + (1 - review)/2."""
    f = f1_threshold(scored, y, score)
    return f.select(
        F.col("threshold").alias("review_threshold"), (F.col("threshold") + (1 - F.col("threshold")) / 2).alias("decline_threshold")
    )


def cutoffs_from_scores(train_scores: DataFrame, score: str = "score", approve_q: float = 0.6, decline_q: float = 0.2) -> DataFrame:
    """PF6: approve / decline cut-offs = 60th / 20th (linear) percentile of
    the train scores, exact and distributed."""
    return quantile_columns(train_scores, score, [approve_q, decline_q], ["approve_cutoff", "decline_cutoff"])
