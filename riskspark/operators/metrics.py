"""MT1-MT7: exact ranking metrics on (y, score[, id]).

Everything reduces to a histogram per distinct score (one partially
aggregated shuffle) followed by a distributed running sum over scores
(``ordering.prefix_sum``), so no step collects scores to the driver or runs
in a single task.  KS in row mode (tie order by id, as the reference's
stable sort) runs the running sum over rows keyed (score desc, id), where
the composite bucket edges split a hot tied score across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import prefix_sum
from .profile import validate_binary


def score_histogram(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(y)).cast("long").alias("pos"),
        (F.count(F.lit(1)) - F.sum(F.col(y))).cast("long").alias("neg"),
    )


def score_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """One running sum over distinct scores, highest first: per score the
    positives/negatives at it (pos, neg), at or above it (tp, pp, cn) and
    the totals (P, N).  Every histogram metric derives from this table."""
    h = score_histogram(df, y, score)
    c = prefix_sum(h, [("score", False)], {"tp": F.col("pos"), "pp": F.col("pos") + F.col("neg"), "cn": F.col("neg")})
    tot = h.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))  # one row, broadcast
    return c.crossJoin(F.broadcast(tot))


def auc_from_curve(c: DataFrame) -> DataFrame:
    """Ties count one half: sum pos * (negatives below + neg / 2) / (P N),
    with negatives below = N - cn."""
    nb = F.col("N") - F.col("cn")
    return c.agg((F.sum(F.col("pos") * (nb + 0.5 * F.col("neg"))) / (F.max("P") * F.max("N"))).alias("auc_roc"))


def pr_from_curve(c: DataFrame) -> DataFrame:
    return c.select(
        F.col("score").alias("threshold"),
        "pos",
        "tp",
        "pp",
        F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0).alias("precision"),
        F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(1.0).alias("recall"),
        F.col("P").alias("__P"),
    )


def ap_from_curve(c: DataFrame) -> DataFrame:
    pr = pr_from_curve(c)
    return pr.agg((F.sum(F.col("pos") * F.col("precision")) / F.max("__P")).alias("average_precision"))


def f1_from_curve(c: DataFrame) -> DataFrame:
    pr = pr_from_curve(c)
    p, r = F.col("precision"), F.col("recall")
    pr = pr.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
    return pr.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1).select("threshold", "precision", "recall", "f1")


def auc_roc(df: DataFrame, y: str = "y", score: str = "score", validate: bool = True) -> DataFrame:
    """MT1: one row (auc_roc); ties count one half."""
    if validate:
        validate_binary(df, y)
    return auc_from_curve(score_curve(df, y, score))


def gini(df: DataFrame, y: str = "y", score: str = "score", validate: bool = True) -> DataFrame:
    """MT2: 2 * AUC - 1."""
    return auc_roc(df, y, score, validate).select((2.0 * F.col("auc_roc") - 1.0).alias("gini"))


def pr_curve(df: DataFrame, y: str = "y", score: str = "score", validate: bool = True) -> DataFrame:
    """MT5: (threshold, tp, pp, precision, recall) at every distinct score;
    predicted positive means score >= threshold."""
    if validate:
        validate_binary(df, y)
    return pr_from_curve(score_curve(df, y, score))


def average_precision(df: DataFrame, y: str = "y", score: str = "score", validate: bool = True) -> DataFrame:
    """MT3: sum over distinct thresholds (descending) of delta-recall x
    precision (step rule, not trapezoid)."""
    if validate:
        validate_binary(df, y)
    return ap_from_curve(score_curve(df, y, score))


def f1_threshold(df: DataFrame, y: str = "y", score: str = "score", validate: bool = True) -> DataFrame:
    """MT6: threshold with the highest F1 (lowest threshold on ties; F1 = 0
    where precision + recall = 0)."""
    if validate:
        validate_binary(df, y)
    return f1_from_curve(score_curve(df, y, score))


def ks_statistic(
    df: DataFrame, y: str = "y", score: str = "score", id_col: str = "id", ties: str = "row", validate: bool = True
) -> DataFrame:
    """MT4: max |cum positive share - cum negative share| going down the
    scores; threshold = score at the first maximum.

    ``ties='row'`` walks rows in (score desc, id) order like the
    reference's stable sort; ``ties='group'`` evaluates only at the end of
    each tied score (order-free)."""
    if validate:
        validate_binary(df, y)
    if ties == "group":
        base = score_histogram(df, y, score)
        c = prefix_sum(base, [("score", False)], {"cp": F.col("pos"), "cn": F.col("neg")})
        order_tie = [F.col("score").desc()]
    elif ties == "row":
        base = df.select(F.col(score).cast("double").alias("score"), F.col(id_col).alias("__id"), F.col(y).cast("long").alias("__y"))
        c = prefix_sum(base, [("score", False), ("__id", True)], {"cp": F.col("__y"), "cn": 1 - F.col("__y")})
        order_tie = [F.col("score").desc(), F.col("__id").asc()]
    else:
        raise ValueError("ties must be 'row' or 'group'")
    tot = c.agg(F.max("cp").alias("__P"), F.max("cn").alias("__N"))
    g = c.crossJoin(F.broadcast(tot)).withColumn("gap", F.abs(F.col("cp") / F.col("__P") - F.col("cn") / F.col("__N")))
    best = g.orderBy(F.col("gap").desc(), *order_tie).limit(1)
    return best.select(F.col("gap").alias("ks_statistic"), F.col("score").alias("ks_threshold"))


def metric_record(df: DataFrame, y: str = "y", score: str = "score", id_col: str = "id") -> DataFrame:
    """MT7: one row with n, positives and every metric.  The score curve is
    built once and checkpointed (at most one row per distinct score), so
    AUC, Gini, AP and F1 share one histogram shuffle."""
    from ..session import cut_lineage

    counts = validate_binary(df, y)
    n = counts["positives"] + counts["negatives"]
    base = df.sparkSession.createDataFrame([(n, counts["positives"])], "n long, positives long")
    curve = cut_lineage(score_curve(df, y, score))
    auc = auc_from_curve(curve)
    parts = [
        auc,
        auc.select((2.0 * F.col("auc_roc") - 1.0).alias("gini")),
        ap_from_curve(curve),
        ks_statistic(df, y, score, id_col, "row", False),
        f1_from_curve(curve).select(
            F.col("threshold").alias("f1_threshold"), F.col("precision").alias("f1_precision"),
            F.col("recall").alias("f1_recall"), "f1",
        ),
    ]
    out = base
    for p in parts:
        out = out.crossJoin(p)
    return out
