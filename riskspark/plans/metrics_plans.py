"""Queries for ranking metrics (MT1-MT7) on scored `orders` and on the
heavily tied `lineitem` discount score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..sources.tables import SCORED_ROWS_SQL, TIED_SCORED_ROWS_SQL, bind_scored_rows, bind_tied_scored_rows
from .registry import register


def r9(c, name=None):
    return F.round(F.col(c).cast("double"), 9).alias(name or c)


def _hist_sql(src):
    return f"""
WITH s AS ({src}),
h AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY score)"""


def auc_sql(src):
    return _hist_sql(src) + """,
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM h)
SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS auc_roc FROM c"""


def gini_sql(src):
    return _hist_sql(src) + """,
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM h)
SELECT round(2.0 * (sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg))) - 1.0, 9) AS gini FROM c"""


def curve_sql(src):
    return _hist_sql(src) + """,
c AS (SELECT score, pos,
             sum(pos) OVER (ORDER BY score DESC) AS tp,
             sum(pos + neg) OVER (ORDER BY score DESC) AS pp,
             sum(pos) OVER () AS P FROM h),
pr AS (SELECT score AS threshold, pos, tp, pp, P, tp / pp AS precision, tp / P AS recall FROM c)"""


def ap_sql(src):
    return curve_sql(src) + """
SELECT round(sum(pos * precision) / max(P), 9) AS average_precision FROM pr"""


def prc_sql(src):
    return curve_sql(src) + """
SELECT round(threshold, 9) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(pp AS BIGINT) AS pp,
       round(precision, 9) AS precision, round(recall, 9) AS recall FROM pr"""


def f1_sql(src):
    return curve_sql(src) + """,
f AS (SELECT threshold, precision, recall,
             CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr)
SELECT round(threshold, 9) AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1
FROM f ORDER BY f1 DESC, threshold ASC LIMIT 1"""


def ks_sql(src):
    return f"""
WITH s AS ({src}),
c AS (SELECT score, id,
             sum(y) OVER (ORDER BY score DESC, id ASC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
             sum(1 - y) OVER (ORDER BY score DESC, id ASC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
             sum(y) OVER () AS P, sum(1 - y) OVER () AS N FROM s),
g AS (SELECT score, id, abs(cp / P - cn / N) AS gap FROM c)
SELECT round(gap, 9) AS ks_statistic, round(score, 9) AS ks_threshold FROM g ORDER BY gap DESC, score DESC, id ASC LIMIT 1"""


def record_sql(src):
    return f"""
SELECT CAST((SELECT count(*) FROM ({src})) AS BIGINT) AS n,
       CAST((SELECT sum(y) FROM ({src})) AS BIGINT) AS positives,
       a.auc_roc, g.gini, p.average_precision, k.ks_statistic, k.ks_threshold,
       f.threshold AS f1_threshold, f.precision AS f1_precision, f.recall AS f1_recall, f.f1
FROM ({auc_sql(src)}) a, ({gini_sql(src)}) g, ({ap_sql(src)}) p, ({ks_sql(src)}) k, ({f1_sql(src)}) f"""


@register("metric_auc_roc", auc_sql(SCORED_ROWS_SQL))
def metric_auc_roc(spark, sf_dir):
    return mt.auc_roc(bind_scored_rows(spark, sf_dir)).select(r9("auc_roc"))


@register("metric_gini", gini_sql(SCORED_ROWS_SQL))
def metric_gini(spark, sf_dir):
    return mt.gini(bind_scored_rows(spark, sf_dir)).select(r9("gini"))


@register("metric_average_precision", ap_sql(SCORED_ROWS_SQL))
def metric_average_precision(spark, sf_dir):
    return mt.average_precision(bind_scored_rows(spark, sf_dir)).select(r9("average_precision"))


@register("metric_pr_curve", prc_sql(SCORED_ROWS_SQL))
def metric_pr_curve(spark, sf_dir):
    c = mt.pr_curve(bind_scored_rows(spark, sf_dir))
    return c.select(r9("threshold"), "tp", "pp", r9("precision"), r9("recall"))


@register("metric_f1_threshold", f1_sql(SCORED_ROWS_SQL))
def metric_f1_threshold(spark, sf_dir):
    return mt.f1_threshold(bind_scored_rows(spark, sf_dir)).select(r9("threshold"), r9("precision"), r9("recall"), r9("f1"))


@register("metric_ks", ks_sql(TIED_SCORED_ROWS_SQL))
def metric_ks(spark, sf_dir):
    """KS on the tied lineitem score (row mode, ties in id order)."""
    k = mt.ks_statistic(bind_tied_scored_rows(spark, sf_dir))
    return k.select(r9("ks_statistic"), r9("ks_threshold"))


def _record(df):
    r = mt.metric_record(df)
    return r.select(
        "n", "positives", r9("auc_roc"), r9("gini"), r9("average_precision"), r9("ks_statistic"), r9("ks_threshold"),
        r9("f1_threshold"), r9("f1_precision"), r9("f1_recall"), r9("f1"),
    )


@register("metric_record", record_sql(SCORED_ROWS_SQL))
def metric_record(spark, sf_dir):
    return _record(bind_scored_rows(spark, sf_dir))


@register("metric_record_ties", record_sql(TIED_SCORED_ROWS_SQL))
def metric_record_ties(spark, sf_dir):
    return _record(bind_tied_scored_rows(spark, sf_dir))
