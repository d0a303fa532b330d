"""Queries for uplift evaluation (UP3-UP5, UP7) on the campaign role."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import uplift as up
from ..sources.tables import CAMPAIGN_SQL, bind_campaign, epoch_seconds, table
from .registry import register


def r9(c):
    return F.round(F.col(c).cast("double"), 9).alias(c)


def _curve_sql(score_expr="score"):
    return f"""
c AS (SELECT id, row_number() OVER w AS rank,
             sum(treatment) OVER w AS nt, sum(1 - treatment) OVER w AS nc,
             sum(treatment * outcome) OVER w AS yt, sum((1 - treatment) * outcome) OVER w AS yc,
             count(*) OVER () AS n
      FROM src WINDOW w AS (ORDER BY {score_expr} DESC, id ASC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT id, rank, n, rank / n AS fraction,
             CASE WHEN nc > 0 THEN yt - yc * (nt / nc) ELSE CAST(yt AS DOUBLE) END AS qini FROM c)"""


def _coef_sql():
    return "(sum(qini) / max(n) - max_by(qini, rank) / (2.0 * max(n)) - max_by(qini, rank) / 2.0) / max(n)"


@register("qini_curve", f"WITH src AS ({CAMPAIGN_SQL}), {_curve_sql().strip()} SELECT id, CAST(rank AS BIGINT) AS rank, round(fraction, 9) AS fraction, round(qini, 9) AS qini FROM q")
def qini_curve(spark, sf_dir):
    c = up.qini_curve(bind_campaign(spark, sf_dir))
    return c.select("id", "rank", r9("fraction"), r9("qini"))


@register("qini_coefficient", f"WITH src AS ({CAMPAIGN_SQL}), {_curve_sql().strip()} SELECT round({_coef_sql()}, 9) AS qini_coefficient FROM q")
def qini_coefficient(spark, sf_dir):
    return up.qini_coefficient(bind_campaign(spark, sf_dir)).select(r9("qini_coefficient"))


def _at_k_sql(k, score_expr="score"):
    return f"""
r AS (SELECT *, row_number() OVER (ORDER BY {score_expr} DESC, id ASC) AS rn, count(*) OVER () AS n FROM src),
top AS (SELECT * FROM r WHERE rn <= greatest(1, round_even({k!r} * n, 0)))"""


@register(
    "uplift_at_k",
    f"""WITH src AS ({CAMPAIGN_SQL}), {_at_k_sql(0.3).strip()}
        SELECT CAST(0.3 AS DOUBLE) AS k, CAST(count(*) AS BIGINT) AS n_top,
               round(avg(outcome) FILTER (WHERE treatment = 1) - avg(outcome) FILTER (WHERE treatment = 0), 9) AS uplift FROM top""",
)
def uplift_at_k(spark, sf_dir):
    u = up.uplift_at_k(bind_campaign(spark, sf_dir), 0.3)
    return u.select("k", "n_top", r9("uplift"))


RANKINGS_SQL = {"price_desc": "score", "price_asc": "-score", "recent_first": "t"}


def _compare_sql():
    parts = []
    for name, expr in RANKINGS_SQL.items():
        parts.append(f"""
SELECT '{name}' AS ranking,
  (WITH {_curve_sql(expr).strip()} SELECT round({_coef_sql()}, 9) FROM q) AS qini_coefficient,
  (WITH {_at_k_sql(0.1, expr).strip()} SELECT round(avg(outcome) FILTER (WHERE treatment = 1) - avg(outcome) FILTER (WHERE treatment = 0), 9) FROM top) AS uplift_at_10,
  (WITH {_at_k_sql(0.3, expr).strip()} SELECT round(avg(outcome) FILTER (WHERE treatment = 1) - avg(outcome) FILTER (WHERE treatment = 0), 9) FROM top) AS uplift_at_30""")
    src = f"SELECT c.*, CAST(floor(epoch_us(o.o_orderdate) / 1000000) AS BIGINT) AS t FROM ({CAMPAIGN_SQL}) c JOIN orders o ON c.id = o.o_orderkey"
    return f"WITH src AS ({src})\n" + "\nUNION ALL\n".join(parts)


@register("uplift_compare", _compare_sql())
def uplift_compare(spark, sf_dir):
    """UP7: three rankings of the same campaign compared by Qini and uplift
    at 10 % / 30 %."""
    c = bind_campaign(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), epoch_seconds("o_orderdate").alias("t"))
    c = c.join(o, "id")
    out = up.compare_rankings(c, {"price_desc": F.col("score"), "price_asc": -F.col("score"), "recent_first": F.col("t").cast("double")})
    return out.select("ranking", r9("qini_coefficient"), r9("uplift_at_10"), r9("uplift_at_30"))
