"""Queries for point-in-time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round6, round9
from ..operators import features as fe
from ..sources import sinks
from ..sources.tables import (
    EVENT_TRANSACTIONS_SQL,
    ORDER_TRANSACTIONS_SQL,
    bind_event_transactions,
    bind_order_transactions,
)
from ..streaming.jobs import run_dir
from .registry import register

# Fit side of the train-fitted encoders on `events`: rows before this instant.
EVENT_FIT_CUTOFF = "2024-01-21 00:00:00"
EVENT_FIT_CUTOFF_T = 1705795200  # the same instant in epoch seconds (UTC)

VELOCITY_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL})
SELECT a.id, a.card, a.t,
       CAST(count(b.amount) FILTER (WHERE b.t > a.t - 3600) AS BIGINT) AS card_txn_count_1h,
       round(sum(b.amount) FILTER (WHERE b.t > a.t - 3600), 6) AS card_amt_sum_1h,
       CAST(count(b.amount) AS BIGINT) AS card_txn_count_1d,
       round(sum(b.amount), 6) AS card_amt_sum_1d
FROM tx a JOIN tx b
  ON a.card = b.card AND b.t > a.t - 86400 AND (b.t < a.t OR (b.t = a.t AND b.id <= a.id))
GROUP BY a.id, a.card, a.t
"""


def _velocity_out(df, labels):
    cols = [F.col("id"), F.col("card"), F.col("t")]
    for lb in labels:
        cols += [F.col(f"card_txn_count_{lb}"), round6(f"card_amt_sum_{lb}").alias(f"card_amt_sum_{lb}")]
    return df.select(*cols)


@register("velocity_1h_1d", VELOCITY_SQL)
def velocity_1h_1d(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "card", "t", "amount")
    return _velocity_out(fe.add_velocity_features(tx, windows_seconds=fe.DEFAULT_WINDOWS), ["1h", "1d"])


ORDER_VELOCITY_SQL = f"""
WITH tx AS ({ORDER_TRANSACTIONS_SQL})
SELECT a.id, a.card, a.t,
       CAST(count(b.amount) FILTER (WHERE b.t > a.t - 604800) AS BIGINT) AS card_txn_count_7d,
       round(sum(b.amount) FILTER (WHERE b.t > a.t - 604800), 6) AS card_amt_sum_7d,
       CAST(count(b.amount) AS BIGINT) AS card_txn_count_30d,
       round(sum(b.amount), 6) AS card_amt_sum_30d
FROM tx a JOIN tx b
  ON a.card = b.card AND b.t > a.t - 2592000 AND (b.t < a.t OR (b.t = a.t AND b.id <= a.id))
GROUP BY a.id, a.card, a.t
"""


@register("velocity_ties_7d_30d", ORDER_VELOCITY_SQL)
def velocity_ties_7d_30d(spark, sf_dir):
    """Same operator on `orders`, whose customers have same-day ties."""
    tx = bind_order_transactions(spark, sf_dir).select("id", "card", "t", "amount")
    out = fe.add_velocity_features(tx, windows_seconds={"7d": 7 * 86400, "30d": 30 * 86400})
    return _velocity_out(out, ["7d", "30d"])


CARD_PRIOR_SQL = f"""
WITH tx AS ({ORDER_TRANSACTIONS_SQL}),
p AS (
  SELECT a.id, a.card, a.amount, count(b.id) AS n, coalesce(sum(b.amount), 0) AS s
  FROM tx a LEFT JOIN tx b
    ON a.card = b.card AND (b.t < a.t OR (b.t = a.t AND b.id < a.id))
  GROUP BY a.id, a.card, a.amount)
SELECT id, card, CAST(n AS BIGINT) AS card_prior_txn_count,
       round(CASE WHEN n > 0 AND amount IS NOT NULL THEN s / n END, 9) AS card_running_avg_amt,
       round(amount / nullif(CASE WHEN n > 0 AND amount IS NOT NULL THEN s / n END, 0), 9) AS card_amt_ratio_to_own_avg
FROM p
"""


@register("card_prior_stats", CARD_PRIOR_SQL)
def card_prior_stats(spark, sf_dir):
    tx = bind_order_transactions(spark, sf_dir).select("id", "card", "t", "amount")
    out = fe.add_card_usage_features(tx, diversity_col=None)
    return out.select(
        "id",
        "card",
        "card_prior_txn_count",
        round9("card_running_avg_amt").alias("card_running_avg_amt"),
        round9("card_amt_ratio_to_own_avg").alias("card_amt_ratio_to_own_avg"),
    )


CARD_DISTINCT_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL})
SELECT a.id, a.card, CAST(count(DISTINCT b.diversity) AS BIGINT) AS card_prior_distinct_diversity_count
FROM tx a LEFT JOIN tx b
  ON a.card = b.card AND (b.t < a.t OR (b.t = a.t AND b.id < a.id))
GROUP BY a.id, a.card
"""


@register("card_prior_distinct", CARD_DISTINCT_SQL)
def card_prior_distinct(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "card", "t", "amount", "diversity")
    out = fe.add_card_usage_features(tx, diversity_col="diversity")
    return out.select("id", "card", "card_prior_distinct_diversity_count")


HOUR_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL}),
stats AS (
  SELECT (t % 86400) // 3600 AS h, avg(amount) AS a, count(amount) AS n
  FROM tx WHERE t < {EVENT_FIT_CUTOFF_T} GROUP BY 1)
SELECT tx.id, round(stats.a, 9) AS hour_of_day_avg_amt, CAST(stats.n AS BIGINT) AS hour_of_day_txn_count
FROM tx LEFT JOIN stats ON (tx.t % 86400) // 3600 = stats.h
"""


@register("hour_of_day_features", HOUR_SQL)
def hour_of_day_features(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "t", "amount")
    fit = tx.where(F.col("t") < EVENT_FIT_CUTOFF_T)
    out = fe.add_hour_of_day_aggregates(tx, fit_df=fit)
    return out.select("id", round9("hour_of_day_avg_amt").alias("hour_of_day_avg_amt"), "hour_of_day_txn_count")


def _freq_input(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir)
    # A NULL-bearing categorical: the tens digit of k, NULL below 10.
    return tx.select(
        "id", "t", "category", F.when(F.col("diversity") >= 10, (F.col("diversity") / 10).cast("int").cast("string")).alias("k_tens")
    )


FREQ_INPUT_SQL = f"""
SELECT id, t, category, CASE WHEN diversity >= 10 THEN CAST(CAST(diversity // 10 AS INTEGER) AS VARCHAR) END AS k_tens
FROM ({EVENT_TRANSACTIONS_SQL})
"""

FREQ_TABLE_SQL = f"""
WITH f AS ({FREQ_INPUT_SQL}),
long AS (SELECT 'category' AS "column", category AS value FROM f
         UNION ALL SELECT 'k_tens', k_tens FROM f)
SELECT "column", value, round(count(*) / sum(count(*)) OVER (PARTITION BY "column"), 6) AS freq
FROM long GROUP BY "column", value
"""


@register("frequency_table", FREQ_TABLE_SQL)
def frequency_table(spark, sf_dir):
    t = fe.fit_frequencies(_freq_input(spark, sf_dir), ["category", "k_tens"])
    return t.select("column", "value", round6("freq").alias("freq"))


FREQ_ENCODE_SQL = f"""
WITH f AS ({FREQ_INPUT_SQL}),
fit AS (SELECT * FROM f WHERE t < {EVENT_FIT_CUTOFF_T}),
c AS (SELECT category AS v, count(*) / (SELECT count(*) FROM fit) AS freq FROM fit GROUP BY 1),
k AS (SELECT k_tens AS v, count(*) / (SELECT count(*) FROM fit) AS freq FROM fit GROUP BY 1)
SELECT f.id,
       round(coalesce(c.freq, 0.0), 6) AS category_freq,
       round(coalesce(k.freq, 0.0), 6) AS k_tens_freq
FROM f LEFT JOIN c ON f.category IS NOT DISTINCT FROM c.v
       LEFT JOIN k ON f.k_tens IS NOT DISTINCT FROM k.v
"""


@register("frequency_encode", FREQ_ENCODE_SQL)
def frequency_encode(spark, sf_dir):
    df = _freq_input(spark, sf_dir)
    out = fe.frequency_encode(df, ["category", "k_tens"], fit_df=df.where(F.col("t") < EVENT_FIT_CUTOFF_T))
    return out.select("id", round6("category_freq").alias("category_freq"), round6("k_tens_freq").alias("k_tens_freq"))


ENGINEERED_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL}),
pairs AS (
  SELECT a.id,
         count(b.amount) FILTER (WHERE b.t > a.t - 3600 AND (b.t < a.t OR b.id <= a.id)) AS c1h,
         sum(b.amount) FILTER (WHERE b.t > a.t - 3600 AND (b.t < a.t OR b.id <= a.id)) AS s1h,
         count(b.amount) FILTER (WHERE b.t > a.t - 86400 AND (b.t < a.t OR b.id <= a.id)) AS c1d,
         sum(b.amount) FILTER (WHERE b.t > a.t - 86400 AND (b.t < a.t OR b.id <= a.id)) AS s1d,
         count(b.id) FILTER (WHERE b.t < a.t OR (b.t = a.t AND b.id < a.id)) AS n_prior,
         coalesce(sum(b.amount) FILTER (WHERE b.t < a.t OR (b.t = a.t AND b.id < a.id)), 0) AS s_prior,
         count(DISTINCT b.diversity) FILTER (WHERE b.t < a.t OR (b.t = a.t AND b.id < a.id)) AS d_prior
  FROM tx a JOIN tx b ON a.card = b.card AND b.t <= a.t
  GROUP BY a.id),
hour AS (SELECT (t % 86400) // 3600 AS h, avg(amount) AS ha, count(amount) AS hn FROM tx GROUP BY 1),
freq AS (SELECT category AS v, count(*) / (SELECT count(*) FROM tx) AS fr FROM tx GROUP BY 1)
SELECT tx.id,
       CAST(p.c1h AS BIGINT) AS card_txn_count_1h, round(p.s1h, 6) AS card_amt_sum_1h,
       CAST(p.c1d AS BIGINT) AS card_txn_count_1d, round(p.s1d, 6) AS card_amt_sum_1d,
       CAST(p.n_prior AS BIGINT) AS card_prior_txn_count,
       round(CASE WHEN p.n_prior > 0 THEN p.s_prior / p.n_prior END, 9) AS card_running_avg_amt,
       round(tx.amount / nullif(CASE WHEN p.n_prior > 0 THEN p.s_prior / p.n_prior END, 0), 9) AS card_amt_ratio_to_own_avg,
       CAST(p.d_prior AS BIGINT) AS card_prior_distinct_diversity_count,
       round(hour.ha, 9) AS hour_of_day_avg_amt, CAST(hour.hn AS BIGINT) AS hour_of_day_txn_count,
       round(coalesce(freq.fr, 0.0), 6) AS category_freq
FROM tx JOIN pairs p ON tx.id = p.id
LEFT JOIN hour ON (tx.t % 86400) // 3600 = hour.h
LEFT JOIN freq ON tx.category IS NOT DISTINCT FROM freq.v
"""

ENGINEERED_COLS = [
    "card_txn_count_1h", "card_amt_sum_1h", "card_txn_count_1d", "card_amt_sum_1d",
    "card_prior_txn_count", "card_running_avg_amt", "card_amt_ratio_to_own_avg",
    "card_prior_distinct_diversity_count", "hour_of_day_avg_amt", "hour_of_day_txn_count", "category_freq",
]


NINE_DIGITS = ("avg", "ratio", "rate", "mean")


def rounded(df, cols):
    """Round doubles: 9 decimals for averages/ratios, 6 otherwise."""
    out = []
    for c in cols:
        dt = dict(df.dtypes)[c]
        if dt in ("double", "float"):
            out.append((round9(c) if any(k in c for k in NINE_DIGITS) else round6(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


@register("engineered_features", ENGINEERED_SQL)
def engineered_features(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "card", "t", "amount", "diversity", "category")
    return rounded(fe.engineer_features(tx), ["id", *ENGINEERED_COLS])


LEAK_SQL = f"""
SELECT CAST(count(*) AS BIGINT) AS n_checked, CAST(0 AS BIGINT) AS n_mismatch
FROM ({EVENT_TRANSACTIONS_SQL}) WHERE t <= 1705276800
"""


@register("features_written", ENGINEERED_SQL)
def features_written(spark, sf_dir):
    """IO5: the feature table as it is written and read back."""
    path = f"{run_dir(spark, 'features')}/table"
    sinks.write_table(engineered_features(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("leakage_guard", LEAK_SQL)
def leakage_guard(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "card", "t", "amount", "diversity")

    def build(d):
        out = fe.add_velocity_features(d)
        out = fe.add_card_usage_features(out, source=d)
        return rounded(out, out.columns)

    return fe.leakage_guard(tx, 1705276800, build)
