"""Queries for splits, folds, sampling and permutations (S1-S4, S6, S8,
S11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as sp
from ..sources.tables import (
    APPLICATIONS_SQL,
    EVENT_TRANSACTIONS_SQL,
    SCORED_ROWS_SQL,
    bind_applications,
    bind_event_transactions,
    bind_scored_rows,
)
from .features_plans import ENGINEERED_COLS, rounded
from .registry import register

SEED = 42


def _summary(df, keys):
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"), F.min("t").alias("min_t"), F.max("t").alias("max_t")
    )


CHRONO_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL}),
r AS (SELECT t, row_number() OVER (ORDER BY t, id) AS rn, count(*) OVER () AS n FROM tx)
SELECT CASE WHEN rn <= round_even(n * CAST(0.8 AS DOUBLE), 0) THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows, min(t) AS min_t, max(t) AS max_t
FROM r GROUP BY 1
"""


@register("chrono_split_summary", CHRONO_SQL)
def chrono_split_summary(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "t")
    return _summary(sp.chronological_split(tx, test_size=0.2), ["split"])


TRAIN_TEST_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY t, id) AS rn, count(*) OVER () AS n FROM tx),
s AS (SELECT *, CASE WHEN rn <= round_even(n * CAST(0.8 AS DOUBLE), 0) THEN 'train' ELSE 'test' END AS split FROM r),
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
hour AS (SELECT (t % 86400) // 3600 AS h, avg(amount) AS ha, count(amount) AS hn FROM s WHERE split = 'train' GROUP BY 1),
freq AS (SELECT category AS v, count(*) / (SELECT count(*) FROM s WHERE split = 'train') AS fr
         FROM s WHERE split = 'train' GROUP BY 1)
SELECT s.id, s.split,
       CAST(p.c1h AS BIGINT) AS card_txn_count_1h, round(p.s1h, 6) AS card_amt_sum_1h,
       CAST(p.c1d AS BIGINT) AS card_txn_count_1d, round(p.s1d, 6) AS card_amt_sum_1d,
       CAST(p.n_prior AS BIGINT) AS card_prior_txn_count,
       round(CASE WHEN p.n_prior > 0 THEN p.s_prior / p.n_prior END, 9) AS card_running_avg_amt,
       round(s.amount / nullif(CASE WHEN p.n_prior > 0 THEN p.s_prior / p.n_prior END, 0), 9) AS card_amt_ratio_to_own_avg,
       CAST(p.d_prior AS BIGINT) AS card_prior_distinct_diversity_count,
       round(hour.ha, 9) AS hour_of_day_avg_amt, CAST(hour.hn AS BIGINT) AS hour_of_day_txn_count,
       round(coalesce(freq.fr, 0.0), 6) AS category_freq
FROM s JOIN pairs p ON s.id = p.id
LEFT JOIN hour ON (s.t % 86400) // 3600 = hour.h
LEFT JOIN freq ON s.category IS NOT DISTINCT FROM freq.v
"""


@register("train_test_features", TRAIN_TEST_SQL)
def train_test_features(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "card", "t", "amount", "diversity", "category")
    out = sp.prepare_train_test_features(tx, test_size=0.2)
    return rounded(out, ["id", "split", *ENGINEERED_COLS])


def _md5(id_expr, *extra):
    parts = [f"CAST({id_expr} AS VARCHAR)"] + [f"':' || '{e}'" for e in extra] + [f"':' || '{SEED}'"]
    return "md5(" + " || ".join(parts) + ")"


STRAT_SQL = f"""
WITH s AS ({SCORED_ROWS_SQL}),
r AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY {_md5('id')}, id) AS rn,
             count(*) OVER (PARTITION BY y) AS ns FROM s)
SELECT y, CASE WHEN rn <= round_even(ns * CAST(0.2 AS DOUBLE), 0) THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows
FROM r GROUP BY 1, 2
"""


@register("stratified_split_counts", STRAT_SQL)
def stratified_split_counts(spark, sf_dir):
    s = sp.stratified_split(bind_scored_rows(spark, sf_dir), "y", test_size=0.2, seed=SEED)
    return s.groupBy("y", "split").agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


BUDGET = 2000

BUDGET_SQL = f"""
WITH s AS ({SCORED_ROWS_SQL}),
r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY {_md5('id')}, id) AS rn,
             count(*) OVER (PARTITION BY y) AS ns, count(*) OVER () AS n FROM s)
SELECT id, y FROM r
WHERE rn <= round_even(ns * CAST({BUDGET} AS DOUBLE) / CAST(n AS DOUBLE), 0)
"""


@register("stratified_budget", BUDGET_SQL)
def stratified_budget(spark, sf_dir):
    s = bind_scored_rows(spark, sf_dir).select("id", "y")
    return sp.stratified_budget(s, "y", BUDGET, seed=SEED).select("id", "y")


RANDOM_K = 50


@register(
    "query_batch_random",
    f"SELECT id FROM ({SCORED_ROWS_SQL}) ORDER BY md5(CAST(id AS VARCHAR) || ':' || '7'), id LIMIT {RANDOM_K}",
)
def query_batch_random(spark, sf_dir):
    return sp.random_batch(bind_scored_rows(spark, sf_dir).select("id"), RANDOM_K, seed=7)


PERMUTE_SQL = f"""
WITH a AS ({APPLICATIONS_SQL}),
base AS (SELECT id, target, priority, row_number() OVER (ORDER BY id) AS r FROM a),
p1 AS (SELECT totalprice, row_number() OVER (ORDER BY {_md5('id', 'totalprice')}, id) AS r FROM a),
p2 AS (SELECT acctbal, row_number() OVER (ORDER BY {_md5('id', 'acctbal')}, id) AS r FROM a)
SELECT base.id, base.target, round(p1.totalprice, 6) AS totalprice, round(p2.acctbal, 6) AS acctbal, base.priority
FROM base JOIN p1 ON base.r = p1.r JOIN p2 ON base.r = p2.r
"""


@register("column_permutation", PERMUTE_SQL)
def column_permutation(spark, sf_dir):
    a = bind_applications(spark, sf_dir).select("id", "target", "totalprice", "acctbal", "priority")
    p = sp.permute_columns(a, ["totalprice", "acctbal"], seed=SEED)
    return p.select("id", "target", F.round("totalprice", 6).alias("totalprice"), F.round("acctbal", 6).alias("acctbal"), "priority")


FOLDS_SQL = f"""
WITH tx AS ({EVENT_TRANSACTIONS_SQL}),
r AS (SELECT t, row_number() OVER (ORDER BY t, id) - 1 AS r0, count(*) OVER () AS n FROM tx),
f AS (SELECT * FROM r, range(5) AS g(fold)),
x AS (SELECT fold, t, r0, n // 6 AS m, n - (5 - fold) * (n // 6) AS st FROM f)
SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN r0 < st THEN 'train' ELSE 'test' END AS role,
       CAST(count(*) AS BIGINT) AS n_rows, min(t) AS min_t, max(t) AS max_t
FROM x WHERE r0 < st + m GROUP BY 1, 2
"""


@register("time_series_folds", FOLDS_SQL)
def time_series_folds(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "t")
    f = sp.time_series_folds(tx, 5)
    return _summary(f, ["fold", "role"])
