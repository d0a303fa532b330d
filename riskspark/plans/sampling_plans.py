"""Queries for uncertainty sampling, labelling rounds and the decision
policy (AL1-AL5, S5, S7, PF2, PF5, PF7, PF10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import policy as po
from ..operators import sampling as sa
from ..operators import split as sp
from ..sources.tables import CLASS_PROB_SQL, EVENT_TRANSACTIONS_SQL, SCORED_ROWS_SQL, bind_class_probabilities, bind_scored_rows, table
from .registry import register


def r9(c):
    return F.round(F.col(c).cast("double"), 9).alias(c)


ENTROPY_SQL = "-list_sum(list_transform(probs, lambda p: p * ln(least(greatest(p, 1e-12), 1.0))))"
MARGIN_SQL = "1.0 - (list_reverse_sort(probs)[1] - list_reverse_sort(probs)[2])"
LC_SQL = "1.0 - list_max(probs)"


@register(
    "uncertainty_scores",
    f"""SELECT id, round({LC_SQL}, 9) AS least_confidence, round({MARGIN_SQL}, 9) AS margin, round({ENTROPY_SQL}, 9) AS entropy
        FROM ({CLASS_PROB_SQL})""",
)
def uncertainty_scores(spark, sf_dir):
    s = sa.uncertainty_scores(bind_class_probabilities(spark, sf_dir))
    return s.select("id", r9("least_confidence"), r9("margin"), r9("entropy"))


@register(
    "probability_violations",
    f"""SELECT CAST(count(*) AS BIGINT) AS n_rows,
               CAST(count(*) FILTER (WHERE len(probs) < 2) AS BIGINT) AS n_too_few_classes,
               CAST(count(*) FILTER (WHERE list_min(probs) < -1e-9 OR list_max(probs) > 1 + 1e-9) AS BIGINT) AS n_out_of_range,
               CAST(count(*) FILTER (WHERE abs(list_sum(probs) - 1.0) > 1.1e-5) AS BIGINT) AS n_bad_sum
        FROM ({CLASS_PROB_SQL})""",
)
def probability_violations(spark, sf_dir):
    return sa.probability_violations(bind_class_probabilities(spark, sf_dir))


BATCH = 10


@register(
    "query_batch_topk",
    f"""SELECT id, round({ENTROPY_SQL}, 9) AS uncertainty FROM ({CLASS_PROB_SQL})
        ORDER BY {ENTROPY_SQL} DESC, id ASC LIMIT {BATCH}""",
)
def query_batch_topk(spark, sf_dir):
    b = sa.select_query_batch(bind_class_probabilities(spark, sf_dir), BATCH, "entropy")
    return b.select("id", r9("uncertainty"))


SEED_SQL = f"SELECT id FROM ({CLASS_PROB_SQL}) ORDER BY md5(CAST(id AS VARCHAR) || ':' || '3'), id LIMIT {BATCH}"


@register(
    "label_round_step",
    f"""WITH p AS ({CLASS_PROB_SQL}), seed AS ({SEED_SQL}),
        pool AS (SELECT * FROM p WHERE id NOT IN (SELECT id FROM seed)),
        chosen AS (SELECT id FROM pool ORDER BY {ENTROPY_SQL} DESC, id ASC LIMIT {BATCH})
        SELECT id, 'seed' AS source, 'labelled' AS side FROM seed UNION ALL SELECT id, 'chosen', 'labelled' FROM chosen
        UNION ALL SELECT id, 'pool', 'pool' FROM pool WHERE id NOT IN (SELECT id FROM chosen)""",
)
def label_round_step(spark, sf_dir):
    """AL5/S7: a random seed set is labelled; one round moves the most
    uncertain pool rows into the labelled set.  Both sides are returned."""
    p = bind_class_probabilities(spark, sf_dir)
    seed = sp.random_batch(p, BATCH, seed=3).select("id")
    labelled = p.join(seed, "id", "left_semi")
    pool = p.join(seed, "id", "left_anti")
    chosen, new_labelled, new_pool = sa.labelling_round(pool, labelled, BATCH)
    ch = chosen.select("id").withColumn("source", F.lit("chosen"))
    moved = new_labelled.select("id").join(ch, "id", "left").select("id", F.coalesce("source", F.lit("seed")).alias("source"), F.lit("labelled").alias("side"))
    return moved.unionByName(new_pool.select("id", F.lit("pool").alias("source"), F.lit("pool").alias("side")))


CURVE_SQL = f"""WITH p AS ({CLASS_PROB_SQL}),
v AS (SELECT user_id AS id, CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS v FROM events GROUP BY user_id),
r AS (SELECT p.id, v.v, row_number() OVER (ORDER BY {ENTROPY_SQL.replace('probs', 'p.probs')} DESC, p.id) AS rn FROM p JOIN v ON p.id = v.id),
c AS (SELECT rn, sum(v) OVER (ORDER BY rn) AS cv, sum(v) OVER () AS tot FROM r),
rounds AS (SELECT CAST(ceil(rn / 25) AS BIGINT) AS round, max(rn) AS n_labeled, max_by(cv, rn) / max(tot) AS metric FROM c GROUP BY 1)"""


@register(
    "labels_to_target",
    f"{CURVE_SQL} SELECT CAST(min_by(n_labeled, round) AS BIGINT) AS n_labeled_to_target FROM rounds WHERE metric >= 0.5",
)
def labels_to_target(spark, sf_dir):
    """PF10 on the curve of error events captured when users are labelled in
    entropy order, 25 per round."""
    p = bind_class_probabilities(spark, sf_dir)
    ev = table(spark, sf_dir, "events")
    v = ev.groupBy(F.col("user_id").alias("id")).agg(F.count_if(F.col("event_type") == "error").cast("double").alias("v"))
    d = p.withColumn("u", sa.entropy("probs")).join(v, "id")
    curve = sa.learning_curve(d.select("id", "u", "v"), [("u", False), ("id", True)], F.col("v"), 25)
    return sa.labels_to_target(curve, 0.5).select(F.col("n_labeled_to_target").cast("long").alias("n_labeled_to_target"))


F1_SQL = f"""WITH s AS ({SCORED_ROWS_SQL}),
h AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(pos + neg) OVER (ORDER BY score DESC) AS pp, sum(pos) OVER () AS P FROM h),
pr AS (SELECT score AS threshold, tp / pp AS precision, tp / P AS recall FROM c),
f AS (SELECT threshold, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr),
best AS (SELECT threshold AS review_threshold FROM f ORDER BY f1 DESC, threshold ASC LIMIT 1)"""


def policy_thresholds(spark, sf_dir):
    """PF5 on the scored orders."""
    return po.thresholds_from_f1(bind_scored_rows(spark, sf_dir))


@register(
    "policy_thresholds_f1",
    f"{F1_SQL} SELECT round(review_threshold, 9) AS review_threshold, round(review_threshold + (1 - review_threshold) / 2, 9) AS decline_threshold FROM best",
)
def policy_thresholds_f1(spark, sf_dir):
    return policy_thresholds(spark, sf_dir).select(r9("review_threshold"), r9("decline_threshold"))


validate_thresholds = po.validate_thresholds
decide_probability = po.decide_probability


@register(
    "policy_probability",
    f"""{F1_SQL}
        SELECT s.id, CASE WHEN s.score >= b.review_threshold + (1 - b.review_threshold) / 2 THEN 'decline'
                          WHEN s.score >= b.review_threshold THEN 'review' ELSE 'approve' END AS decision
        FROM s, best b""",
)
def policy_probability(spark, sf_dir):
    t = policy_thresholds(spark, sf_dir).first()
    return decide_probability(bind_scored_rows(spark, sf_dir), t["review_threshold"], t["decline_threshold"]).select("id", "decision")


REQUIRED_REQUEST_KEYS = ["amount", "hour", "k"]


@register(
    "request_feature_check",
    f"""SELECT id, CASE WHEN category = 'view' THEN 1 ELSE 0 END AS n_missing_keys,
               CASE WHEN category = 'view' THEN 'k' ELSE '' END AS missing_keys,
               round(amount, 6) AS amount
        FROM ({EVENT_TRANSACTIONS_SQL})""",
)
def request_feature_check(spark, sf_dir):
    """PF7: each event as a scoring request whose feature map lacks `k` for
    page views; required keys are checked without a Python UDF."""
    from ..sources.tables import bind_event_transactions

    tx = bind_event_transactions(spark, sf_dir)
    feats = F.map_from_arrays(
        F.when(F.col("category") == "view", F.array(F.lit("amount"), F.lit("hour")))
        .otherwise(F.array(F.lit("amount"), F.lit("hour"), F.lit("k"))),
        F.when(F.col("category") == "view", F.array(F.col("amount"), ((F.col("t") % 86400) / 3600).cast("double")))
        .otherwise(F.array(F.col("amount"), ((F.col("t") % 86400) / 3600).cast("double"), F.col("diversity").cast("double"))),
    )
    req = tx.select("id", feats.alias("features"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_REQUEST_KEYS]), F.map_keys("features")))
    return req.select(
        "id", F.size(missing).alias("n_missing_keys"), F.array_join(missing, ",").alias("missing_keys"),
        F.round(F.try_element_at("features", F.lit("amount")), 6).alias("amount"),
    )
