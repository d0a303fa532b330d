"""Queries over the decision log and the run/registry history (IO7, PF8,
A7, A8, ML9-ML12, S10, PS5, PS6).

The log is built from the decisions the scoring jobs make on the test
tables: credit decisions on applications and fraud decisions on scored
orders, each stamped with its order date."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as au
from ..operators import registry as rg
from ..operators import scorecard as sc
from ..operators import woe as wo
from ..session import cut_lineage
from ..sources.tables import bind_applications, bind_scored_rows, table
from ..streaming.jobs import run_dir
from . import credit_plans as cp
from .registry import register
from .sampling_plans import F1_SQL, decide_probability, policy_thresholds


def _log(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate"))
    credit = cp.credit_scoring(spark, sf_dir).join(o, "id")
    credit_rows = au.decision_rows(credit, "credit", "scorecard-1999", "id", F.col("o_orderdate"), "score", "decision",
                                   ["totalprice", "acctbal", "priority", "segment"])
    t = policy_thresholds(spark, sf_dir).first()
    fraud = decide_probability(bind_scored_rows(spark, sf_dir), t["review_threshold"], t["decline_threshold"]).join(o, "id")
    fraud_rows = au.decision_rows(fraud, "fraud", "f1-policy", "id", F.col("o_orderdate"), "score", "decision", ["score"])
    return credit_rows.unionByName(fraud_rows)


LOG_SQL = f"""
credit AS ({cp.BATCH_SQL}),
{F1_SQL.strip()[5:]},
fraud AS (SELECT s.id, s.score, CASE WHEN s.score >= b.review_threshold + (1 - b.review_threshold) / 2 THEN 'decline'
                                    WHEN s.score >= b.review_threshold THEN 'review' ELSE 'approve' END AS decision FROM s, best b),
log AS (SELECT c.id, o.o_orderdate AS logged_at, 'credit' AS model_type, 'scorecard-1999' AS model_version, c.score, c.decision
        FROM credit c JOIN orders o ON c.id = o.o_orderkey
        UNION ALL
        SELECT f.id, o.o_orderdate, 'fraud', 'f1-policy', f.score, f.decision FROM fraud f JOIN orders o ON f.id = o.o_orderkey)"""


@register(
    "audit_append_batch",
    f"""WITH {LOG_SQL} SELECT id, CAST(epoch(logged_at) AS BIGINT) AS logged_at, model_type, model_version,
           CASE WHEN model_type = 'credit' THEN round(score, 6) ELSE round(score, 9) END AS score, decision, CAST(0 AS INTEGER) AS batch_id FROM log""",
)
def audit_append_batch(spark, sf_dir):
    """IO7: one batch of decisions is appended to a fresh log, twice as after a
    lost commit, and read back."""
    path = f"{run_dir(spark, 'decision-log')}/log"
    for _ in range(2):
        au.append_decisions(_log(spark, sf_dir), path, batch_id=0)
    sc = F.when(F.col("model_type") == "credit", F.round("score", 6)).otherwise(F.round("score", 9))
    log = spark.read.parquet(path)
    return log.select("id", F.unix_timestamp("logged_at").alias("logged_at"), "model_type", "model_version", sc.alias("score"), "decision", "batch_id")


@register(
    "audit_recent",
    f"""WITH {LOG_SQL}
        SELECT id, CAST(epoch(logged_at) AS BIGINT) AS logged_at, round(score, 6) AS score, decision
        FROM log WHERE model_type = 'credit' ORDER BY logged_at DESC, id DESC LIMIT 20""",
)
def audit_recent(spark, sf_dir):
    r = au.recent_decisions(_log(spark, sf_dir), 20, "credit")
    return r.select("id", F.unix_timestamp("logged_at").alias("logged_at"), F.round("score", 6).alias("score"), "decision")


@register(
    "audit_decision_counts",
    f"WITH {LOG_SQL} SELECT model_type, decision, CAST(count(*) AS BIGINT) AS n FROM log GROUP BY ALL",
)
def audit_decision_counts(spark, sf_dir):
    return au.decision_counts(_log(spark, sf_dir))


@register(
    "audit_decision_pivot",
    f"""WITH {LOG_SQL}
        SELECT model_type, CAST(count(*) FILTER (WHERE decision = 'approve') AS BIGINT) AS approve,
               CAST(count(*) FILTER (WHERE decision = 'review') AS BIGINT) AS review,
               CAST(count(*) FILTER (WHERE decision = 'decline') AS BIGINT) AS decline
        FROM log GROUP BY model_type""",
)
def audit_decision_pivot(spark, sf_dir):
    return au.decision_pivot(_log(spark, sf_dir))


# --- run history -------------------------------------------------------------

def _scores(spark, sf_dir):
    _, _, _, _, s = cp._scored(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    return s.join(o, "id")


def _monitor_runs(spark, sf_dir):
    s = _scores(spark, sf_dir)
    ref = s.where(F.col("t") < cp.CREDIT_TRAIN_T)
    batches = s.where(F.col("t") >= cp.CREDIT_TRAIN_T)
    p = rg.psi_by_batch(ref, batches, "score", "year", decimals=cp.EDGE_DECIMALS)
    return p.select(
        F.concat(F.lit("psi-"), F.col("year").cast("string")).alias("run_id"),
        F.lit("credit_monitoring").alias("experiment"),
        F.make_timestamp(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("start_time"),
        F.col("psi").alias("score_psi"),
        "verdict",
    )


def _eval_runs(spark, sf_dir):
    s = bind_scored_rows(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    g = s.join(o, "id").groupBy("year").agg(F.count(F.lit(1)).cast("long").alias("n_rows"), F.avg("y").alias("label_rate"))
    return g.select(
        F.concat(F.lit("eval-"), F.col("year").cast("string")).alias("run_id"),
        F.lit("fraud_evaluation").alias("experiment"),
        F.make_timestamp(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("start_time"),
        "n_rows",
        "label_rate",
    )


SCORES_SQL = f"""{cp.SCORECARD_CTES}, {cp.applied_labels_cte(cp.NUMERIC, cp.CATEGORICAL)},
sc AS (SELECT alab.id, alab.t, year(o.o_orderdate) AS year, {cp.SCORE_SQL_EXPR} AS score FROM alab JOIN orders o ON alab.id = o.o_orderkey),
ref AS (SELECT score FROM sc WHERE t < {cp.CREDIT_TRAIN_T}),
qq AS (SELECT list_sort(list_distinct(list_transform(quantile_cont(score, [{', '.join(repr(i / 10) for i in range(11))}]),
                                                   lambda v: round(v, {cp.EDGE_DECIMALS})))) AS qs FROM ref),
ee AS (SELECT {cp._interior('qs')} AS es FROM qq),
bref AS (SELECT 'bin_' || CAST(len(list_filter(es, lambda v: v < score)) AS VARCHAR) AS bin FROM ref, ee),
bact AS (SELECT year, 'bin_' || CAST(len(list_filter(es, lambda v: v < score)) AS VARCHAR) AS bin FROM sc, ee WHERE t >= {cp.CREDIT_TRAIN_T}),
ce AS (SELECT bin, count(*) AS n_expected FROM bref GROUP BY bin),
ca AS (SELECT year, bin, count(*) AS n_actual FROM bact GROUP BY ALL),
yrs AS (SELECT DISTINCT year FROM ca),
tt AS (SELECT coalesce(x.year, ca.year) AS year, coalesce(x.bin, ca.bin) AS bin, coalesce(x.n_expected, 0) AS n_expected,
              coalesce(ca.n_actual, 0) AS n_actual
       FROM (SELECT * FROM ce, yrs) x FULL OUTER JOIN ca ON x.year = ca.year AND x.bin = ca.bin),
pp AS (SELECT year, (n_expected + 1e-4) / (sum(n_expected) OVER (PARTITION BY year) + 1e-4 * count(*) OVER (PARTITION BY year)) AS pe,
              (n_actual + 1e-4) / (sum(n_actual) OVER (PARTITION BY year) + 1e-4 * count(*) OVER (PARTITION BY year)) AS pa FROM tt),
mon AS (SELECT 'psi-' || CAST(year AS VARCHAR) AS run_id, make_timestamp(year + 1, 1, 1, 0, 0, 0) AS start_time,
               sum((pa - pe) * ln(pa / pe)) AS score_psi FROM pp GROUP BY year),
ev AS (SELECT 'eval-' || CAST(year(o_orderdate) AS VARCHAR) AS run_id, make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0) AS start_time,
              count(*) AS n_rows, avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS label_rate
       FROM orders GROUP BY year(o_orderdate))"""


@register(
    "psi_history",
    f"WITH {SCORES_SQL} SELECT run_id, CAST(epoch(start_time) AS BIGINT) AS start_time, round(score_psi, 9) AS score_psi FROM mon",
)
def psi_history(spark, sf_dir):
    """PS6: monitoring runs (one per later year) that logged score_psi."""
    runs = rg.union_runs([_monitor_runs(spark, sf_dir), _eval_runs(spark, sf_dir)])
    h = rg.metric_history(runs, "score_psi")
    return h.select("run_id", F.unix_timestamp("start_time").alias("start_time"), F.round("score_psi", 9).alias("score_psi"))


@register(
    "runs_comparison",
    f"""WITH {SCORES_SQL}
        SELECT run_id, CAST(epoch(start_time) AS BIGINT) AS start_time, round(score_psi, 9) AS score_psi,
               CAST(NULL AS BIGINT) AS n_rows, CAST(NULL AS DOUBLE) AS label_rate FROM mon
        UNION ALL
        SELECT run_id, CAST(epoch(start_time) AS BIGINT), NULL, CAST(n_rows AS BIGINT), round(label_rate, 9) FROM ev""",
)
def runs_comparison(spark, sf_dir):
    """S10/ML12: two experiments with different metrics side by side."""
    runs = rg.union_runs([_monitor_runs(spark, sf_dir), _eval_runs(spark, sf_dir)])
    return runs.select(
        "run_id", F.unix_timestamp("start_time").alias("start_time"), F.round("score_psi", 9).alias("score_psi"),
        "n_rows", F.round("label_rate", 9).alias("label_rate"),
    )


@register(
    "psi_monitor",
    f"""WITH {SCORES_SQL},
        act AS (SELECT 'bin_' || CAST(len(list_filter(es, lambda v: v < score)) AS VARCHAR) AS bin FROM sc, ee WHERE t >= {cp.CREDIT_TRAIN_T}),
        ca1 AS (SELECT bin, count(*) AS n_actual FROM act GROUP BY bin),
        t1 AS (SELECT coalesce(ce.bin, ca1.bin) AS bin, coalesce(n_expected, 0) AS ne, coalesce(n_actual, 0) AS na
               FROM ce FULL OUTER JOIN ca1 ON ce.bin = ca1.bin),
        p1 AS (SELECT (ne + 1e-4) / (sum(ne) OVER () + 1e-4 * count(*) OVER ()) AS pe,
                      (na + 1e-4) / (sum(na) OVER () + 1e-4 * count(*) OVER ()) AS pa FROM t1),
        v AS (SELECT sum((pa - pe) * ln(pa / pe)) AS psi FROM p1)
        SELECT CAST((SELECT count(*) FROM act) AS BIGINT) AS n_monitoring, round(psi, 9) AS psi,
               CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END AS verdict,
               CASE WHEN psi >= 0.25 THEN 1 ELSE 0 END AS status FROM v""",
)
def psi_monitor(spark, sf_dir):
    """PS5: a monitoring run: the published scorecard is loaded, scores the
    later applications and compares them with the score histogram that it was
    published with; the run is appended and read back."""
    root = run_dir(spark, "monitor")
    everyone, train = cp._apps(spark, sf_dir)
    sc.publish(spark, f"{root}/registry", "credit_scorecard", cp.fit_card(train), {})
    _, card = sc.champion(spark, f"{root}/registry", "credit_scorecard")
    batch = card.score(everyone.where(F.col("t") >= cp.CREDIT_TRAIN_T))
    runs = rg.monitor_run(card.reference, batch, "score", f"{root}/runs", "monitor")
    return runs.select(F.col("n_rows").alias("n_monitoring"), F.round("psi", 9).alias("psi"), "verdict", "status")


#: Training cut-offs of the credit scorecard's versions, and the model beside it.
CUTS = ["1997-01-01", "1999-01-01"]
CARD, BLIND = "credit_scorecard", "priority_scorecard"


def _published(spark, sf_dir):
    """A registry with what the training jobs publish: a version of the credit
    scorecard at each cut-off, fitted on the applications before it, and one
    version of a scorecard of categories only at the last."""
    root = run_dir(spark, "registry")
    for cut in CUTS:
        train = cut_lineage(bind_applications(spark, sf_dir, orders_before=cut))
        found = train.agg(F.count("*").alias("n_train_rows"), F.avg("target").alias("label_rate")).first().asDict()
        sc.publish(spark, root, CARD, cp.fit_card(train), found, at=cut)
        if cut == CUTS[-1]:
            m = wo.fit_woe_bins(train, [], cp.CATEGORICAL, "target")
            coefs, intercept = wo.naive_bayes_scorecard(m, train)
            sc.publish(spark, root, BLIND, cp.make_card(train, m, *wo.points_table(m, coefs, intercept)), found, at=cut)
    return root


_CUT_SQL = f"""cuts AS (SELECT * FROM (VALUES {", ".join(f"('{k + 1}', TIMESTAMP '{c}')" for k, c in enumerate(CUTS))}) c(version, since)),
ver AS (SELECT version, since, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS rate FROM cuts, orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderdate < since GROUP BY ALL)"""


@register(
    "registry_versions",
    f"WITH {_CUT_SQL} SELECT '{CARD}' AS name, version, CAST(n AS BIGINT) AS n_train_rows, round(rate, 9) AS label_rate FROM ver",
)
def registry_versions(spark, sf_dir):
    """ML9/ML11: the published versions of the credit scorecard, highest first,
    with the metrics they were registered with."""
    v = rg.list_versions(rg.versions(spark, _published(spark, sf_dir)), CARD)
    return v.select("name", "version", F.col("metrics")["n_train_rows"].cast("long").alias("n_train_rows"), F.round(F.col("metrics")["label_rate"], 9).alias("label_rate"))


@register(
    "registry_champion",
    f"""WITH {_CUT_SQL} SELECT '{CARD}' AS name, 'champion' AS alias, max_by(version, since) AS version, CAST(epoch(max(since)) AS BIGINT) AS promoted_at FROM ver
        UNION ALL SELECT '{BLIND}', 'champion', '1', CAST(epoch(TIMESTAMP '{CUTS[-1]}') AS BIGINT)""",
)
def registry_champion(spark, sf_dir):
    """ML10: the champions of the two published models."""
    p = cut_lineage(rg.promotions(spark, _published(spark, sf_dir)))
    both = rg.champion(p, CARD).unionByName(rg.champion(p, BLIND))
    return both.select("name", "alias", "version", F.unix_timestamp("promoted_at").alias("promoted_at"))


@register(
    "champion_comparison",
    f"""WITH {_CUT_SQL},
        runs AS (SELECT m.name, year(o_orderdate) AS year, count(*) AS n, make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0) AS started
                 FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('{CARD}'), ('{BLIND}')) m(name) GROUP BY ALL),
        ev AS (SELECT '{CARD}' AS name, version, since FROM ver UNION ALL SELECT '{BLIND}', '1', TIMESTAMP '{CUTS[-1]}')
        SELECT r.name, r.year, CAST(r.n AS BIGINT) AS n_rows, (SELECT max_by(e.version, e.since) FROM ev e WHERE e.name = r.name AND e.since <= r.started) AS champion FROM runs r""",
)
def champion_comparison(spark, sf_dir):
    """ML12: the yearly scoring runs of two served models, each with the version
    that was champion when it started."""
    p = rg.promotions(spark, _published(spark, sf_dir))
    a = bind_applications(spark, sf_dir).select(F.year(F.timestamp_seconds("t")).alias("year"))
    year = a.groupBy("year").agg(F.count("*").alias("n_rows"))
    runs = year.select(F.explode(F.array(F.lit(CARD), F.lit(BLIND))).alias("name"), "year", "n_rows", F.make_timestamp(F.col("year") + 1, *[F.lit(x) for x in (1, 1, 0, 0, 0)]).alias("start_time"))
    return rg.in_force(runs, p).select("name", F.col("year").cast("long").alias("year"), "n_rows", "champion")
