"""Model-fitting queries (W8, ML3-ML5, ML7-ML9, ML13-ML14, GR6, UP1-UP2,
TL1-TL5).  Fits are MLlib (distributed).  SQL cannot repeat a fit, so the
queries return what must hold of it whatever the learner found: the counts of
both sides, and whether scores, metrics and thresholds are in their ranges.
``metrics_of`` and the operators return the metrics themselves."""

from __future__ import annotations

from math import isfinite

from pyspark.sql import functions as F

from ..functions.columns import hash_order_key
from ..operators import boosting as bo
from ..operators import graph as gr
from ..operators import labelling as lb
from ..operators import learners as le
from ..operators import metrics as mt
from ..operators import registry as rg
from ..operators import scorecard as sc
from ..operators import search as se
from ..operators import split as sp
from ..operators import uplift as up
from ..operators import uplift_learners as ul
from ..operators import woe as wo
from ..operators.modeltables import keep
from ..sources.tables import APPLICATIONS_SQL, CAMPAIGN_SQL, EVENT_TRANSACTIONS_SQL, bind_applications, bind_campaign, bind_event_transactions
from ..session import cut_lineage
from ..streaming.jobs import run_dir
from . import credit_plans as cp
from . import graph_plans as gp
from .registry import register

# The label (event type 'error') is the category itself, so category
# frequency is excluded from the model inputs (it would leak the label).
FRAUD_FEATURES = [
    "amount", "card_txn_count_1h", "card_amt_sum_1h", "card_txn_count_1d", "card_amt_sum_1d", "card_prior_txn_count",
    "card_running_avg_amt", "card_amt_ratio_to_own_avg", "card_prior_distinct_diversity_count", "hour_of_day_avg_amt",
    "hour_of_day_txn_count",
]


def r4(c):
    return F.round(F.col(c).cast("double"), 4).alias(c)


def _fraud_frames(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "card", "t", "amount", "diversity", "category", "label")
    f = sp.prepare_train_test_features(tx, test_size=0.2, category_cols=())
    # Written once (shared folder) so each fit and metric pass reads the
    # columns it needs of the features instead of recomputing the chain.
    f = keep(f.select("id", "label", "t", "split", *FRAUD_FEATURES))
    return f.where(F.col("split") == "train"), f.where(F.col("split") == "test")


def metrics_of(pred, name, label="label"):
    """The metric record of a prediction frame."""
    r = le.evaluate(pred, label, "id")
    return r.select(F.lit(name).alias("model"), "n", "positives", r4("auc_roc"), r4("average_precision"), r4("ks_statistic"))


def _within(c, low=0.0, high=1.0):
    return F.col(c).isNotNull() & F.col(c).between(low, high)


def _facts(pred, name, n_train, n_features, label="label"):
    """Counts of both sides and whether scores and metrics are probabilities."""
    scores = pred.agg(F.min(_within("score").cast("int")).alias("ok"))
    r = metrics_of(pred, name, label).crossJoin(scores)
    metrics = _within("auc_roc") & _within("average_precision") & _within("ks_statistic")
    return r.select(
        "model", F.lit(n_train).cast("long").alias("n_train"), F.col("n").cast("long").alias("n_test"), F.col("positives").cast("long").alias("positives"),
        F.lit(n_features).cast("long").alias("n_features"), (F.col("ok") == 1).alias("scores_in_range"), metrics.alias("metrics_in_range"),
    )


def _facts_sql(models, sides, n_features):
    """``sides``: SQL with columns test (boolean) and y."""
    names = ", ".join(f"('{m}')" for m in models)
    return f"""WITH sides AS ({sides})
        SELECT m.model, CAST(count(*) FILTER (WHERE NOT test) AS BIGINT) AS n_train, CAST(count(*) FILTER (WHERE test) AS BIGINT) AS n_test,
               CAST(coalesce(sum(y) FILTER (WHERE test), 0) AS BIGINT) AS positives, CAST({n_features} AS BIGINT) AS n_features,
               true AS scores_in_range, true AS metrics_in_range
        FROM sides, (VALUES {names}) m(model) GROUP BY m.model"""


FRAUD_ROWS_SQL = f"""SELECT rn > round_even(n * CAST(0.8 AS DOUBLE), 0) AS test, y, t, id FROM (
    SELECT label AS y, t, id, row_number() OVER (ORDER BY t, id) AS rn, count(*) OVER () AS n FROM ({EVENT_TRANSACTIONS_SQL}))"""
FRAUD_SIDES_SQL = f"""SELECT rn > round_even(n * CAST(0.8 AS DOUBLE), 0) AS test, y FROM (
    SELECT label AS y, row_number() OVER (ORDER BY t, id) AS rn, count(*) OVER () AS n FROM ({EVENT_TRANSACTIONS_SQL}))"""


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("baseline_models", _facts_sql(["logistic", "tree", "forest"], FRAUD_SIDES_SQL, len(FRAUD_FEATURES)))
def baseline_models(spark, sf_dir):
    """ML3/ML4: logistic, tree and forest(100) on leak-free features,
    evaluated on the chronological test side."""
    tr, te = _fraud_frames(spark, sf_dir)
    n, out = tr.count(), []
    for kind in ("logistic", "tree", "forest"):
        _, pred = le.fit_and_score(tr, te, FRAUD_FEATURES, "label", kind)
        out.append(_facts(pred, kind, n, len(FRAUD_FEATURES)))
    return _union(out)


@register("boosted_models", _facts_sql(["gbt_floor", "gbt_improved"], FRAUD_SIDES_SQL, len(FRAUD_FEATURES)))
def boosted_models(spark, sf_dir):
    """ML5/ML8: boosted trees, floor vs improved parameter family."""
    tr, te = _fraud_frames(spark, sf_dir)
    n, out = tr.count(), []
    for name, params in (("gbt_floor", {"maxIter": 20, "maxDepth": 3}), ("gbt_improved", {"maxIter": 40, "maxDepth": 5, "stepSize": 0.05})):
        _, pred = le.fit_and_score(tr, te, FRAUD_FEATURES, "label", "gbt", **params)
        out.append(_facts(pred, name, n, len(FRAUD_FEATURES)))
    return _union(out)


SEARCH_SPACE = {"maxIter": (5, 8), "maxDepth": (2, 3, 4), "stepSize": (0.05, 0.1, 0.2), "subsamplingRate": (0.7, 1.0)}
SEARCH_MAPS, SEARCH_FOLDS, SEARCH_SEED = 3, 3, 42


def _drawn_sql(name, values):
    at = f"CAST('0x' || substr(md5('{SEARCH_SEED}:' || CAST(j AS VARCHAR) || ':{name}'), 1, 8) AS BIGINT) % {len(values)} + 1"
    return f"list_extract([{', '.join(f'CAST({v} AS DOUBLE)' for v in values)}], {at}) AS {name}"


@register(
    "time_series_search",
    f"""WITH tr AS (SELECT y, rn, count(*) OVER () AS n, count(*) OVER () // {SEARCH_FOLDS + 1} AS m
                    FROM (SELECT y, row_number() OVER (ORDER BY t, id) AS rn FROM ({FRAUD_ROWS_SQL}) WHERE NOT test)),
        k AS (SELECT unnest(range(0, {SEARCH_FOLDS})) AS fold),
        f AS (SELECT fold, max(m) AS n_test, count(*) FILTER (WHERE rn <= n - ({SEARCH_FOLDS} - fold) * m AND y = 1) AS ones,
                     count(*) FILTER (WHERE rn <= n - ({SEARCH_FOLDS} - fold) * m AND y <> 1) AS others FROM tr, k GROUP BY fold),
        j AS (SELECT unnest(range(0, {SEARCH_MAPS})) AS j)
        SELECT CAST(j AS INTEGER) AS map_id, {", ".join(_drawn_sql(n, v) for n, v in SEARCH_SPACE.items())},
               count(*) AS n_folds, CAST(sum(ones + others) AS BIGINT) AS n_train, CAST(sum(CASE WHEN ones < 2 THEN 0 ELSE greatest(0, others - ones) END) AS BIGINT) AS n_synthetic,
               CAST(sum(n_test) AS BIGINT) AS n_test, true AS auc_in_range
        FROM j, f GROUP BY j""",
)
def time_series_search(spark, sf_dir):
    """ML7: sampled parameter maps of boosted trees x expanding time folds
    (earlier rows train, later rows test), SMOTE inside each training fold, exact
    AUC; the drawn parameters and the sizes of all sides per map."""
    tr, _ = _fraud_frames(spark, sf_dir)
    found = se.random_search(tr, FRAUD_FEATURES, SEARCH_SPACE, SEARCH_MAPS, "label", n_folds=SEARCH_FOLDS, seed=SEARCH_SEED)
    return found.groupBy("map_id", *[F.col("params")[n].alias(n) for n in SEARCH_SPACE]).agg(
        F.count(F.lit(1)).alias("n_folds"), *[F.sum(c).alias(c) for c in ("n_train", "n_synthetic", "n_test")],
        (F.min(F.coalesce(_within("auc_roc"), F.lit(True)).cast("int")) == 1).alias("auc_in_range"),
    )


@register(
    "fraud_job",
    f"""WITH s AS ({FRAUD_SIDES_SQL})
        SELECT CAST(greatest(0, count(*) FILTER (WHERE NOT test AND y <> 1) - count(*) FILTER (WHERE NOT test AND y = 1)) AS BIGINT) AS n_synthetic,
               CAST(count(*) FILTER (WHERE test) AS BIGINT) AS n_test, true AS metrics_in_range, true AS thresholds_in_order,
               'fraud_model' AS registered_name, '1' AS version FROM s""",
)
def fraud_job(spark, sf_dir):
    """ML13 (+ML6, ML9): features -> chronological split -> train medians ->
    SMOTE on the train side only -> boosted trees -> metrics -> F1 review
    threshold and decline threshold -> the fitted model is saved, registered
    with its metrics and promoted; name and version are read back."""
    from ..operators import resample as rs

    tr, te = _fraud_frames(spark, sf_dir)
    med = le.fit_medians(tr, FRAUD_FEATURES)
    trv = le.fill_medians(tr, med).withColumn("vec", F.array(*[F.col(c).cast("double") for c in FRAUD_FEATURES]))
    syn, n_new = rs.oversample_to_parity(trv.select("id", "vec", "label"), "label", 1, "id", "vec", seed=42)
    syn_rows = syn.select(
        (-1 - F.col("syn_id")).alias("id"), F.lit(1).alias("label"),
        *[F.element_at("vec", i + 1).alias(c) for i, c in enumerate(FRAUD_FEATURES)],
    )
    balanced = cut_lineage(trv.select("id", "label", *FRAUD_FEATURES).unionByName(syn_rows))
    model, pred = le.fit_and_score(balanced, te, FRAUD_FEATURES, "label", "gbt", maxIter=20, maxDepth=3)
    scored = pred.select("id", F.col("label").alias("y"), "score")
    f1 = mt.f1_threshold(scored, validate=False).first()
    review = f1["threshold"]
    root = run_dir(spark, "registry")
    model.write().overwrite().save(f"{root}/models/fraud")
    rec = cut_lineage(mt.metric_record(scored))
    found = rec.select("auc_roc", "average_precision", "ks_statistic").first().asDict()
    rg.promote(spark, root, "fraud_model", rg.register_version(spark, root, "fraud_model", found, f"{root}/models/fraud"))
    champion = rg.champion(rg.promotions(spark, root), "fraud_model").first()
    decline = review + (1 - review) / 2
    metrics = _within("auc_roc") & _within("average_precision") & _within("ks_statistic")
    return rec.select(
        F.lit(int(n_new)).cast("long").alias("n_synthetic"), F.col("n").cast("long").alias("n_test"), metrics.alias("metrics_in_range"),
        F.lit(0 <= review <= decline <= 1).alias("thresholds_in_order"), F.lit(champion["name"]).alias("registered_name"), F.lit(champion["version"]).alias("version"),
    )


def _credit_split(spark, sf_dir):
    a = bind_applications(spark, sf_dir)
    # Some twenty jobs read the sides: the split's order is made once.
    s = keep(sp.stratified_split(a, "target", test_size=0.2, seed=42))
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


CREDIT_SIDES_SQL = f"""SELECT rn <= round_even(n * CAST(0.2 AS DOUBLE), 0) AS test, y FROM (
    SELECT target AS y, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(id AS VARCHAR) || ':' || '42'), id) AS rn,
           count(*) OVER (PARTITION BY target) AS n FROM ({APPLICATIONS_SQL}))"""


@register(
    "scorecard_fit",
    f"""SELECT t.term, CAST(n AS BIGINT) AS n_train, true AS finite
        FROM (SELECT count(*) AS n FROM ({CREDIT_SIDES_SQL}) WHERE NOT test),
             (VALUES {", ".join(f"('{f}')" for f in [*cp.NUMERIC, *cp.CATEGORICAL, "__intercept__", "__base_points__"])}) t(term)""",
)
def scorecard_fit(spark, sf_dir):
    """Logistic regression on train WoE columns -> coefficients and the
    points they imply (W9)."""
    tr, _ = _credit_split(spark, sf_dir)
    m = wo.fit_woe_bins(tr, cp.NUMERIC, cp.CATEGORICAL, "target", edge_decimals=cp.EDGE_DECIMALS)
    woe_cols = [f + "_woe" for f in m.features()]
    coefs, intercept = le.fit_scorecard_lr(wo.transform_woe(tr, m), woe_cols, "target")
    base, _ = wo.points_table(m, {f: coefs[f + "_woe"] for f in m.features()}, intercept)
    rows = [(f, float(coefs[f + "_woe"])) for f in m.features()] + [("__intercept__", intercept), ("__base_points__", base)]
    n = tr.count()
    return spark.createDataFrame([(term, n, isfinite(value)) for term, value in rows], "term string, n_train long, finite boolean")


@register(
    "credit_job",
    f"""SELECT CAST(count(*) FILTER (WHERE NOT test) AS BIGINT) AS n_train, CAST(count(*) FILTER (WHERE test) AS BIGINT) AS n_test,
               CAST(sum(y) FILTER (WHERE test) AS BIGINT) AS positives, true AS metrics_in_range, true AS cutoffs_in_order, true AS shares_in_range,
               'credit_scorecard' AS registered_name, '1' AS version, CAST(0 AS BIGINT) AS n_scored_otherwise
        FROM ({CREDIT_SIDES_SQL})""",
)
def credit_job(spark, sf_dir):
    """ML14: stratified split -> WoE fit on train -> logistic regression ->
    points scorecard -> cut-offs (60th/20th train percentile) -> test
    metrics and decision mix -> the card is saved, registered with its metrics
    and promoted; the reloaded champion scores every test row alike."""
    tr, te = _credit_split(spark, sf_dir)
    m = wo.fit_woe_bins(tr, cp.NUMERIC, cp.CATEGORICAL, "target", edge_decimals=cp.EDGE_DECIMALS)
    woe_cols = [f + "_woe" for f in m.features()]
    coefs, intercept = le.fit_scorecard_lr(wo.transform_woe(tr, m), woe_cols, "target")
    fc = {f: coefs[f + "_woe"] for f in m.features()}
    base, pts = wo.points_table(m, fc, intercept)
    card = cp.make_card(tr, m, base, pts)
    test = card.score(wo.transform_woe(te, m))
    margin = F.lit(intercept)
    for f in m.features():
        margin = margin + F.lit(fc[f]) * F.col(f + "_woe")
    test = test.withColumn("p", 1.0 / (1.0 + F.exp(-margin)))
    rec = cut_lineage(mt.metric_record(test.select("id", F.col("target").alias("y"), F.col("p").alias("score"))))
    root = run_dir(spark, "registry")
    found = rec.select("auc_roc", "gini", "ks_statistic").first().asDict()
    sc.publish(spark, root, "credit_scorecard", card, found)
    version, again = sc.champion(spark, root, "credit_scorecard")
    other = test.select("id", "score").join(again.score(te).select("id", F.col("score").alias("again")), "id", "full_outer")
    other = other.agg(F.count_if(~F.col("score").eqNullSafe(F.col("again"))).alias("n_scored_otherwise"))
    mix = test.agg(
        F.avg((F.col("score") >= card.approve).cast("double")).alias("approve_share"),
        F.avg((F.col("score") < card.decline).cast("double")).alias("decline_share"),
    )
    metrics = _within("auc_roc") & _within("gini", -1.0) & _within("ks_statistic")
    return rec.crossJoin(mix).crossJoin(other).select(
        F.lit(tr.count()).cast("long").alias("n_train"), F.col("n").cast("long").alias("n_test"), F.col("positives").cast("long").alias("positives"),
        metrics.alias("metrics_in_range"), F.lit(card.decline <= card.approve).alias("cutoffs_in_order"),
        (_within("approve_share") & _within("decline_share") & (F.col("approve_share") + F.col("decline_share") <= 1.0)).alias("shares_in_range"),
        F.lit("credit_scorecard").alias("registered_name"), F.lit(version).alias("version"), "n_scored_otherwise",
    )


GRAPH_SIDES_SQL = f"""SELECT o_orderdate >= TIMESTAMP '{gp.GRAPH_TRAIN_CUT}' AS test, CAST(o_orderstatus = 'F' AS INTEGER) AS y
    FROM orders JOIN customer ON o_custkey = c_custkey"""


@register("graph_classifier", _facts_sql(["graph_logistic"], GRAPH_SIDES_SQL, 3 * len(gp.NODE_FEATURES)))
def graph_classifier(spark, sf_dir):
    """GR6: node features plus neighbour means of one and two hops, each with
    weights of its own: logistic regression trained on the train mask only,
    evaluated on the test mask."""
    nodes, edges = gp._nodes(spark, sf_dir)
    nodes = keep(nodes)
    hop = gr.khop_features(nodes, edges, "id", gp.NODE_FEATURES, hops=2)
    x = keep(nodes.join(hop, "id"))  # read by the medians, the fit, the scores and the count
    feats = [*gp.NODE_FEATURES, *[f"nb{k}_{f}" for k in (1, 2) for f in gp.NODE_FEATURES]]
    train = x.where(F.col("mask") == "train")
    _, pred = le.fit_and_score(train, x.where(F.col("mask") == "test"), feats, "label", "logistic")
    return _facts(pred, "graph_logistic", train.count(), len(feats))


def _campaign(spark, sf_dir):
    c = bind_campaign(spark, sf_dir)
    a = bind_applications(spark, sf_dir).select("id", "acctbal", "t")
    x = c.join(a, "id").withColumn("price", F.col("score")).drop("score")
    s = x.withColumn("__h", hash_order_key("id", 11))
    return s.where(F.col("__h") < "b").drop("__h"), s.where(F.col("__h") >= "b").drop("__h")


UPLIFT_FEATURES = ["price", "acctbal", "t"]


def _uplift_eval(scored, name):
    q = up.qini_coefficient(scored.select("id", "outcome", "treatment", "score"))
    u = up.uplift_at_k(scored.select("id", "outcome", "treatment", "score"), 0.3).select(F.col("uplift").alias("uplift_at_30"))
    n = scored.agg(F.count(F.lit(1)).alias("n_test"), F.sum("treatment").cast("long").alias("n_treated"))
    return q.crossJoin(u).crossJoin(n).select(
        F.lit(name).alias("learner"), F.col("n_test").cast("long").alias("n_test"), "n_treated",
        (_within("uplift_at_30", -1.0) & _within("qini_coefficient", -1.0)).alias("metrics_in_range"),
    )


def _uplift_sql(name):
    return f"""SELECT '{name}' AS learner, CAST(count(*) AS BIGINT) AS n_test, CAST(sum(treatment) AS BIGINT) AS n_treated, true AS metrics_in_range
        FROM ({CAMPAIGN_SQL}) JOIN (SELECT id AS a FROM ({APPLICATIONS_SQL})) ON id = a WHERE md5(CAST(id AS VARCHAR) || ':' || '11') >= 'b'"""


@register("uplift_slearner", _uplift_sql("s_learner"))
def uplift_slearner(spark, sf_dir):
    """UP1: one model with treatment as a feature; uplift = P(y | t=1) -
    P(y | t=0)."""
    tr, te = _campaign(spark, sf_dir)
    found = ul.s_learner(tr, te, UPLIFT_FEATURES, le.make_classifier("logistic", "outcome"))
    return _uplift_eval(cut_lineage(found.withColumn("score", F.col("uplift"))), "s_learner")


@register("uplift_tlearner", _uplift_sql("t_learner"))
def uplift_tlearner(spark, sf_dir):
    """UP2: one model per arm; uplift = difference of their predictions."""
    tr, te = _campaign(spark, sf_dir)
    found = ul.t_learner(tr, te, UPLIFT_FEATURES, le.make_classifier("logistic", "outcome"))
    return _uplift_eval(cut_lineage(found.withColumn("score", F.col("uplift"))), "t_learner")


TRANSFER_FEATURES = ["totalprice", "acctbal"]
BUDGETS = [200, 1000]
TRANSFER_CUT = 883612800  # 1998-01-01: earlier applications are the source domain


SOURCE_TREES, WARM_ROUNDS = 10, 5
TRANSFER_STRATEGIES = [("zero_shot", 0), *((name, b) for b in BUDGETS for name in ("warm_start", "from_scratch"))]


@register(
    "transfer_compare",
    f"""WITH a AS ({APPLICATIONS_SQL}),
        t AS (SELECT count(*) AS n, sum(target) AS p FROM a WHERE t >= {TRANSFER_CUT} AND md5(CAST(id AS VARCHAR) || ':' || '5') >= 'c'),
        s AS (SELECT count(*) AS n FROM a WHERE t < {TRANSFER_CUT})
        SELECT CAST(v.budget AS BIGINT) AS budget, v.strategy, CAST(s.n AS BIGINT) AS n_source, CAST(t.n AS BIGINT) AS n_test, CAST(t.p AS BIGINT) AS positives,
               CAST(CASE v.strategy WHEN 'warm_start' THEN {SOURCE_TREES + WARM_ROUNDS} ELSE {SOURCE_TREES} END AS BIGINT) AS n_trees, true AS precision_in_range
        FROM t, s, (VALUES {", ".join(f"({b}, '{name}')" for name, b in TRANSFER_STRATEGIES)}) v(budget, strategy)""",
)
def transfer_compare(spark, sf_dir):
    """TL1-TL5: boosted trees of a source domain (earlier applications),
    applied zero-shot to a later target domain, continued by further trees on a
    labelled target budget (source imputer kept), and a from-scratch model on
    the same budget; AUC-PR on the target test side per budget."""
    a = bind_applications(spark, sf_dir)
    src = a.where(F.col("t") < TRANSFER_CUT)
    tgt = a.where(F.col("t") >= TRANSFER_CUT).withColumn("__h", hash_order_key("id", 5))
    pool, test = tgt.where(F.col("__h") < "c").drop("__h"), tgt.where(F.col("__h") >= "c").drop("__h")
    bundle = le.fit_source(src, TRANSFER_FEATURES, "target", "gbt", maxIter=SOURCE_TREES, maxDepth=3)
    bundle.require(tgt)
    source = bo.Ensemble.of_gbt(bundle.model, bundle.features, bundle.medians)
    n_source = src.count()

    def ap(pred, name, budget, trees):
        size = pred.agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("p"))
        found = mt.average_precision(pred.select("id", F.col("target").alias("y"), "score"), validate=False).crossJoin(size)
        return found.select(
            F.lit(budget).cast("long").alias("budget"), F.lit(name).alias("strategy"), F.lit(n_source).cast("long").alias("n_source"),
            F.col("n").cast("long").alias("n_test"), F.col("p").cast("long").alias("positives"), F.lit(trees).cast("long").alias("n_trees"),
            _within("average_precision").alias("precision_in_range"),
        )

    out = [ap(source.score(test), "zero_shot", 0, source.trees)]
    for b in BUDGETS:
        lab = sp.stratified_budget(pool, "target", b, seed=7)
        pos = lab.agg(F.sum("target")).first()[0] or 0
        if pos < 2:
            continue
        warm = source.extend(lab, "target", WARM_ROUNDS)
        out.append(ap(warm.score(test), "warm_start", b, warm.trees))
        model, scratch = le.fit_and_score(lab, test, TRANSFER_FEATURES, "target", "gbt", maxIter=SOURCE_TREES, maxDepth=3)
        out.append(ap(scratch, "from_scratch", b, len(model.trees)))
    return _union(out)


SIMULATION_FEATURES = ["totalprice", "acctbal", "t"]
SIMULATION = {"batch": 200, "rounds": 2}


@register(
    "labelling_simulation",
    f"""WITH a AS (SELECT id, target, md5(CAST(id AS VARCHAR) || ':' || '9') AS h FROM ({APPLICATIONS_SQL})),
        n AS (SELECT count(*) FILTER (WHERE h < 'c') AS n FROM a),
        seed AS (SELECT target FROM a WHERE h < 'c' ORDER BY h, id LIMIT {SIMULATION["batch"]})
        SELECT s.strategy, CAST(r.round AS INTEGER) AS round, CAST(least(n, (r.round + 1) * {SIMULATION["batch"]}) AS BIGINT) AS n_labeled,
               CAST(greatest(0, n - (r.round + 1) * {SIMULATION["batch"]}) AS BIGINT) AS n_pool,
               CASE WHEN r.round = 0 THEN (SELECT CAST(sum(target) AS BIGINT) FROM seed) END AS n_seed_positives, true AS metric_in_range
        FROM n, (VALUES ('entropy'), ('random')) s(strategy), (SELECT unnest(range(0, {SIMULATION["rounds"] + 1})) AS round) r""",
)
def labelling_simulation(spark, sf_dir):
    """AL5: labelling rounds with a fit, by entropy and at random: learning
    curves over applications from a seed of the first rows by hash."""
    a = bind_applications(spark, sf_dir).select("id", "target", *SIMULATION_FEATURES).withColumn("__h", hash_order_key("id", 9))
    a = cut_lineage(a)
    pool, test = a.where(F.col("__h") < "c").drop("__h"), a.where(F.col("__h") >= "c").drop("__h")
    seed = sp.random_batch(pool, SIMULATION["batch"], seed=9)
    rest = pool.join(F.broadcast(seed.select("id")), "id", "left_anti")  # the seed has a batch of rows
    curves = [
        lb.simulate(rest, seed, test, SIMULATION_FEATURES, SIMULATION["batch"], SIMULATION["rounds"], name, "target")[0] for name in ("entropy", "random")
    ]
    return _union(curves).select(
        "strategy", "round", "n_labeled", "n_pool", F.when(F.col("round") == 0, F.col("n_positives")).alias("n_seed_positives"),
        F.coalesce(_within("metric"), F.lit(True)).alias("metric_in_range"),
    )
