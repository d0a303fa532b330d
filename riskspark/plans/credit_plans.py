"""Queries for WoE/IV, the points scorecard, cut-offs and PSI (W1-W7,
W9-W11, PF3, PF6, PF9, PS1-PS5)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import drift as dr
from ..operators import policy as po
from ..operators import scorecard as sc
from ..operators import woe as wo
from ..operators.registry import PsiReference
from ..sources.tables import APPLICATIONS_SQL, DRIFT_FEATURES, bind_applications, bind_drift_pair, table
from .registry import register

# Train side of the credit role: applications (orders) dated before this.
CREDIT_TRAIN_T = 915148800  # 1999-01-01 00:00:00 UTC
NUMERIC = ["totalprice", "acctbal"]
CATEGORICAL = ["priority", "segment"]
EDGE_DECIMALS = 6


def r9(c, name=None):
    return F.round(F.col(c).cast("double"), 9).alias(name or c)


CREDIT_TRAIN_BEFORE = "1999-01-01"  # the same instant as CREDIT_TRAIN_T


def _apps(spark, sf_dir):
    a = bind_applications(spark, sf_dir)
    return a, bind_applications(spark, sf_dir, orders_before=CREDIT_TRAIN_BEFORE)


def _fit(spark, sf_dir):
    a, tr = _apps(spark, sf_dir)
    return a, tr, wo.fit_woe_bins(tr, NUMERIC, CATEGORICAL, "target", edge_decimals=EDGE_DECIMALS)


# ---------------------------------------------------------------------------
# SQL builders for the oracle (DuckDB)
# ---------------------------------------------------------------------------

def _q_list(x, n_bins, filt=""):
    qs = ", ".join(repr(i / n_bins) for i in range(n_bins + 1))
    return f"list_sort(list_distinct(list_transform(quantile_cont({x}, [{qs}]){filt}, lambda v: round(v, {EDGE_DECIMALS}))))"


def _interior(name):
    return f"CASE WHEN len({name}) < 2 THEN CAST([] AS DOUBLE[]) ELSE list_slice({name}, 2, len({name}) - 1) END"


def _num_label(x, edges, specials=()):
    parts = [f"CASE WHEN {x} IS NULL THEN '__MISSING__'"]
    for s in specials:
        parts.append(f"WHEN {x} = {float(s)!r} THEN '{wo.special_label(s)}'")
    parts.append(f"ELSE 'bin_' || CAST(len(list_filter({edges}, lambda v: v < {x})) AS VARCHAR) END")
    return " ".join(parts)


def woe_ctes(src, train_cond, numeric, categorical, target, n_bins=5, specials=None):
    """CTEs: src, tr, qe (raw quantile lists), e (interior edges), lab
    (train labels), long, g (counts), w (woe table)."""
    specials = specials or {}
    q = []
    for f in numeric:
        sp = specials.get(f)
        filt = f" FILTER (WHERE {f} NOT IN ({', '.join(repr(float(s)) for s in sp)}))" if sp else ""
        q.append(f"{_q_list(f, n_bins, filt)} AS q_{f}")
    e = [f"{_interior('q_' + f)} AS e_{f}" for f in numeric]
    labels = [f"{_num_label(f, 'e_' + f, specials.get(f, ()))} AS {f}" for f in numeric]
    labels += [f"coalesce(CAST({c} AS VARCHAR), '__MISSING__') AS {c}" for c in categorical]
    longs = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS bin, {target} AS y FROM lab" for f in [*numeric, *categorical])
    return f"""
src AS ({src}),
tr AS (SELECT * FROM src WHERE {train_cond}),
qe AS (SELECT {', '.join(q) if q else '1 AS dummy'} FROM tr),
e AS (SELECT {', '.join(e) if e else '1 AS dummy2'} FROM qe),
lab AS (SELECT {target}, {', '.join(labels)} FROM tr, e),
long AS ({longs}),
g AS (SELECT feature, bin, count(*) AS n, sum(y) AS bad, count(*) - sum(y) AS good FROM long GROUP BY feature, bin),
w AS (SELECT *, (good + 0.5) / (sum(good) OVER (PARTITION BY feature) + 0.5 * count(*) OVER (PARTITION BY feature)) AS dg,
             (bad + 0.5) / (sum(bad) OVER (PARTITION BY feature) + 0.5 * count(*) OVER (PARTITION BY feature)) AS db FROM g),
woe AS (SELECT feature, bin, n, bad, good, ln(dg / db) AS woe, (dg - db) * ln(dg / db) AS iv FROM w)"""


def applied_labels_cte(numeric, categorical, specials=None, name="alab", src="src"):
    specials = specials or {}
    labels = [f"{_num_label(f, 'e_' + f, specials.get(f, ()))} AS {f}_bin" for f in numeric]
    labels += [
        f"CASE WHEN {c} IS NULL THEN '__MISSING__' WHEN CAST({c} AS VARCHAR) IN (SELECT bin FROM woe WHERE feature = '{c}') "
        f"THEN CAST({c} AS VARCHAR) ELSE '__UNSEEN__' END AS {c}_bin"
        for c in categorical
    ]
    return f"{name} AS (SELECT {src}.*, {', '.join(labels)} FROM {src}, e)"


CREDIT_CTES = woe_ctes(APPLICATIONS_SQL, f"t < {CREDIT_TRAIN_T}", NUMERIC, CATEGORICAL, "target")


@register(
    "woe_edges",
    f"""WITH {CREDIT_CTES.strip()},
        ed AS (SELECT 'totalprice' AS feature, e_totalprice AS es FROM e UNION ALL SELECT 'acctbal', e_acctbal FROM e)
        SELECT feature, CAST(i AS BIGINT) AS edge_index, round(es[i], 9) AS edge
        FROM ed, range(1, len(es) + 1) AS r(i)""",
)
def woe_edges(spark, sf_dir):
    """Interior train-quantile edges per numeric feature."""
    _, tr = _apps(spark, sf_dir)
    edges = wo.fit_edges(tr, NUMERIC, 5, decimals=EDGE_DECIMALS)
    rows = [(f, i + 1, float(e)) for f, es in edges.items() for i, e in enumerate(es)]
    return spark.createDataFrame(rows, "feature string, edge_index long, edge double").select(
        "feature", "edge_index", r9("edge")
    )


LINE_SQL = """SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS target,
       l_quantity, l_discount, CAST(l_partkey AS VARCHAR) AS part,
       CAST(floor(epoch_us(l_shipdate) / 1000000) AS BIGINT) AS t
FROM lineitem"""
LINE_TRAIN_T = 852076800  # 1997-01-01 00:00:00 UTC
LINE_SPECIALS = {"l_discount": [0.0]}


def _lines(spark, sf_dir):
    from ..sources.tables import epoch_seconds

    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("target"),
        "l_quantity", "l_discount", F.col("l_partkey").cast("string").alias("part"), epoch_seconds("l_shipdate").alias("t"),
    )


LINE_CTES = woe_ctes(LINE_SQL, f"t < {LINE_TRAIN_T}", ["l_quantity", "l_discount"], ["part"], "target", specials=LINE_SPECIALS)


@register(
    "woe_bin_numeric",
    f"""WITH {LINE_CTES.strip()}, {applied_labels_cte(['l_quantity', 'l_discount'], [], LINE_SPECIALS)}
        SELECT l_orderkey, l_linenumber, l_quantity_bin, l_discount_bin FROM alab""",
)
def woe_bin_numeric(spark, sf_dir):
    """W1 on line items: discount 0.0 is a special value with its own bin."""
    li = _lines(spark, sf_dir)
    m = wo.fit_woe_bins(li.where(F.col("t") < LINE_TRAIN_T), ["l_quantity", "l_discount"], ["part"], "target",
                        special_values=LINE_SPECIALS, edge_decimals=EDGE_DECIMALS)
    out = wo.assign_bins(li, WoeModelView(m, ["l_quantity", "l_discount"], []))
    return out.select("l_orderkey", "l_linenumber", "l_quantity_bin", "l_discount_bin")


class WoeModelView(wo.WoeModel):
    """A model restricted to some features (shares the fitted state)."""

    def __init__(self, m, numeric, categorical):
        super().__init__(numeric, categorical, m.edges, m.specials, m.table, m.target, m.extra)


@register(
    "woe_bin_categorical",
    f"""WITH {LINE_CTES.strip()}, {applied_labels_cte([], ['part'])}
        SELECT l_orderkey, l_linenumber, part_bin FROM alab""",
)
def woe_bin_categorical(spark, sf_dir):
    """Part keys fitted on early line items; later unseen parts ->
    __UNSEEN__."""
    li = _lines(spark, sf_dir)
    m = wo.fit_woe_bins(li.where(F.col("t") < LINE_TRAIN_T), ["l_quantity", "l_discount"], ["part"], "target",
                        special_values=LINE_SPECIALS, edge_decimals=EDGE_DECIMALS)
    out = wo.assign_bins(li, WoeModelView(m, [], ["part"]))
    return out.select("l_orderkey", "l_linenumber", "part_bin")


@register(
    "woe_iv_table",
    f"""WITH {CREDIT_CTES.strip()}
        SELECT feature, bin, CAST(n AS BIGINT) AS n, CAST(bad AS BIGINT) AS bad, CAST(good AS BIGINT) AS good,
               round(woe, 9) AS woe, round(iv, 9) AS iv FROM woe""",
)
def woe_iv_table(spark, sf_dir):
    _, _, m = _fit(spark, sf_dir)
    return m.table.select("feature", "bin", F.col("n").cast("long").alias("n"), F.col("bad").cast("long").alias("bad"),
                          F.col("good").cast("long").alias("good"), r9("woe"), r9("iv"))


def _woe_lookup_sql(f):
    return f"coalesce((SELECT woe FROM woe WHERE feature = '{f}' AND bin = alab.{f}_bin), 0.0)"


@register(
    "woe_transform",
    f"""WITH {CREDIT_CTES.strip()}, {applied_labels_cte(NUMERIC, CATEGORICAL)}
        SELECT id, {', '.join(f'round({_woe_lookup_sql(f)}, 9) AS {f}_woe' for f in [*NUMERIC, *CATEGORICAL])}
        FROM alab""",
)
def woe_transform(spark, sf_dir):
    a, _, m = _fit(spark, sf_dir)
    out = wo.transform_woe(a, m)
    return out.select("id", *[r9(f + "_woe") for f in [*NUMERIC, *CATEGORICAL]])


IV_REPORT_SQL = f"""WITH {CREDIT_CTES.strip()}
SELECT feature, round(sum(iv), 9) AS total_iv,
       CASE WHEN sum(iv) < 0.02 THEN 'not_useful' WHEN sum(iv) < 0.1 THEN 'weak' WHEN sum(iv) < 0.3 THEN 'medium'
            WHEN sum(iv) < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength
FROM woe GROUP BY feature"""


@register("iv_report", IV_REPORT_SQL)
def iv_report(spark, sf_dir):
    _, _, m = _fit(spark, sf_dir)
    return wo.iv_report(m).select("feature", r9("total_iv"), "strength")


MIN_IV = 0.0001


@register(
    "iv_selection",
    f"""WITH {CREDIT_CTES.strip()}
        SELECT feature, round(sum(iv), 9) AS total_iv FROM woe GROUP BY feature HAVING sum(iv) >= {MIN_IV}""",
)
def iv_selection(spark, sf_dir):
    """PF9: features whose IV reaches the floor, highest first."""
    _, _, m = _fit(spark, sf_dir)
    return wo.select_by_iv(m, MIN_IV).select("feature", r9("total_iv"))


# --- scorecard with the fit-free naive-Bayes coefficients -------------------

FACTOR = wo.DEFAULT_PDO / math.log(2)
OFFSET = wo.DEFAULT_BASE_SCORE - FACTOR * math.log(wo.DEFAULT_BASE_ODDS)

SCORECARD_CTES = f"""{CREDIT_CTES.strip()},
base AS (SELECT {OFFSET!r} - {FACTOR!r} * ln(sum(target) / (count(*) - sum(target))) AS base_points FROM tr),
pts AS (SELECT feature, bin, woe, -{FACTOR!r} * (-1.0) * woe AS points FROM woe)"""


@register(
    "scorecard_points",
    f"""WITH {SCORECARD_CTES}
        SELECT feature, bin, round(points, 6) AS points FROM pts
        UNION ALL SELECT '__base__', '', round(base_points, 6) FROM base""",
)
def scorecard_points(spark, sf_dir):
    _, tr, m = _fit(spark, sf_dir)
    coefs, intercept = wo.naive_bayes_scorecard(m, tr)
    base, pts = wo.points_table(m, coefs, intercept)
    base_row = spark.createDataFrame([("__base__", "", float(base))], "feature string, bin string, points double")
    return pts.select("feature", "bin", "points").unionByName(base_row).select("feature", "bin", F.round("points", 6).alias("points"))


def _pts_lookup_sql(f):
    return f"coalesce((SELECT points FROM pts WHERE feature = '{f}' AND bin = alab.{f}_bin), 0.0)"


SCORE_SQL_EXPR = "(SELECT base_points FROM base) + " + " + ".join(_pts_lookup_sql(f) for f in [*NUMERIC, *CATEGORICAL])


def _scored(spark, sf_dir):
    a, tr, m = _fit(spark, sf_dir)
    coefs, intercept = wo.naive_bayes_scorecard(m, tr)
    base, pts = wo.points_table(m, coefs, intercept)
    return a, m, coefs, intercept, wo.score(a, m, base, pts, m.features())


@register(
    "scorecard_score",
    f"""WITH {SCORECARD_CTES}, {applied_labels_cte(NUMERIC, CATEGORICAL)}
        SELECT id, round({SCORE_SQL_EXPR}, 6) AS score FROM alab""",
)
def scorecard_score(spark, sf_dir):
    _, _, _, _, s = _scored(spark, sf_dir)
    return s.select("id", F.round("score", 6).alias("score"))


def fit_card(train):
    """The naive-Bayes scorecard of a train side, with its cut-offs and the
    histogram of its train scores."""
    m = wo.fit_woe_bins(train, NUMERIC, CATEGORICAL, "target", edge_decimals=EDGE_DECIMALS)
    coefs, intercept = wo.naive_bayes_scorecard(m, train)
    return make_card(train, m, *wo.points_table(m, coefs, intercept))


def make_card(train, m, base, pts):
    scores = wo.score(train, m, base, pts, m.features()).select("score")
    cut = _cutoffs(scores).first()
    return sc.Scorecard(m, base, pts, cut["approve_cutoff"], cut["decline_cutoff"], PsiReference(scores, "score", decimals=EDGE_DECIMALS))


CUTOFF_SQL = f"""WITH {SCORECARD_CTES}, {applied_labels_cte(NUMERIC, CATEGORICAL, src='tr')},
sc AS (SELECT id, {SCORE_SQL_EXPR} AS score FROM alab)
SELECT round(quantile_cont(score, 0.6), 6) AS approve_cutoff, round(quantile_cont(score, 0.2), 6) AS decline_cutoff FROM sc"""


def _cutoffs(scored_train):
    return po.cutoffs_from_scores(scored_train)


@register("policy_points_cutoffs", CUTOFF_SQL)
def policy_points_cutoffs(spark, sf_dir):
    """PF6: approve / decline cut-offs = 60th / 20th percentile of train
    scores."""
    _, _, _, _, s = _scored(spark, sf_dir)
    c = _cutoffs(s.where(F.col("t") < CREDIT_TRAIN_T))
    return c.select(F.round("approve_cutoff", 6).alias("approve_cutoff"), F.round("decline_cutoff", 6).alias("decline_cutoff"))


BATCH_SQL = f"""WITH {SCORECARD_CTES}, {applied_labels_cte(NUMERIC, CATEGORICAL)},
sc AS (SELECT id, t, {SCORE_SQL_EXPR} AS score,
              1.0 / (1.0 + exp(-(ln((SELECT sum(target) / (count(*) - sum(target)) FROM tr))
                  - ({' + '.join(f"coalesce((SELECT woe FROM woe WHERE feature = '{f}' AND bin = alab.{f}_bin), 0.0)" for f in [*NUMERIC, *CATEGORICAL])})))) AS probability
       FROM alab),
cut AS (SELECT quantile_cont(score, 0.6) AS ap, quantile_cont(score, 0.2) AS dc FROM sc WHERE t < {CREDIT_TRAIN_T})
SELECT id, round(probability, 9) AS probability, round(score, 6) AS score,
       CASE WHEN score >= ap THEN 'approve' WHEN score >= dc THEN 'review' ELSE 'decline' END AS decision
FROM sc, cut"""


def credit_scoring(spark, sf_dir):
    a, m, coefs, intercept, s = _scored(spark, sf_dir)
    c = _cutoffs(s.where(F.col("t") < CREDIT_TRAIN_T)).first()
    s = wo.transform_woe(s, m)
    margin = F.lit(float(intercept))
    for f in m.features():
        margin = margin + F.lit(coefs[f]) * F.col(f + "_woe")
    s = s.withColumn("probability", 1.0 / (1.0 + F.exp(-margin)))
    return po.decide_points(s, c["approve_cutoff"], c["decline_cutoff"])


@register("credit_scoring_batch", BATCH_SQL)
def credit_scoring_batch(spark, sf_dir):
    """Bins -> probability + points + decision for a whole table."""
    s = credit_scoring(spark, sf_dir)
    return s.select("id", r9("probability"), F.round("score", 6).alias("score"), "decision")


@register(
    "policy_points",
    f"""WITH b AS ({BATCH_SQL}) SELECT decision, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY decision""",
)
def policy_points(spark, sf_dir):
    """PF3: decision counts under the points policy."""
    s = credit_scoring(spark, sf_dir)
    return s.groupBy("decision").agg(F.count(F.lit(1)).cast("long").alias("n"))


# --- PSI ---------------------------------------------------------------------

def _drift_sql(cols):
    longs = lambda side: " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {side}" for c in cols)
    return f"""
ex AS (SELECT * FROM lineitem WHERE year(l_shipdate) < 1999),
ac AS (SELECT * FROM lineitem WHERE year(l_shipdate) >= 1999),
lex AS ({longs('ex')}),
lac AS ({longs('ac')}),
q AS (SELECT feature, list_sort(list_distinct(list_transform(quantile_cont(value, [{', '.join(repr(i / 10) for i in range(11))}]),
                                                            lambda v: round(v, {EDGE_DECIMALS})))) AS qs FROM lex GROUP BY feature),
e AS (SELECT feature, {_interior('qs')} AS es FROM q),
be AS (SELECT lex.feature, CASE WHEN value IS NULL THEN '__MISSING__' ELSE 'bin_' || CAST(len(list_filter(es, lambda v: v < value)) AS VARCHAR) END AS bin
       FROM lex JOIN e USING (feature)),
ba AS (SELECT lac.feature, CASE WHEN value IS NULL THEN '__MISSING__' ELSE 'bin_' || CAST(len(list_filter(es, lambda v: v < value)) AS VARCHAR) END AS bin
       FROM lac JOIN e USING (feature)),
ce AS (SELECT feature, bin, count(*) AS n_expected FROM be GROUP BY ALL),
ca AS (SELECT feature, bin, count(*) AS n_actual FROM ba GROUP BY ALL),
t AS (SELECT coalesce(ce.feature, ca.feature) AS feature, coalesce(ce.bin, ca.bin) AS bin,
             coalesce(n_expected, 0) AS n_expected, coalesce(n_actual, 0) AS n_actual
      FROM ce FULL OUTER JOIN ca ON ce.feature = ca.feature AND ce.bin = ca.bin),
p AS (SELECT *, (n_expected + 1e-4) / (sum(n_expected) OVER (PARTITION BY feature) + 1e-4 * count(*) OVER (PARTITION BY feature)) AS pe,
                (n_actual + 1e-4) / (sum(n_actual) OVER (PARTITION BY feature) + 1e-4 * count(*) OVER (PARTITION BY feature)) AS pa FROM t),
r AS (SELECT *, (pa - pe) * ln(pa / pe) AS contrib FROM p)"""


@register(
    "psi_report",
    f"""WITH {_drift_sql(['l_extendedprice']).strip()}
        SELECT bin, CAST(n_expected AS BIGINT) AS n_expected, CAST(n_actual AS BIGINT) AS n_actual,
               round(pe, 9) AS pct_expected, round(pa, 9) AS pct_actual, round(contrib, 9) AS psi_contribution FROM r""",
)
def psi_report(spark, sf_dir):
    ex, ac = bind_drift_pair(spark, sf_dir)
    r = dr.psi_report(ex, ac, "l_extendedprice", decimals=EDGE_DECIMALS)
    return r.select("bin", F.col("n_expected").cast("long").alias("n_expected"), F.col("n_actual").cast("long").alias("n_actual"),
                    r9("pct_expected"), r9("pct_actual"), r9("psi_contribution"))


VERDICT_SQL = "CASE WHEN sum(contrib) < 0.1 THEN 'stable' WHEN sum(contrib) < 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END"


@register(
    "psi_value",
    f"""WITH {_drift_sql(['l_extendedprice']).strip()}
        SELECT round(sum(contrib), 9) AS psi, {VERDICT_SQL} AS verdict FROM r""",
)
def psi_value(spark, sf_dir):
    ex, ac = bind_drift_pair(spark, sf_dir)
    r = dr.psi_by_feature(ex, ac, ["l_extendedprice"], decimals=EDGE_DECIMALS)
    return r.select(r9("psi"), "verdict")


@register(
    "psi_by_feature",
    f"""WITH {_drift_sql(DRIFT_FEATURES).strip()}
        SELECT feature, round(sum(contrib), 9) AS psi, {VERDICT_SQL} AS verdict FROM r GROUP BY feature""",
)
def psi_by_feature(spark, sf_dir):
    ex, ac = bind_drift_pair(spark, sf_dir)
    return dr.psi_by_feature(ex, ac, DRIFT_FEATURES, decimals=EDGE_DECIMALS).select("feature", r9("psi"), "verdict")
