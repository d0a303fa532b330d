"""Weight-of-evidence binning, information value and a
points scorecard, fitted on train only and applied without refitting.

Fitted state is small: interior quantile edges per numeric feature (at most
``n_bins - 1`` literals), and a WoE table with one row per (feature, bin).
All features are fitted in one grouped job by unpivoting to
(feature, bin, target).  Applying a model adds one column per feature:
numeric bins are a literal comparison, the WoE lookup is a literal map when
the feature has few bins, and a (broadcast-if-small) join otherwise, e.g.
for high-cardinality categoricals.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iv_strength, right_closed_bin
from .features import require_columns
from .modeltables import keep
from .quantiles import quantiles

# Fixed values (must equal the reference's): bin labels for missing and
# never-seen categories, WoE smoothing count, default number of bins, and
# the scorecard scaling defaults (points to double the odds, base score,
# base odds).
MISSING_LABEL = "__MISSING__"
UNSEEN_LABEL = "__UNSEEN__"
WOE_EPSILON = 0.5
DEFAULT_BINS = 5
DEFAULT_PDO = 20.0
DEFAULT_BASE_SCORE = 600.0
DEFAULT_BASE_ODDS = 50.0



def special_label(v: float) -> str:
    return f"special={float(v)!r}"


def numeric_bin_label(x: Column | str, edges: Sequence[float], specials: Sequence[float] = ()) -> Column:
    """Missing -> each special value -> right-closed quantile bin
    ``bin_<i>`` over interior edges (outer edges are -inf/+inf)."""
    x = F.col(x) if isinstance(x, str) else x
    xd = x.cast("double")
    expr = F.when(x.isNull() | F.isnan(xd), F.lit(MISSING_LABEL))
    for s in specials:
        expr = expr.when(xd == F.lit(float(s)), F.lit(special_label(s)))
    return expr.otherwise(F.concat(F.lit("bin_"), right_closed_bin(xd, edges).cast("string")))


def quantile_edges(values: Sequence[float], decimals: int | None = None) -> list[float]:
    """Interior edges from the n_bins+1 quantiles: duplicates dropped, the
    outer two replaced by -inf/+inf; fewer than two distinct -> one bin."""
    vals = [round(v, decimals) if decimals is not None else v for v in values if v is not None]
    uniq = sorted(set(vals))
    if len(uniq) < 2:
        return []
    return uniq[1:-1]


@dataclass
class WoeModel:
    numeric: list[str]
    categorical: list[str]
    edges: dict[str, list[float]]
    specials: dict[str, list[float]]
    table: DataFrame  # feature, bin, n, bad, good, distr_good, distr_bad, woe, iv
    target: str
    extra: dict = field(default_factory=dict)

    def bin_label(self, df: DataFrame, feature: str) -> Column:
        if feature in self.numeric:
            return numeric_bin_label(feature, self.edges[feature], self.specials.get(feature, ()))
        return F.col(feature).cast("string")

    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def _labelled(df: DataFrame, numeric, categorical, edges, specials) -> DataFrame:
    cols = [numeric_bin_label(f, edges[f], specials.get(f, ())).alias(f) for f in numeric]
    cols += [F.coalesce(F.col(f).cast("string"), F.lit(MISSING_LABEL)).alias(f) for f in categorical]
    return cols


def fit_edges(
    train: DataFrame, numeric: Sequence[str], n_bins: int = DEFAULT_BINS, specials: Mapping[str, Sequence[float]] | None = None,
    decimals: int | None = None, sketch: int | None = None,
) -> dict[str, list[float]]:
    """Train quantile edges for all numeric features in one job; the
    driver receives (features x (n_bins + 1)) numbers.  ``sketch`` takes them
    from KLL sketches of that size instead of exactly."""
    specials = dict(specials or {})
    if not numeric:
        return {}
    def value(f):
        v = F.col(f).cast("double")
        sp = [float(x) for x in specials.get(f, [])]
        return F.when(~v.isin(sp), v) if sp else v

    long = train.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), value(f).alias("value")) for f in numeric])).alias("kv")
    ).select("kv.feature", "kv.value").where(~F.isnan("value"))
    qs = [i / n_bins for i in range(n_bins + 1)]
    rows = quantiles(long, "value", qs, ["feature"], sketch).collect()
    got: dict[str, list[float]] = {f: [] for f in numeric}
    for r in rows:
        got[r["feature"]].append(r["quantile"])
    return {f: quantile_edges(got[f], decimals) for f in numeric}


def woe_table(labelled: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Per (feature, bin) counts and smoothed WoE/IV; only bins observed
    in the data enter each feature's smoothing denominator."""
    long = labelled.select(
        F.col(target).cast("long").alias("__y"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in features])).alias("kv"),
    ).select("kv.feature", "kv.bin", "__y")
    g = long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("bad"))
    g = g.withColumn("good", F.col("n") - F.col("bad"))
    # Per-feature totals: one row per feature (bounded), broadcast; a window
    # over "feature" would put a high-cardinality categorical in one task.
    tot = g.groupBy("feature").agg(F.sum("good").alias("__tg"), F.sum("bad").alias("__tb"), F.count(F.lit(1)).alias("__nb"))
    g = g.join(F.broadcast(tot), "feature")
    tg, tb, nb = F.col("__tg"), F.col("__tb"), F.col("__nb")
    g = g.withColumn("distr_good", (F.col("good") + WOE_EPSILON) / (tg + WOE_EPSILON * nb))
    g = g.withColumn("distr_bad", (F.col("bad") + WOE_EPSILON) / (tb + WOE_EPSILON * nb))
    g = g.withColumn("woe", F.ln(F.col("distr_good") / F.col("distr_bad")))
    return g.withColumn("iv", (F.col("distr_good") - F.col("distr_bad")) * F.col("woe")).drop("__tg", "__tb", "__nb")


def fit_woe_bins(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str,
    n_bins: int = DEFAULT_BINS,
    special_values: Mapping[str, Sequence[float]] | None = None,
    edge_decimals: int | None = None,
    sketch: int | None = None,
) -> WoeModel:
    """W3 + W4 for every feature; raises when a class is missing."""
    require_columns(train, [target, *numeric, *categorical], "train_df")
    specials = {k: list(v) for k, v in (special_values or {}).items()}
    r = train.agg(F.count_if(F.col(target) == 1).alias("b"), F.count_if(F.col(target) == 0).alias("g")).first()
    if not r["b"] or not r["g"]:
        raise ValueError("weights of evidence compare target 1 with target 0; one of them has no rows")
    edges = fit_edges(train, numeric, n_bins, specials, edge_decimals, sketch)
    labelled = train.select(F.col(target), *_labelled(train, numeric, categorical, edges, specials))
    table = keep(woe_table(labelled, [*numeric, *categorical], target))
    return WoeModel(list(numeric), list(categorical), edges, specials, table, target)


def _lookup(df: DataFrame, table: DataFrame, feature: str, label: Column, value_col: str, out: str, default) -> DataFrame:
    """``out``: the table's value for the row's bin; one join at every size."""
    t = table.where(F.col("feature") == feature).select(F.col("bin").alias("__bin"), F.col(value_col).alias(out))
    joined = df.withColumn("__lbl", label).join(t, F.col("__lbl") == F.col("__bin"), "left")
    return joined.drop("__lbl", "__bin").withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def assign_bins(df: DataFrame, model: WoeModel, suffix: str = "_bin") -> DataFrame:
    """Bin label per feature; categorical values never seen in train
    become ``__UNSEEN__``."""
    out = df
    for f in model.numeric:
        out = out.withColumn(f + suffix, model.bin_label(out, f))
    for f in model.categorical:
        out = _lookup(out, model.table, f, F.col(f).cast("string"), "bin", "__known", None)
        out = out.withColumn(
            f + suffix,
            F.when(F.col(f).isNull(), F.lit(MISSING_LABEL)).when(F.col("__known").isNotNull(), F.col(f).cast("string")).otherwise(F.lit(UNSEEN_LABEL)),
        ).drop("__known")
    return out


def transform_woe(df: DataFrame, model: WoeModel, suffix: str = "_woe") -> DataFrame:
    """``<feature>_woe`` per feature; bins absent from the fitted table
    (unseen categories, unobserved specials) get 0.0."""
    out = df
    for f in model.features():
        label = model.bin_label(out, f) if f in model.numeric else F.coalesce(F.col(f).cast("string"), F.lit(MISSING_LABEL))
        out = _lookup(out, model.table, f, label, "woe", f + suffix, 0.0)
    return out


def iv_report(model: WoeModel) -> DataFrame:
    """W6 + W7: total IV per feature with its strength band."""
    return model.table.groupBy("feature").agg(F.sum("iv").alias("total_iv")).withColumn("strength", iv_strength("total_iv"))


def select_by_iv(model: WoeModel, min_iv: float = 0.02) -> DataFrame:
    """PF9: features with total IV >= min_iv, highest first."""
    return iv_report(model).where(F.col("total_iv") >= min_iv).orderBy(F.col("total_iv").desc())


# ---------------------------------------------------------------------------
# W9-W10 points scorecard
# ---------------------------------------------------------------------------

def points_table(
    model: WoeModel,
    coefficients: Mapping[str, float],
    intercept: float,
    pdo: float = DEFAULT_PDO,
    base_score: float = DEFAULT_BASE_SCORE,
    base_odds: float = DEFAULT_BASE_ODDS,
):
    """(base_points, table feature/bin/woe/points).  factor = pdo/ln 2,
    offset = base - factor ln(odds), points = -factor coef woe,
    base_points = offset - factor intercept."""
    if pdo <= 0:
        raise ValueError(f"points to double the odds: {pdo} is not above 0")
    if base_odds <= 0:
        raise ValueError(f"base odds: {base_odds} is not above 0")
    factor = pdo / math.log(2)
    offset = base_score - factor * math.log(base_odds)
    base_points = offset - factor * float(intercept)
    coef = F.create_map(*[x for k, v in coefficients.items() for x in (F.lit(k), F.lit(float(v)))])
    t = model.table.where(F.col("feature").isin(list(coefficients))).select(
        "feature", "bin", "woe", (F.lit(-factor) * F.element_at(coef, F.col("feature")) * F.col("woe")).alias("points")
    )
    return base_points, t


def score(df: DataFrame, model: WoeModel, base_points: float, points: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    """Base points + each feature's bin points (unknown bin -> 0)."""
    kept = keep(points.select("feature", "bin", "points"))
    res = df
    total = F.lit(float(base_points))
    for f in features:
        label = model.bin_label(res, f) if f in model.numeric else F.coalesce(F.col(f).cast("string"), F.lit(MISSING_LABEL))
        res = _lookup(res, kept, f, label, "points", f"__pts_{f}", 0.0)
        total = total + F.col(f"__pts_{f}")
    return res.withColumn(out, total).drop(*[f"__pts_{f}" for f in features])


def naive_bayes_scorecard(model: WoeModel, train: DataFrame):
    """Coefficients of -1 on every WoE column and the train log-odds as
    intercept: the scorecard an all-WoE naive Bayes model implies.  Used as
    the exact (fit-free) twin of the regression scorecard."""
    r = train.agg(F.sum(F.col(model.target)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    intercept = math.log(r["b"] / (r["n"] - r["b"]))
    return {f: -1.0 for f in model.features()}, intercept
