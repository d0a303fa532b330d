"""PS1-PS6: population stability index.

Edges come from the *expected* side's non-missing values (exact linear
quantiles, duplicates dropped, outer edges opened to +-inf); missing values
form their own bin; each side's shares are smoothed over the bins seen on
either side.  Many features are handled in one grouped job by unpivoting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number, psi_verdict
from .quantiles import quantiles
from .woe import MISSING_LABEL, quantile_edges

# Fixed values (must equal the reference's): smoothing added to every bin
# share, and the default number of PSI bins.
PSI_EPSILON = 1e-4
DEFAULT_PSI_BINS = 10

# Status codes of the drift monitor: ok, significant shift, could not run.
STATUS_OK = 0
STATUS_SIGNIFICANT_SHIFT = 1
STATUS_COULD_NOT_RUN = 2


def _long(df: DataFrame, columns: Sequence[str], beside: Sequence[str] = ()) -> DataFrame:
    """(beside..., feature, value): NaN is missing."""
    return df.select(
        *beside,
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])).alias("kv"),
    ).select(*beside, "kv.feature", number("kv.value").alias("value"))


def psi_edges(expected: DataFrame, columns: Sequence[str], bins: int = DEFAULT_PSI_BINS, decimals: int | None = None, sketch: int | None = None) -> dict[str, list[float]]:
    """Interior edges per feature from the expected side (one job; the
    driver receives features x (bins + 1) numbers); ``sketch`` takes them from KLL
    sketches of that size."""
    qs = [i / bins for i in range(bins + 1)]
    rows = quantiles(_long(expected, columns), "value", qs, ["feature"], sketch).collect()
    got: dict[str, list[float]] = {c: [] for c in columns}
    for r in rows:
        got[r["feature"]].append(r["quantile"])
    edges = {}
    for c in columns:
        if not got[c]:
            raise ValueError(f"the reference side of {c!r} is all missing; no bins")
        e = quantile_edges(got[c], decimals)
        if len(set(round(v, decimals) if decimals is not None else v for v in got[c])) < 2:
            raise ValueError(f"the reference side of {c!r} has a single value; no bins")
        edges[c] = e
    return edges


def _bin_expr(edges: dict[str, list[float]]):
    v = F.col("value")
    expr = None
    for c, e in edges.items():
        arr = F.array(*[F.lit(float(x)) for x in e]) if e else F.array().cast("array<double>")
        idx = F.size(F.filter(arr, lambda x: x < v))
        expr = F.when(F.col("feature") == c, idx) if expr is None else expr.when(F.col("feature") == c, idx)
    return F.when(v.isNull(), F.lit(MISSING_LABEL)).otherwise(F.concat(F.lit("bin_"), expr.cast("string")))


def psi_by_feature_report(
    expected: DataFrame, actual: DataFrame, columns: Sequence[str], bins: int = DEFAULT_PSI_BINS, decimals: int | None = None, sketch: int | None = None
) -> DataFrame:
    """PS1 for many features: (feature, bin, n_expected, n_actual,
    pct_expected, pct_actual, psi_contribution)."""
    if actual.isEmpty():
        raise ValueError("no actual rows to compare with the reference side")
    edges = psi_edges(expected, columns, bins, decimals, sketch)
    b = _bin_expr(edges)
    ce = _long(expected, columns).groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n_expected"))
    ca = _long(actual, columns).groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n_actual"))
    t = ce.join(ca, ["feature", "bin"], "full_outer").fillna(0, ["n_expected", "n_actual"])
    w = Window.partitionBy("feature")
    nb, ne, na = F.count(F.lit(1)).over(w), F.sum("n_expected").over(w), F.sum("n_actual").over(w)
    t = t.withColumn("pct_expected", (F.col("n_expected") + PSI_EPSILON) / (ne + PSI_EPSILON * nb))
    t = t.withColumn("pct_actual", (F.col("n_actual") + PSI_EPSILON) / (na + PSI_EPSILON * nb))
    return t.withColumn(
        "psi_contribution", (F.col("pct_actual") - F.col("pct_expected")) * F.ln(F.col("pct_actual") / F.col("pct_expected"))
    )


def psi_report(expected: DataFrame, actual: DataFrame, column: str, bins: int = DEFAULT_PSI_BINS, decimals: int | None = None) -> DataFrame:
    """PS1 for one column."""
    return psi_by_feature_report(expected.select(column), actual.select(column), [column], bins, decimals).drop("feature")


def psi_by_feature(expected: DataFrame, actual: DataFrame, columns: Sequence[str], bins: int = DEFAULT_PSI_BINS, decimals: int | None = None) -> DataFrame:
    """PS2-PS4: (feature, psi, verdict)."""
    r = psi_by_feature_report(expected, actual, columns, bins, decimals)
    return r.groupBy("feature").agg(F.sum("psi_contribution").alias("psi")).withColumn("verdict", psi_verdict("psi"))


def psi_status(psi_col: str = "psi"):
    """PS5 outcome code: 1 when the shift is significant, else 0."""
    return F.when(psi_verdict(psi_col) == "significant_shift", STATUS_SIGNIFICANT_SHIFT).otherwise(STATUS_OK)
