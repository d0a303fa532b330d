"""Column builders shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F



def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """A numeric column with NaN as NULL."""
    return F.when(~F.isnan(col_(c)), col_(c))


def right_closed_bin(x: Column | str, edges: Sequence[float]) -> Column:
    """Bin index for right-closed bins (-inf, e1], (e1, e2], ..., (ek, inf).

    Index = number of edges strictly below x.  ``Bucketizer`` is left-closed,
    so it is not used.  Edges are literals: few are compared one by one, which
    compiles; many are an array filter.  NULL is in bin 0.
    """
    if not edges:
        return F.lit(0)
    x = col_(x).cast("double")
    if len(edges) <= 32:
        return sum((F.when(F.lit(float(e)) < x, 1).otherwise(0) for e in edges[1:]), F.when(F.lit(float(edges[0])) < x, 1).otherwise(0))
    arr = F.array(*[F.lit(float(e)) for e in edges])
    return F.size(F.filter(arr, lambda e: e < x))


def hash_order_key(id_col: str | Column, seed: int | str, *extra: str) -> Column:
    """Deterministic pseudo-random order key, identical in Spark and DuckDB:
    md5 of the id text, a colon and the seed."""
    parts = [col_(id_col).cast("string")]
    for e in extra:
        parts += [F.lit(":"), F.lit(str(e))]
    parts += [F.lit(":"), F.lit(str(seed))]
    return F.md5(F.concat(*parts))


def round6(c: Column | str) -> Column:
    return F.round(col_(c).cast("double"), 6)


def round9(c: Column | str) -> Column:
    """For averages and ratios: 9 decimals keeps clear of half-way ties
    that two engines would round differently."""
    return F.round(col_(c).cast("double"), 9)


# Fixed band limits and labels (must equal the reference's values):
# information value: < 0.02 not_useful, < 0.1 weak, < 0.3 medium,
# < 0.5 strong, otherwise suspicious.
IV_BANDS = [(0.02, "not_useful"), (0.1, "weak"), (0.3, "medium"), (0.5, "strong")]
IV_TOP = "suspicious"

# Fixed PSI verdict limits (must equal the reference's values):
# < 0.10 stable, < 0.25 moderate_shift, otherwise significant_shift.
PSI_BANDS = [(0.10, "stable"), (0.25, "moderate_shift")]
PSI_TOP = "significant_shift"


def band(x: Column | str, bands, top: str) -> Column:
    x = col_(x)
    expr = None
    for limit, label in bands:
        expr = F.when(x < limit, F.lit(label)) if expr is None else expr.when(x < limit, F.lit(label))
    return expr.otherwise(F.lit(top))


def iv_strength(iv: Column | str) -> Column:
    return band(iv, IV_BANDS, IV_TOP)


def psi_verdict(psi: Column | str) -> Column:
    return band(psi, PSI_BANDS, PSI_TOP)


# Fixed decision labels (must equal the reference's values).
DECISION_APPROVE = "approve"
DECISION_REVIEW = "review"
DECISION_DECLINE = "decline"


def probability_decision(p: Column | str, review: float, decline: float) -> Column:
    """PF2: higher probability is riskier: >= decline -> decline,
    >= review -> review, else approve."""
    p = col_(p)
    return F.when(p >= decline, DECISION_DECLINE).when(p >= review, DECISION_REVIEW).otherwise(DECISION_APPROVE)


def points_decision(score: Column | str, approve: float, decline: float) -> Column:
    """PF3: higher points are safer: >= approve -> approve, >= decline ->
    review, else decline."""
    s = col_(score)
    return F.when(s >= approve, DECISION_APPROVE).when(s >= decline, DECISION_REVIEW).otherwise(DECISION_DECLINE)
