"""UP3-UP7: Qini curve and coefficient, uplift at k, ranking comparison.

Rows are walked in (score desc, id) order - the reference's stable sort -
with the bucketed running sum (``ordering.prefix_sum``) of four indicators,
so a large campaign table is never ranked in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import prefix_sum


def validate_uplift(df: DataFrame, outcome: str = "outcome", treatment: str = "treatment") -> int:
    """UP6: outcome and treatment are 0 or 1 everywhere and both arms occur;
    returns the row count.  One pass, one error that states what was found."""
    flag = lambda c: F.count_if(F.col(c).isNull() | ~F.col(c).isin(0, 1))
    arm = lambda v: F.count_if(F.col(treatment) == v)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), flag(outcome).alias("odd_outcomes"), flag(treatment).alias("odd_treatments"), arm(1).alias("treated"), arm(0).alias("untreated")
    ).first()
    if found["odd_outcomes"] or found["odd_treatments"] or not (found["treated"] and found["untreated"]):
        raise ValueError(f"not a campaign with 0/1 flags and two arms: {found.asDict()}")
    return found["rows"]


def _walk(df: DataFrame, outcome: str, treatment: str, score: str, id_col: str) -> tuple[DataFrame, int]:
    """Rows in (score desc, id) order with rank and the counts so far of
    treated, untreated and of both that responded; and the row count."""
    n = validate_uplift(df, outcome, treatment)
    t = F.col(treatment) == 1
    y = F.col(outcome) == 1
    c = prefix_sum(
        df.select(F.col(score).cast("double").alias("__s"), F.col(id_col).alias("__id"), t.alias("__t"), y.alias("__y")),
        [("__s", False), ("__id", True)],
        {
            "rank": F.lit(1).cast("long"),
            "nt": F.col("__t").cast("long"),
            "nc": (~F.col("__t")).cast("long"),
            "yt": (F.col("__t") & F.col("__y")).cast("long"),
            "yc": (~F.col("__t") & F.col("__y")).cast("long"),
        },
        n=n,
    )
    return c, n


def _qini() -> Column:
    return F.when(F.col("nc") > 0, F.col("yt") - F.col("yc") * (F.col("nt") / F.col("nc"))).otherwise(F.col("yt").cast("double"))


def qini_curve(df: DataFrame, outcome: str = "outcome", treatment: str = "treatment", score: str = "score", id_col: str = "id") -> DataFrame:
    """(rank, fraction, qini): q = Y_t - Y_c * N_t / N_c, and Y_t alone
    while no control row has been seen."""
    c, n = _walk(df, outcome, treatment, score, id_col)
    return c.select(F.col("__id").alias(id_col), "rank", (F.col("rank") / F.lit(float(n))).alias("fraction"), _qini().alias("qini"))


def qini_coefficient_from_curve(curve: DataFrame) -> DataFrame:
    """UP4: trapezoid area under the curve from (0, 0) minus the diagonal
    to (1, q_n), divided by n; with steps of 1/n this is
    (sum q / n - q_n / (2n) - q_n / 2) / n."""
    agg = curve.agg(
        F.count(F.lit(1)).alias("n"), F.sum("qini").alias("sq"), F.max_by("qini", "rank").alias("qn")
    )
    n = F.col("n").cast("double")
    return agg.select(((F.col("sq") / n - F.col("qn") / (2 * n) - F.col("qn") / 2) / n).alias("qini_coefficient"))


def qini_coefficient(df: DataFrame, outcome: str = "outcome", treatment: str = "treatment", score: str = "score", id_col: str = "id") -> DataFrame:
    return qini_coefficient_from_curve(qini_curve(df, outcome, treatment, score, id_col))


def _cut(n: int, k: float) -> int:
    if not 0.0 < k <= 1.0:
        raise ValueError(f"k is a share above 0 and up to 1, not {k}")
    return max(1, int(round(k * n)))


def _at_cuts(c: DataFrame, n: int, ks: Sequence[float]) -> dict[float, float]:
    """Response rate of treated less that of untreated at each cut, read from
    the counts of the row that stands there."""
    cuts = {k: _cut(n, k) for k in ks}
    rows = {r["rank"]: r for r in c.where(F.col("rank").isin(sorted(set(cuts.values())))).select("rank", "nt", "nc", "yt", "yc").collect()}
    for k, top in cuts.items():
        if not rows[top]["nt"] or not rows[top]["nc"]:
            raise ValueError(f"uplift at {k}: its {top} best rows have {rows[top]['nt']} treated and {rows[top]['nc']} untreated")
    return {k: rows[top]["yt"] / rows[top]["nt"] - rows[top]["yc"] / rows[top]["nc"] for k, top in cuts.items()}


def uplift_at_k(df: DataFrame, k: float, outcome: str = "outcome", treatment: str = "treatment", score: str = "score", id_col: str = "id") -> DataFrame:
    """UP5: treated minus control response rate among the top
    max(1, round(k n)) rows (round half to even)."""
    _cut(1, k)
    c, n = _walk(df, outcome, treatment, score, id_col)
    return df.sparkSession.createDataFrame([(float(k), _cut(n, k), _at_cuts(c, n, [k])[k])], "k double, n_top long, uplift double")


def compare_rankings(
    df: DataFrame, scores: Mapping[str, Column], ks=(0.1, 0.3), outcome: str = "outcome", treatment: str = "treatment", id_col: str = "id"
) -> DataFrame:
    """UP7: Qini coefficient and uplift at each k for several rankings of
    the same rows; each ranking is walked once and kept."""
    out = []
    for name, expr in scores.items():
        c, n = _walk(df.withColumn("__score", expr), outcome, treatment, "__score", id_col)
        c = cut_lineage(c.select("rank", "nt", "nc", "yt", "yc"))
        found = qini_coefficient_from_curve(c.withColumn("qini", _qini())).first()[0]
        out.append((name, found, *_at_cuts(c, n, ks).values()))
    names = ", ".join(f"uplift_at_{int(k * 100)} double" for k in ks)
    return df.sparkSession.createDataFrame(out, f"ranking string, qini_coefficient double, {names}")
