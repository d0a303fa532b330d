"""Exact, distributed quantiles with linear interpolation (numpy/pandas
"linear", DuckDB ``quantile_cont``).

Spark's ``percentile`` keeps a value->count map per group in one task, which
does not survive a hot group of continuous values.  Here:

1. collapse to a histogram (group, value, count) - partial aggregation, so a
   hot value or group is combined map-side;
2. segmented prefix sum of counts over value (``ordering.prefix_sum``) gives
   each distinct value its 0-based position range [lo, hi);
3. the wanted positions per group (floor(h), floor(h)+1 with h=(n-1)q) form a
   table with #groups rows of small arrays; it is joined on the group key
   and each histogram row keeps only the positions it covers;
4. one small groupBy interpolates.

Where a bounded rank error will do, ``quantile_sketch`` makes a KLL sketch per
group instead: one partially aggregated pass without any order, a few kilobytes
a group, which can be stored and merged with those of other days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from .ordering import prefix_sum


def exact_quantiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float],
    groups: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Rows (groups..., q, quantile) for each q; NULL and NaN are ignored.
    Groups without values produce no rows."""
    groups = list(groups)
    for q in qs:
        if not 0.0 <= float(q) <= 1.0:
            raise ValueError("quantiles must be within [0, 1]")
    v = number(F.col(value).cast("double"))
    hist = df.where(v.isNotNull()).groupBy(*groups, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    cum = prefix_sum(hist, ["__v"], {"__hi": F.col("__c")}, partition_by=groups, buckets=buckets)
    cum = cum.withColumn("__lo", F.col("__hi") - F.col("__c"))
    sizes = hist.groupBy(*groups).agg(F.sum("__c").alias("__n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    wanted = sizes.select(
        *groups,
        F.col("__n"),
        F.transform(
            qarr,
            lambda q: F.struct(
                q.alias("q"),
                F.floor((F.col("__n") - 1) * q).cast("long").alias("p0"),
                F.least(F.floor((F.col("__n") - 1) * q).cast("long") + 1, F.col("__n") - 1).alias("p1"),
                ((F.col("__n") - 1) * q - F.floor((F.col("__n") - 1) * q)).alias("frac"),
            ),
        ).alias("__want"),
    )
    joined = cum.join(wanted, groups, "inner") if groups else cum.crossJoin(F.broadcast(wanted))
    hits = joined.select(
        *groups,
        "__v",
        "__lo",
        "__hi",
        F.explode(
            F.filter(
                "__want",
                lambda w: ((w["p0"] >= F.col("__lo")) & (w["p0"] < F.col("__hi")))
                | ((w["p1"] >= F.col("__lo")) & (w["p1"] < F.col("__hi"))),
            )
        ).alias("w"),
    ).select(
        *groups,
        F.col("w.q").alias("q"),
        F.col("w.frac").alias("frac"),
        F.when((F.col("w.p0") >= F.col("__lo")) & (F.col("w.p0") < F.col("__hi")), F.col("__v")).alias("v0"),
        F.when((F.col("w.p1") >= F.col("__lo")) & (F.col("w.p1") < F.col("__hi")), F.col("__v")).alias("v1"),
    )
    res = hits.groupBy(*groups, "q").agg(F.max("v0").alias("v0"), F.max("v1").alias("v1"), F.max("frac").alias("frac"))
    return res.select(
        *groups, "q", (F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac")).alias("quantile")
    )


def quantile_columns(df: DataFrame, value: str, qs: Sequence[float], names: Sequence[str], groups: Sequence[str] = (), buckets=None) -> DataFrame:
    """Wide form: one row per group with a column per quantile."""
    long = exact_quantiles(df, value, qs, groups, buckets)
    aggs = [F.max(F.when(F.col("q") == float(q), F.col("quantile"))).alias(n) for q, n in zip(qs, names)]
    if groups:
        return long.groupBy(*groups).agg(*aggs)
    return long.agg(*aggs)


#: Share of the values on either side of the median that is looked at in full, and
#: the accuracy of the sketch that finds where they begin and end.
_AROUND, _ACCURACY = 0.01, 1000


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The exact median of every column, as ``exact_quantiles`` gives it, without
    ordering all values: a sketch brackets it (its rank is off by a share of
    1 / ``_ACCURACY`` at most), the values below the bracket are counted, and only
    those inside go through the histogram and its running sum.  Columns without
    values have None."""
    values = {c: number(F.col(c).cast("double")) for c in columns}
    near = df.agg(*[F.percentile_approx(v, [0.5 - _AROUND, 0.5 + _AROUND], _ACCURACY).alias(f"__{i}") for i, v in enumerate(values.values())]).first()
    out: dict[str, float | None] = dict.fromkeys(columns)
    asked = {i: (c, near[f"__{i}"]) for i, c in enumerate(columns) if near[f"__{i}"]}
    if not asked:
        return out
    sides = [x for i, (c, (low, _)) in asked.items() for x in (F.count(values[c]).alias(f"__n{i}"), F.count_if(values[c] < F.lit(low)).alias(f"__b{i}"))]
    sizes = df.agg(*sides).first()
    inside = [F.struct(F.lit(i).alias("i"), F.when(values[c].between(F.lit(low), F.lit(high)), values[c]).alias("v")) for i, (c, (low, high)) in asked.items()]
    hist = df.select(F.inline(F.array(*inside))).where("v IS NOT NULL").groupBy("i", "v").agg(F.count(F.lit(1)).alias("__c"))
    cum = prefix_sum(hist, ["v"], {"__hi": F.col("__c")}, partition_by=["i"])
    wanted = {i: ((sizes[f"__n{i}"] - 1) // 2, sizes[f"__n{i}"] // 2) for i in asked}  # 0-based; the same one if the number is odd
    hit = F.lit(False)
    for i, both in wanted.items():
        for p in both:
            at = F.lit(p - sizes[f"__b{i}"])
            hit |= (F.col("i") == i) & (F.col("__hi") - F.col("__c") <= at) & (at < F.col("__hi"))
    found = {i: [] for i in asked}
    for r in cum.where(hit).select("i", "v").collect():  # two values for each column at most
        found[r["i"]].append(r["v"])
    for i, (c, _) in asked.items():
        if not found[i]:
            raise AssertionError(f"the median of {c!r} lies outside its bracket")
        low, high = min(found[i]), max(found[i])
        out[c] = low + (high - low) * (0.5 if wanted[i][0] != wanted[i][1] else 0.0)
    return out


# ---------------------------------------------------------------------------
# sketches: opt-in, with a bounded rank error
# ---------------------------------------------------------------------------

def rank_error(k: int) -> float:
    """Published bound of a KLL sketch of size ``k``: with a confidence of 99 %
    the rank of an answer, as a share of the values, is off by no more."""
    return 2.296 / k**0.9723


def quantile_sketch(df: DataFrame, value: str, k: int, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., sketch): NULL and NaN are ignored; groups without values
    produce no rows.  ``k`` is 8 to 65535."""
    if not 8 <= k <= 65535:
        raise ValueError(f"a sketch of size {k}; sizes are 8 to 65535")
    v = number(F.col(value).cast("double"))
    return df.where(v.isNotNull()).groupBy(*groups).agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("__n")).where("__n > 0").drop("__n")


def merge_sketches(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """One sketch for each group of stored ones, as if made of all their rows."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, qs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Rows (groups..., q, quantile): values that occur, not interpolated."""
    for q in qs:
        if not 0.0 <= float(q) <= 1.0:
            raise ValueError("quantiles must be within [0, 1]")
    asked = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("quantile")) for q in qs])
    return sketches.select(*groups, F.inline(asked))


def quantiles(df: DataFrame, value: str, qs: Sequence[float], groups: Sequence[str] = (), sketch: int | None = None) -> DataFrame:
    """Exact, or with ``sketch`` from a KLL sketch of that size."""
    if sketch is None:
        return exact_quantiles(df, value, qs, groups)
    return sketch_quantiles(quantile_sketch(df, value, sketch, groups), qs, groups)
