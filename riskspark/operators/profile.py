"""Profiling.  Every rate comes with the counts behind it.

All per-column work is done in one pass by unpivoting (explode of an array
of structs) and grouping, never by looping jobs over columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number
from .features import hour_of_day, require_columns
from .quantiles import quantiles

SECONDS_PER_DAY = 86400
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def label_rate(df: DataFrame, label: str = "label") -> DataFrame:
    """A1: n_total, n_positive, n_negative, rate."""
    require_columns(df, [label])
    out = df.agg(
        F.count(F.lit(1)).cast("long").alias("n_total"),
        F.coalesce(F.sum(F.col(label)), F.lit(0)).cast("long").alias("n_positive"),
    )
    return out.select(
        "n_total",
        "n_positive",
        (F.col("n_total") - F.col("n_positive")).alias("n_negative"),
        F.try_divide(F.col("n_positive").cast("double"), F.col("n_total")).alias("rate"),
    )


def missing_rates(df: DataFrame) -> DataFrame:
    """A2: (column, n_missing, missing_rate) for every column, one pass.
    Floating NaN counts as missing, like pandas."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = c.isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            miss = miss | F.isnan(c)
        exprs.append(F.sum(miss.cast("long")).alias(f.name))
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *exprs)
    long = wide.select(
        "__n",
        F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("m")) for f in df.schema.fields])).alias("kv"),
    )
    return long.select(
        F.col("kv.column").alias("column"),
        F.col("kv.m").cast("long").alias("n_missing"),
        F.try_divide(F.col("kv.m").cast("double"), F.col("__n")).alias("missing_rate"),
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def unpivot_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value double) - one row per input row and column;
    NaN is NULL, as missing values are in pandas."""
    return df.select(
        *keep,
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), number(F.col(c).cast("double")).alias("value")) for c in columns])).alias("__kv"),
    ).select(*keep, "__kv.feature", "__kv.value")


def describe_by_label(df: DataFrame, label: str = "label", columns: Sequence[str] | None = None, id_col: str | None = "id", sketch: int | None = None) -> DataFrame:
    """A3: per (feature, label): count, mean, std (sample), min, 25/50/75 %
    (exact, linear; with ``sketch`` from KLL sketches of that size), max."""
    require_columns(df, [label])
    if columns is None:
        columns = numeric_columns(df, exclude=[label] + ([id_col] if id_col else []))
    if not columns:
        raise ValueError("no numeric column to describe")
    long = unpivot_numeric(df, columns, keep=[label])
    stats = long.groupBy("feature", label).agg(
        F.count("value").cast("long").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    qs = quantiles(long, "value", [0.25, 0.5, 0.75], ["feature", label], sketch)
    wide_q = qs.groupBy("feature", label).agg(
        *[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    )
    return stats.join(wide_q, ["feature", label], "left")


def rate_by_elapsed_day(df: DataFrame, time_col: str = "t", label: str = "label") -> DataFrame:
    """A4: (t - min t) div 86400 -> n, positives, rate.  The scalar min is a
    one-row aggregate, broadcast."""
    require_columns(df, [time_col, label])
    t0 = df.agg(F.min(time_col).alias("__t0"))
    day = F.floor((F.col(time_col) - F.col("__t0")) / F.lit(SECONDS_PER_DAY)).cast("long")
    return _rate_by(df.crossJoin(F.broadcast(t0)), day.alias("day"), label)


def rate_by_hour(df: DataFrame, time_col: str = "t", label: str = "label") -> DataFrame:
    """A5: (t mod 86400) div 3600 (non-negative modulo) -> n, positives, rate."""
    require_columns(df, [time_col, label])
    return _rate_by(df, hour_of_day(time_col).alias("hour"), label)


def _rate_by(df, key, label):
    return df.groupBy(key).agg(
        F.count(F.lit(1)).cast("long").alias("n_transactions"),
        F.sum(F.col(label)).cast("long").alias("n_positive"),
        F.avg(F.col(label).cast("double")).alias("rate"),
    )


def eda_report_long(df: DataFrame, label: str = "label", time_col: str = "t", id_col: str = "id") -> DataFrame:
    """A6/IO6: all profiles as one tidy table (section, key, metric, value)."""
    def tidy(frame, section, key_expr, metrics):
        return frame.select(
            F.lit(section).alias("section"),
            key_expr.cast("string").alias("key"),
            F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("kv"),
        ).select("section", "key", "kv.metric", "kv.value")

    parts = [
        tidy(label_rate(df, label), "label_rate", F.lit("all"), ["n_total", "n_positive", "n_negative", "rate"]),
        tidy(missing_rates(df), "missing", F.col("column"), ["n_missing", "missing_rate"]),
        tidy(
            describe_by_label(df, label, id_col=id_col).withColumn("__k", F.concat_ws("|", "feature", F.col(label).cast("string"))),
            "describe",
            F.col("__k"),
            ["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
        ),
        tidy(rate_by_elapsed_day(df, time_col, label), "by_elapsed_day", F.col("day"), ["n_transactions", "rate"]),
        tidy(rate_by_hour(df, time_col, label), "by_hour_of_day", F.col("hour"), ["n_transactions", "rate"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_binary(df: DataFrame, label: str) -> dict:
    """One aggregate; raises when labels are not 0/1 or one class is
    missing."""
    r = df.agg(
        F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull()).alias("bad"),
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    ).first()
    if r["bad"] or not r["pos"] or not r["neg"]:
        raise ValueError(f"column {label!r} is no 0/1 label with both values: {r['neg']} zeros, {r['pos']} ones, {r['bad']} others")
    return {"positives": r["pos"], "negatives": r["neg"]}
