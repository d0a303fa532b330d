"""IO1-IO3: checked loads.

A contract is (required columns, key columns).  The report is one row per
table, computed with one partially aggregated ``groupBy(key)``; ``load_*``
raise ``ValueError`` naming what is missing and how many duplicate rows
exist, as the reference's loaders do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number


def contract_report(df: DataFrame, name: str, required: Sequence[str], key: Sequence[str]) -> DataFrame:
    """One row: table, n_rows, n_missing_columns, missing_columns,
    n_duplicate_rows (rows beyond the first per key), n_duplicate_keys."""
    missing = sorted(set(required) - set(df.columns))
    key_ok = [k for k in key if k in df.columns]
    if len(key_ok) == len(key) and key:
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
        stats = per_key.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_rows"),
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"),
            F.count_if(F.col("__n") > 1).cast("long").alias("n_duplicate_keys"),
        )
    else:
        stats = df.agg(
            F.count(F.lit(1)).cast("long").alias("n_rows"),
            F.lit(None).cast("long").alias("n_duplicate_rows"),
            F.lit(None).cast("long").alias("n_duplicate_keys"),
        )
    return stats.select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(missing)).cast("long").alias("n_missing_columns"),
        F.lit(",".join(missing)).alias("missing_columns"),
        "n_duplicate_rows",
        "n_duplicate_keys",
    )


def enforce(report: DataFrame) -> None:
    """Raise on the (single-row, driver-side) report."""
    r = report.first()
    if r["n_missing_columns"]:
        raise ValueError(f"table {r['table_name']} lacks columns {r['missing_columns']}")
    if r["n_duplicate_rows"]:
        raise ValueError(f"table {r['table_name']}: {r['n_duplicate_rows']} duplicate rows under its key")


def load_checked(
    spark: SparkSession, path: str, required: Sequence[str], key: Sequence[str], fmt: str = "parquet", **options
) -> DataFrame:
    """Scan + contract.  Missing path -> FileNotFoundError (from Spark's
    AnalysisException), missing columns or duplicate keys -> ValueError.
    NaN is loaded as NULL."""
    try:
        df = spark.read.format(fmt).options(**options).load(path)
    except Exception as e:  # PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"file not found: {path}") from e
        raise
    enforce(contract_report(df, path, required, key))
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: number(f"`{c}`") for c in floats})


def ordered_projection(df: DataFrame, ordered: Sequence[str], key: str | None = None) -> DataFrame:
    """IO3: fixed ordered schema; Catalyst prunes the other columns at the
    scan."""
    missing = sorted(set(ordered) - set(df.columns))
    if missing:
        raise ValueError(f"the projection lacks columns {missing}")
    return df.select(*ordered)
