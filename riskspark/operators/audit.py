"""IO7, PF8, A7, A8: an append-only decision log as a Parquet table, and
the queries the reference runs against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DECISION_APPROVE, DECISION_DECLINE, DECISION_REVIEW

DECISIONS = [DECISION_APPROVE, DECISION_REVIEW, DECISION_DECLINE]


def decision_rows(
    df: DataFrame,
    model_type: str,
    model_version: Column | str,
    id_col: str,
    logged_at: Column,
    score_col: str,
    decision_col: str,
    input_cols: Sequence[str],
) -> DataFrame:
    """Standard log rows: id, logged_at, model_type, model_version, score,
    decision, input_json (the request's inputs as JSON text)."""
    mv = F.lit(model_version) if isinstance(model_version, str) else model_version
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        logged_at.cast("timestamp").alias("logged_at"),
        F.lit(model_type).alias("model_type"),
        mv.cast("string").alias("model_version"),
        F.col(score_col).cast("double").alias("score"),
        F.col(decision_col).alias("decision"),
        F.to_json(F.struct(*input_cols), {"ignoreNullFields": "false"}).alias("input_json"),
    )


def append_decisions(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append to the log, one folder per batch.  A batch that is written
    again replaces its own folder, so a retry adds nothing."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def recent_decisions(log: DataFrame, limit: int = 20, model_type: str | None = None) -> DataFrame:
    """PF8: newest first, optional model filter, limit (top-k plan)."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    x = log if model_type is None else log.where(F.col("model_type") == model_type)
    return x.orderBy(F.col("logged_at").desc(), F.col("id").desc()).limit(int(limit))


def decision_counts(log: DataFrame) -> DataFrame:
    """Rows per (model_type, decision)."""
    return log.groupBy("model_type", "decision").agg(F.count(F.lit(1)).cast("long").alias("n"))


def decision_pivot(log: DataFrame) -> DataFrame:
    """One row per model, a column per decision, missing cells 0."""
    p = log.groupBy("model_type").pivot("decision", DECISIONS).agg(F.count(F.lit(1)))
    return p.fillna(0, DECISIONS).select("model_type", *[F.col(d).cast("long").alias(d) for d in DECISIONS])
