"""Fitted model tables (encoders, bins, WoE maps): derived from whole tables,
usually small.  ``keep`` writes one to the shared folder and reads it back, so
applying a model never re-runs its fit, and the file sizes tell the planner
whether a lookup may be a broadcast join."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def keep(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``: columns of few values; a reader of some of them reads no other rows."""
    spark = table.sparkSession
    path = f"{checkpoint_dir(spark)}/model-table-{uuid.uuid4().hex}"
    table.write.partitionBy(*by).parquet(path)
    kept = spark.read.schema(table.schema).parquet(path)
    return kept.select(*[f"`{c}`" for c in table.columns]) if by else kept
