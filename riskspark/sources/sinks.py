"""IO4-IO6 sinks: tables are written as Parquet (CSV optional), reports as
tidy JSON lines.  Writes go through Spark's committers (task retries and
executor loss do not leave partial files)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """IO4/IO5: merged or feature table sink."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_report(report_long: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO6: a tidy (section, key, metric, value) report as JSON lines;
    non-finite values are written as null."""
    from pyspark.sql import functions as F

    v = F.col("value")
    clean = report_long.withColumn("value", F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v))
    clean.write.mode(mode).json(path)
