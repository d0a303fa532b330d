"""ML9-ML12, S10, PS5-PS6: run history and a model registry as tables.

``runs`` rows: (run_id, experiment, start_time, metrics...).  ``versions``:
(name, version, registered_at, ...), ``promotions``: (name, alias,
version, promoted_at).  All are append-only tables; the queries below are
plain DataFrame operations over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.columns import number, psi_verdict
from .modeltables import keep
from .drift import PSI_EPSILON, STATUS_COULD_NOT_RUN, STATUS_OK, STATUS_SIGNIFICANT_SHIFT, _bin_expr, _long, psi_edges


def union_runs(frames: Sequence[DataFrame]) -> DataFrame:
    """Experiments with different metric sets, missing -> NULL, newest
    first."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.orderBy(F.col("start_time").desc(), F.col("run_id").desc())


def metric_history(runs: DataFrame, metric: str) -> DataFrame:
    """PS6: only runs that logged ``metric``, oldest first."""
    if metric not in runs.columns:
        return runs.limit(0).select("run_id", "start_time", F.lit(None).cast("double").alias(metric))
    return runs.where(F.col(metric).isNotNull()).select("run_id", "start_time", metric).orderBy("start_time", "run_id")


def list_versions(versions: DataFrame, name: str) -> DataFrame:
    """ML11: a model's versions, highest version number first (numeric)."""
    return versions.where(F.col("name") == name).orderBy(F.col("version").cast("long").desc())


def champion(promotions: DataFrame, name: str, alias: str = "champion") -> DataFrame:
    """ML10: the version the alias points at = its latest promotion; empty
    when never promoted."""
    p = promotions.where((F.col("name") == name) & (F.col("alias") == alias))
    return p.groupBy("name", "alias").agg(
        F.max_by("version", F.struct("promoted_at", F.col("version").cast("long"))).alias("version"),
        F.max("promoted_at").alias("promoted_at"),
    )


class PsiReference:
    """Edges and expected counts of one value, fitted once and kept."""

    def __init__(self, expected: DataFrame, value: str, bins: int = 10, decimals: int | None = None):
        self.value = value
        self.edges = psi_edges(expected.select(value), [value], bins, decimals)
        bin_ = _bin_expr(self.edges).alias("bin")
        self.counts = keep(_long(expected, [value]).groupBy(bin_).agg(F.count(F.lit(1)).alias("n_expected")))

    @classmethod
    def known(cls, value: str, edges: dict[str, list[float]], counts: DataFrame) -> PsiReference:
        """A reference that was fitted before and stored."""
        made = cls.__new__(cls)
        made.value, made.edges, made.counts = value, edges, counts
        return made

    @property
    def usable(self) -> bool:
        """There is more than one value to compare with."""
        return self.counts.where(F.col("bin").startswith("bin_")).agg(F.sum("n_expected")).first()[0] is not None and bool(self.edges.get(self.value))

    def batches(self, actual: DataFrame, batch: str) -> DataFrame:
        """(batch, psi, verdict) in one job for all batches.  Each batch is
        smoothed over the bins seen in expected or in that batch."""
        al = _long(actual.withColumn("__batch", F.col(batch)), [self.value], ["__batch"])
        ca = al.groupBy("__batch", _bin_expr(self.edges).alias("bin")).agg(F.count(F.lit(1)).alias("n_actual"))
        # every batch is compared with the same few bins (at most bins + 1 rows)
        expected = F.broadcast(self.counts.agg(F.collect_list(F.struct("bin", "n_expected")).alias("expected")))
        pairs = ca.select("__batch").distinct().crossJoin(expected).select("__batch", F.inline("expected"))
        t = pairs.join(ca, ["__batch", "bin"], "full_outer").fillna(0, ["n_expected", "n_actual"])
        w = Window.partitionBy("__batch")
        nb, ne, na = F.count(F.lit(1)).over(w), F.sum("n_expected").over(w), F.sum("n_actual").over(w)
        pe = (F.col("n_expected") + PSI_EPSILON) / (ne + PSI_EPSILON * nb)
        pa = (F.col("n_actual") + PSI_EPSILON) / (na + PSI_EPSILON * nb)
        t = t.withColumn("c", (pa - pe) * F.ln(pa / pe))
        return t.groupBy(F.col("__batch").alias(batch)).agg(F.sum("c").alias("psi")).withColumn("verdict", psi_verdict("psi"))


RUN_SCHEMA = "n_rows long, psi double, verdict string, status int, run_id string"


def monitor_run(
    reference: DataFrame | PsiReference, actual: DataFrame, value: str, runs_path: str, run_id: str, bins: int = 10, decimals: int | None = None
) -> DataFrame:
    """PS5: one monitoring run against reference rows or a stored reference,
    written to its own folder of the runs table (a repeated run replaces it);
    returns the table.  Status 0 or 1 by the verdict, 2 when there is nothing to
    compare: no actual rows, or a reference with fewer than two values."""
    spark = actual.sparkSession
    n = actual.count()
    if isinstance(reference, PsiReference):
        fitted = reference if reference.usable else None
    else:
        values = reference.select(number(F.col(value).cast("double")).alias("v")).where("v is not null").distinct().limit(2).count()
        fitted = PsiReference(reference, value, bins, decimals) if n and values == 2 else None
    if n and fitted is not None:
        found = monitor_status(fitted.batches(actual.withColumn("__run", F.lit(run_id)), "__run"))
        row = found.select("psi", "verdict", F.col("status").cast("int").alias("status"))
    else:
        row = spark.range(1).select(
            F.lit(None).cast("double").alias("psi"), F.lit("could_not_run").alias("verdict"), F.lit(STATUS_COULD_NOT_RUN).alias("status")
        )
    row.select(F.lit(n).cast("long").alias("n_rows"), "psi", "verdict", "status").write.mode("overwrite").parquet(f"{runs_path}/run_id={run_id}")
    return spark.read.schema(RUN_SCHEMA).parquet(runs_path)


VERSION_SCHEMA = "metrics map<string,double>, model_path string, name string, version string"
PROMOTION_SCHEMA = "version string, promoted_at timestamp, name string, alias string, event long"


def _read(spark, path: str, schema: str) -> DataFrame:
    """A registry table; empty before its first write."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def versions(spark, root: str) -> DataFrame:
    return _read(spark, f"{root}/versions", VERSION_SCHEMA)


def promotions(spark, root: str) -> DataFrame:
    return _read(spark, f"{root}/promotions", PROMOTION_SCHEMA)


def _claim(spark, path: str) -> None:
    """Creates an empty file that no one else may have created: of two writers at
    once one gets an error, and neither replaces what the other has written."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(file):
        raise FileExistsError(f"another writer has taken {path}; try again")


def register_version(spark, root: str, name: str, metrics: dict[str, float], model_path: str) -> str:
    """ML9: adds the next version of a model with its metrics and the place of
    the fitted model, one folder per version; returns the version.  A version
    that another writer takes meanwhile is an error."""
    last = versions(spark, root).where(F.col("name") == name).agg(F.max(F.col("version").cast("long"))).first()[0] or 0
    row = spark.createDataFrame([({k: float(v) for k, v in metrics.items()}, model_path)], "metrics map<string,double>, model_path string")
    _claim(spark, f"{root}/claims/version-{name}-{last + 1}")
    row.write.mode("error").parquet(f"{root}/versions/name={name}/version={last + 1}")
    return str(last + 1)


def promote(spark, root: str, name: str, version: str, alias: str = "champion", at=None) -> None:
    """ML10: appends a promotion event for a registered version, now or ``at``
    the given time; an event that another writer takes meanwhile is an error."""
    if versions(spark, root).where((F.col("name") == name) & (F.col("version") == version)).isEmpty():
        raise ValueError(f"no version {version} of {name!r} to promote")
    event = promotions(spark, root).where((F.col("name") == name) & (F.col("alias") == alias)).count()
    row = spark.range(1).select(F.lit(version).alias("version"), (F.current_timestamp() if at is None else F.lit(at).cast("timestamp")).alias("promoted_at"))
    _claim(spark, f"{root}/claims/promotion-{name}-{alias}-{event}")
    row.write.mode("error").parquet(f"{root}/promotions/name={name}/alias={alias}/event={event}")


def in_force(runs: DataFrame, promotions: DataFrame, name_col: str = "name", time_col: str = "start_time", alias: str = "champion") -> DataFrame:
    """ML12: ``runs`` with the version of their model that ``alias`` pointed at
    when they started: the latest promotion at or before that time (of several
    at one time the last event); NULL before the first.  One pass over runs and
    promotions in order of time, per model."""
    events = promotions.where(F.col("alias") == alias).select(
        F.col("name").alias("__name"), F.col("promoted_at").alias("__time"), F.lit(0).alias("__kind"), F.col("event").alias("__event"), F.col("version").alias("__version")
    )
    own = F.struct(*[F.col(f"`{c}`") for c in runs.columns])
    rows = runs.select(F.col(name_col).alias("__name"), F.col(time_col).cast("timestamp").alias("__time"), F.lit(1).alias("__kind"), own.alias("__run"))
    order = Window.partitionBy("__name").orderBy("__time", "__kind", "__event").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = events.unionByName(rows, allowMissingColumns=True).withColumn("__version", F.last("__version", ignorenulls=True).over(order))
    return both.where(F.col("__kind") == 1).select("__run.*", F.col("__version").alias(alias))


def psi_by_batch(expected: DataFrame, actual: DataFrame, value: str, batch: str, bins: int = 10, decimals: int | None = None) -> DataFrame:
    """PSI of each actual batch against one expected sample: (batch, psi, verdict)."""
    return PsiReference(expected, value, bins, decimals).batches(actual, batch)


def monitor_status(psi_df: DataFrame) -> DataFrame:
    """PS5 outcome: status 1 on a significant shift, else 0."""
    return psi_df.withColumn(
        "status", F.when(F.col("verdict") == "significant_shift", STATUS_SIGNIFICANT_SHIFT).otherwise(STATUS_OK)
    )
