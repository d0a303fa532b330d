"""Distributed running sums and ranks over a total order.

A window without ``partitionBy`` (or one whose partition key is hot) runs in
a single task.  Here the rows are dealt into ranges of the full order key,
segment columns first:

1. ``deal``: Spark's range exchange samples the composite key and picks the
   edges; the range number of every row is fixed by one reliable checkpoint, so
   a retried task or a lost executor sees the same ranges;
2. a window partitioned by (range, segment) makes local running sums;
3. ``edge_offsets``: ranges are ordered by segment first, so a segment can only
   go on from one range into the next as the last of the one and the first of
   the other.  The totals of these two are all that is carried over: at most
   two rows per range, whatever the number of segments, and so broadcast.

A segment (card, score value, ...) that holds a third of all rows spreads over
many ranges, and many small segments share one.  There is one path for all
sizes; the number of ranges is the session's shuffle partitions, or more when
the caller knows the row count and it asks for more.

Callers with wide rows hand in keys and values only and put the results back
with ``attach``, so payload is moved once, by that join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows that one range should not exceed when the row count is known.
ROWS_PER_RANGE = 2_000_000


def _norm_order(order) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def _sort_cols(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if a else F.col(c).desc() for c, a in order]


def range_count(df: DataFrame, buckets: int | None = None, n: int | None = None) -> int:
    return buckets or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((n or 0) / ROWS_PER_RANGE))


def deal(df: DataFrame, ranges: int, *keys: Column) -> DataFrame:
    """``df`` in ranges of ``keys``; the range number is ``__rng``."""
    return cut_lineage(df.repartitionByRange(ranges, *keys).withColumn("__rng", F.spark_partition_id()))


def edge_offsets(dealt: DataFrame, segment: Column, sums: Mapping[str, Column], later: bool = False, fine: bool = False) -> DataFrame:
    """(__rng, __seg, name...): what the ``sums`` of a range's first and last
    segment get from earlier (``later``: from later) ranges; 0 for nothing.
    ``fine``: segments have few rows, so a range's first and last one are found
    first and only these are added up, instead of all."""
    added = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()]
    first, last = F.min("__seg"), F.max("__seg")
    if fine:
        rows = dealt.withColumn("__seg", segment)
        edges = rows.groupBy(F.col("__rng").alias("__r")).agg(first.alias("__first"), last.alias("__last"))  # a row for each range
        at_edge = F.col("__seg").eqNullSafe(F.col("__first")) | F.col("__seg").eqNullSafe(F.col("__last"))
        ends = rows.join(F.broadcast(edges), (F.col("__rng") == F.col("__r")) & at_edge).groupBy("__rng", "__seg").agg(*added)
    else:
        totals = dealt.groupBy("__rng", segment.alias("__seg")).agg(*added)
        whole = F.struct("__seg", *sums)
        ends = totals.groupBy("__rng").agg(F.when(first.eqNullSafe(last), F.array(F.min_by(whole, "__seg"))).otherwise(F.array(F.min_by(whole, "__seg"), F.max_by(whole, "__seg"))).alias("__ends"))
        ends = ends.select("__rng", F.explode("__ends").alias("__end")).select("__rng", "__end.*")
    before = Window.partitionBy("__seg").orderBy(F.desc("__rng") if later else F.asc("__rng")).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("__rng", "__seg", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums])


def prefix_sum(
    df: DataFrame,
    order,
    values: dict[str, Column | str],
    partition_by: Sequence[str] = (),
    inclusive: bool | Mapping[str, bool] = True,
    buckets: int | None = None,
    n: int | None = None,
) -> DataFrame:
    """Add running sums ``values`` (name -> expression) over ``order``.

    ``inclusive`` counts the current row; otherwise strictly earlier rows; a
    mapping says it for each name (default: inclusive).  Sums over no rows are
    0; NULL segments are segments of their own.  The order should be unique
    within a segment for a deterministic result (add an id).  ``buckets`` sets
    the number of ranges.
    """
    order = _norm_order(order)
    partition_by = list(partition_by)
    tmp = {name: f"__v_{i}" for i, name in enumerate(values)}
    base = df
    for name, expr in values.items():
        base = base.withColumn(tmp[name], F.coalesce(F.col(expr) if isinstance(expr, str) else expr, F.lit(0)))

    # a struct of the segment columns compares NULLs as equal
    segment = F.struct(*partition_by) if partition_by else F.lit(0)
    dealt = deal(base.withColumn("__seg", segment), range_count(df, buckets, n), *[F.col(c) for c in partition_by], *_sort_cols(order))
    offsets = edge_offsets(dealt, F.col("__seg"), {f"__o_{i}": F.col(t) for i, t in enumerate(tmp.values())})
    offsets = F.broadcast(offsets.withColumnsRenamed({"__rng": "__off_rng", "__seg": "__off_seg"}))  # two rows per range at most

    def local(name: str):
        held = inclusive if isinstance(inclusive, bool) else inclusive.get(name, True)
        return Window.partitionBy("__rng", "__seg").orderBy(*_sort_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow if held else -1)

    out = dealt.select("*", *[F.coalesce(F.sum(t).over(local(name)), F.lit(0)).alias(f"__l_{i}") for i, (name, t) in enumerate(tmp.items())])
    out = out.join(offsets, (F.col("__rng") == F.col("__off_rng")) & F.col("__seg").eqNullSafe(F.col("__off_seg")), "left")
    made = {name: F.col(f"__l_{i}") + F.coalesce(F.col(f"__o_{i}"), F.lit(0)) for i, name in enumerate(values)}
    kept = [c for c in df.columns if c not in made]
    return out.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(name) for name, c in made.items()])


def global_rank(df: DataFrame, order, name: str = "rank", partition_by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """1-based row number over a total order (ties broken by the order
    columns, so include a unique id)."""
    out = prefix_sum(df, order, {name: F.lit(1).cast("long")}, partition_by=partition_by, buckets=buckets)
    return out.withColumn(name, F.col(name).cast("long"))


def attach(df: DataFrame, found: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with the columns ``values`` of ``found`` (rows of the same
    ``keys``); of several rows of one key the largest values, compared in the
    order of ``values``.  NULL keys are equal."""
    one = found.groupBy(*keys).agg(F.max(F.struct(*values)).alias("__found"))
    one = one.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], "__found")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__k_{i}"))
    kept = [c for c in df.columns if c not in values]
    return df.join(one, same, "left").select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__found.`{v}`").alias(v) for v in values])
