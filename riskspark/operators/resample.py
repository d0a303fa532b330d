"""ML6: SMOTE - minority oversampling by interpolation towards one of the k
nearest minority neighbours (k = 5 by default, as in the reference's
library), applied to the train side only.

Exact k nearest neighbours by a pivot index
-------------------------------------------
1. About 2 sqrt(n) points (at most ``PIVOTS``) are pivots: of ``_DRAWN`` times as
   many, the first by a hash of their id, those that lie farthest apart.  Every point goes to the cell of its nearest pivot and there to
   one of up to ``RINGS`` rings by its distance to that pivot.  Pivots, and a low and
   high distance for each ring, are all that the driver and the tasks hold.
2. Bound: the k-th nearest of the pivots and of the neighbours in the own ring
   gives r(x), which the true k-th distance can't exceed.
3. Search: a ring is asked only if the triangle inequality lets a point of it
   lie within r(x): its pivot's distance less or plus the ring's distances, and
   half the difference of the distances to its pivot and to the own one.  Inside
   a ring the same test runs point by point, over the distances to all of
   ``GUIDES`` common pivots, before a distance is computed.
4. The best of all asked rings are ranked per point (ties by id).

Nothing is capped: every ring that may hold a closer point is searched.  Points
with the same vector count once for the search, with their k + 1 smallest ids;
any further copy has the first k of them as neighbours.  A ring that many points
ask is handed out in copies, so no task gets all questions.  How many pairs are
compared follows the data's spread: vectors in groups or near a surface of few
dimensions need a small share; directions drawn evenly in 64 dimensions lie at
nearly equal distances from one another, and no index can leave any out.

Oversampling: synthetic j takes base point number (j mod m) in id order, a
neighbour index and an interpolation gap from md5(j ':' seed), so the result
is deterministic and identical in any engine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .modeltables import keep
from .ordering import global_rank

DEFAULT_K = 5

PIVOTS, RINGS, GUIDES = 2048, 8, 16

#: Points drawn for each pivot.
_DRAWN = 4

#: Points that ask one copy of a ring.
_ASKERS = 4096

#: Pairs looked at in one go.
_PAIRS = 1 << 18


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean, each row of ``a`` to each of ``b``, by differences (exact
    zeros for equal rows); a few thousand pairs at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 20) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None]) ** 2).sum(axis=2))
    return out


def _widened(r):
    """Distances are rounded; what lies on the edge stays in."""
    return r * (1 + 1e-9) + 1e-12


def _far_apart(vecs: np.ndarray, m: int) -> list[int]:
    """The first row, then always the one farthest from all chosen so far."""
    chosen, gap = [0][: len(vecs)], np.full(len(vecs), np.inf)
    while chosen and len(chosen) < m:
        gap = np.minimum(gap, distances(vecs[chosen[-1:]], vecs)[0])
        far = int(gap.argmax())
        if not gap[far]:
            break
        chosen.append(far)
    return chosen


def _may(to_x: np.ndarray, to_y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) whose distances to every guide differ by r[i] at most; after the
    first few guides only pairs still left are looked at."""
    left = np.ones((len(to_x), len(to_y)), bool)
    for g in range(min(4, to_x.shape[1])):
        left &= np.abs(to_y[:, g] - to_x[:, g, None]) <= r[:, None]
    i, j = np.nonzero(left)
    for g in range(4, to_x.shape[1]):
        stay = np.abs(to_y[j, g] - to_x[i, g]) <= r[i]
        i, j = i[stay], j[stay]
    return i, j


class _Index:
    """Pivots, and of every ring its lowest and highest distance to its pivot."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.edges = np.empty((len(pivots), 0))
        self.low = self.high = None

    def cells(self, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances to all pivots, the nearest pivot, the distance to it."""
        to = distances(vecs, self.pivots)
        cell = to.argmin(axis=1)
        return to, cell, to[np.arange(len(vecs)), cell]

    def rings(self, cell: np.ndarray, far: np.ndarray) -> np.ndarray:
        return (self.edges[cell] < far[:, None]).sum(axis=1)

    def asked(self, vecs: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, cell, ring) wherever a ring may hold a point within r."""
        to, _, own = self.cells(vecs)
        r = _widened(r)
        near = (to - own[:, None]) / 2 <= r[:, None]
        point, cell = np.nonzero(near)
        d = to[point, cell]
        inside = (d[:, None] - self.high[cell] <= r[point, None]) & (self.low[cell] - d[:, None] <= r[point, None])
        which, ring = np.nonzero(inside)
        return point[which], cell[which], ring


def _few_copies(pts: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The k + 1 smallest ids of every vector, and the copies beyond them with
    their neighbours.  Spark applies the rank's limit before the shuffle."""
    order = Window.partitionBy("vec").orderBy("id")
    few = cut_lineage(pts.withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= k + 1))
    full = few.groupBy("vec").agg(F.max("copy").alias("copies"), F.max("id").alias("last")).filter(F.col("copies") == k + 1).select("vec", "last")
    beyond = pts.join(full, "vec").filter(F.col("id") > F.col("last")).select("id", "vec")
    first = few.filter(F.col("copy") <= k).select("vec", F.col("id").alias("nid"))
    return few.drop("copy"), beyond.join(first, "vec").select("id", "nid", F.lit(0.0).alias("d"))


def _candidates(points: DataFrame, k: int, block_size: int) -> DataFrame:
    """(id, nid, d, compared) over ``points`` (id, vec): the best k of every ring
    that a point asks; ``compared`` counts distances, in rows without nid."""
    n = points.count()
    m = max(1, min(PIVOTS, 2 * math.isqrt(n) + 1))
    drawn = points.orderBy(F.xxhash64("id"), "id").limit(_DRAWN * m).collect()  # at most _DRAWN * PIVOTS rows
    drawn = np.array([r["vec"] for r in drawn], float).reshape(len(drawn), -1 if drawn else 0)
    index = _Index(drawn[_far_apart(drawn, m)])
    guides = index.pivots[:GUIDES]
    rings = max(1, min(RINGS, n // (m * block_size)))  # a ring bounds r only if it holds some points
    id_type = points.schema["id"].dataType
    fields = [T.StructField("id", id_type), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType()), T.StructField("r", T.DoubleType())]

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                to, cell, far = index.cells(_matrix(part.column("vec")))
                r = np.full(len(cell), np.inf)
                if len(index.pivots) > k:
                    r = np.partition(to, k, axis=1)[:, k]  # the own one may be among them
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("vec"), pa.array(cell, pa.int32()), pa.array(far), pa.array(r)], [f.name for f in fields])

    placed = cut_lineage(points.select("id", "vec").mapInArrow(assign, T.StructType(fields)))
    cut = F.percentile_approx("far", F.array(*[F.lit((i + 1) / rings) for i in range(rings)]), F.lit(1000))
    edges = {r["cell"]: r["edges"] for r in placed.groupBy("cell").agg(cut.alias("edges")).collect()}  # a row for each pivot
    index.edges = np.array([edges.get(c, [0.0] * rings)[: rings - 1] for c in range(len(index.pivots))]).reshape(len(index.pivots), rings - 1)

    ringed = T.StructType([*fields, T.StructField("ring", T.IntegerType())])

    def with_ring(batches):
        for batch in batches:
            found = index.rings(batch.column("cell").to_numpy(), batch.column("far").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], ringed.names)

    rows = cut_lineage(placed.mapInArrow(with_ring, ringed))
    index.low, index.high = np.full((len(index.pivots), rings), np.inf), np.full((len(index.pivots), rings), -np.inf)
    for r in rows.groupBy("cell", "ring").agg(F.min("far").alias("low"), F.max("far").alias("high")).collect():  # RINGS rows for each pivot at most
        index.low[r["cell"], r["ring"]], index.high[r["cell"], r["ring"]] = r["low"], r["high"]

    asking = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("ring", T.IntegerType()), *fields[:2], T.StructField("r", T.DoubleType())])

    def bounded(group: pa.Table) -> pa.Table:
        """r from up to ``block_size`` neighbours in the ring, by distance to the pivot."""
        order = np.argsort(group.column("far").to_numpy(), kind="stable")
        vecs, r = _matrix(group.column("vec"))[order], group.column("r").to_numpy()[order].copy()
        for at in range(0, len(order), block_size):
            part = vecs[max(0, min(at, len(order) - block_size)) : at + block_size]
            if len(part) > k:
                d = distances(vecs[at : at + block_size], part)
                r[at : at + block_size] = np.minimum(r[at : at + block_size], np.partition(d, k, axis=1)[:, k])
        return pa.table({"id": group.column("id").take(pa.array(order)), "vec": group.column("vec").take(pa.array(order)), "r": r})

    bounds = rows.groupBy("cell", "ring").applyInArrow(bounded, T.StructType([*fields[:2], T.StructField("r", T.DoubleType())]))

    def ask(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                point, cell, ring = index.asked(_matrix(part.column("vec")), part.column("r").to_numpy())
                for lo in range(0, len(point), 8192):
                    own = part.take(pa.array(point[lo : lo + 8192]))
                    yield pa.RecordBatch.from_arrays([pa.array(cell[lo : lo + 8192], pa.int32()), pa.array(ring[lo : lo + 8192], pa.int32()), *own.columns], asking.names)

    asked = cut_lineage(bounds.mapInArrow(ask, asking))
    copies = asked.groupBy("cell", "ring").agg(F.ceil(F.count("*") / F.lit(_ASKERS)).cast("int").alias("copies"))  # RINGS rows for each pivot at most
    dealt = asked.join(F.broadcast(copies), ["cell", "ring"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("copies"))).drop("copies")
    held = rows.select("cell", "ring", "id", "vec").join(F.broadcast(copies), ["cell", "ring"])
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies").cast("long") - 1))).drop("copies")
    result = T.StructType([T.StructField("id", id_type), T.StructField("nid", id_type), T.StructField("d", T.DoubleType()), T.StructField("compared", T.LongType())])
    arrow = to_arrow_schema(result)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        x, y, r = _matrix(left.column("vec")), _matrix(right.column("vec")), _widened(left.column("r").to_numpy())
        to_x, to_y = distances(x, guides), distances(y, guides)
        same = {v: i for i, v in enumerate(right.column("id").to_pylist())}
        own = np.array([same.get(v, -1) for v in left.column("id").to_pylist()])
        who, what, how, done = [], [], [], 0
        step = max(1, _PAIRS // len(y))
        for at in range(0, len(x), step):
            i, j = _may(to_x[at : at + step], to_y, r[at : at + step])
            i += at
            other = j != own[i]
            i, j = i[other], j[other]
            done += len(i)
            d = np.concatenate([np.sqrt(((y[j[lo : lo + _PAIRS]] - x[i[lo : lo + _PAIRS]]) ** 2).sum(axis=1)) for lo in range(0, len(i), _PAIRS)] or [np.empty(0)])
            near = np.flatnonzero(d <= r[i])
            near = near[np.lexsort((d[near], i[near]))]
            i, j, d = i[near], j[near], d[near]
            begins = np.searchsorted(i, i)
            last = np.minimum(begins + k, np.searchsorted(i, i, side="right")) - 1
            keep = d <= d[last]  # equal distances at the end all stay: ids decide later
            who.append(i[keep])
            what.append(j[keep])
            how.append(d[keep])
        who, what = (pa.array(np.concatenate(z).astype(np.int64)) for z in (who, what))
        found = pa.Table.from_arrays([left.column("id").take(who), right.column("id").take(what), pa.array(np.concatenate(how)), pa.nulls(len(who), pa.int64())], schema=arrow)
        count = pa.Table.from_arrays([pa.nulls(1, arrow.field("id").type), pa.nulls(1, arrow.field("nid").type), pa.nulls(1, pa.float64()), pa.array([done], pa.int64())], schema=arrow)
        return pa.concat_tables([found, count])

    return dealt.groupBy("cell", "ring", "part").cogroup(held.groupBy("cell", "ring", "part")).applyInArrow(search, result)


def exact_knn(points: DataFrame, k: int = DEFAULT_K, id_col: str = "id", vec: str = "vec", block_size: int = 256) -> DataFrame:
    """(id, neighbor_rank, neighbor_id, distance) for the k nearest other
    points of every point (exact; ties by id).  Ids are distinct; a point
    without a vector is left out."""
    pts = points.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec")).filter("vec IS NOT NULL")
    few, copies = _few_copies(pts, k)
    found = _candidates(few, k, max(block_size, 2)).filter("nid IS NOT NULL").select("id", "nid", "d").unionByName(copies)
    w = Window.partitionBy("id").orderBy("d", "nid")
    res = found.withColumn("neighbor_rank", F.row_number().over(w)).where(F.col("neighbor_rank") <= k)
    return res.select(F.col("id").alias(id_col), F.col("neighbor_rank").cast("long"), F.col("nid").alias("neighbor_id"), F.col("d").alias("distance"))


def hash_int(h: Column, start: int) -> Column:
    """Unsigned 32-bit integer from 8 hex digits of an md5 text."""
    return F.conv(F.substring(h, start, 8), 16, 10).cast("long")


def smote(
    minority: DataFrame, n_new: int, k: int = DEFAULT_K, id_col: str = "id", vec: str = "vec", seed: int = 42, knn: DataFrame | None = None
) -> DataFrame:
    """``n_new`` synthetic minority rows: (syn_id, base_id, neighbor_id,
    gap, vec).  Synthetic j interpolates base (j mod m) towards its nn-th
    neighbour, nn and gap from md5(j:seed)."""
    v = F.col(vec).cast("array<double>")
    size = minority.agg(F.count(F.lit(1)).alias("m"), F.min(F.size(v)).alias("low"), F.max(F.size(v)).alias("high")).first()
    m = size["m"]
    if m < 2:
        raise ValueError("no neighbour to interpolate with: fewer than two minority rows")
    k_eff = min(k, m - 1)
    if knn is None:
        knn = exact_knn(minority, k_eff, id_col, vec)
    # Vectors are moved twice for each new row, to it from its neighbour and from its
    # base; until then a new row is a few numbers, made where its base's neighbours are.
    base = keep(global_rank(minority.select(F.col(id_col).alias("base_id"), v.alias("bvec")), ["base_id"], "__r"))
    near = knn.groupBy(F.col(id_col).alias("__of")).agg(F.sort_array(F.collect_list(F.struct("neighbor_rank", "neighbor_id"))).alias("__near"))  # k of each
    syn = base.select("base_id", "__r").join(near, F.col("base_id") == F.col("__of"))
    own = F.when(F.col("__r") <= n_new, F.sequence(F.col("__r") - 1, F.lit(n_new - 1).cast("long"), F.lit(m).cast("long")))
    syn = syn.select("base_id", "__r", "__near", F.explode(own).alias("syn_id"))
    syn = syn.withColumn("__h", F.md5(F.concat(F.col("syn_id").cast("string"), F.lit(":"), F.lit(str(seed)))))
    syn = syn.select(
        "syn_id", "base_id", "__r", F.get("__near", F.pmod(hash_int(F.col("__h"), 1), F.lit(k_eff)).cast("int"))["neighbor_id"].alias("neighbor_id"),
        (hash_int(F.col("__h"), 9) / F.lit(4294967296.0)).alias("gap"),
    )
    nv = minority.select(F.col(id_col).alias("neighbor_id"), v.alias("nvec"))
    out = syn.join(nv, "neighbor_id").join(base.select("__r", "bvec"), "__r")
    gap = F.col("gap")
    if size["low"] == size["high"] and (size["high"] or 0) > 0:  # of one length: compiled
        made = F.array(*[F.col("bvec")[i] + gap * (F.col("nvec")[i] - F.col("bvec")[i]) for i in range(size["high"])])
    else:
        made = F.zip_with("bvec", "nvec", lambda a, b: a + gap * (b - a))
    return out.select("syn_id", "base_id", "neighbor_id", "gap", made.alias("vec"))


def oversample_to_parity(df: DataFrame, label: str, minority_value, id_col: str = "id", vec: str = "vec", k: int = DEFAULT_K, seed: int = 42):
    """Train-side SMOTE: adds minority rows until both classes have the same
    count.  Returns (synthetic rows, n_new)."""
    counts = df.agg(F.count_if(F.col(label) == minority_value).alias("m"), F.count_if(F.col(label) != minority_value).alias("M")).first()
    n_new = max(0, counts["M"] - counts["m"])
    # read by each step of the search and by the interpolation
    minority = keep(df.where(F.col(label) == minority_value))
    return smote(minority, n_new, k, id_col, vec, seed), n_new
