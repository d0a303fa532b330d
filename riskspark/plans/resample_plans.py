"""Queries for SMOTE (ML6) on `embeddings`: the smallest label against the
rest, 64-dimensional vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resample as rs
from ..sources.tables import table
from .registry import register

K = 5
SEED = 42


def _minority(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    lab = e.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "label").first()["label"]
    return e, lab


MIN_SQL = """
lab AS (SELECT label FROM embeddings GROUP BY label ORDER BY count(*), label LIMIT 1),
mn AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = (SELECT label FROM lab)),
pairs AS (SELECT a.vec_id AS id, b.vec_id AS nid, list_distance(a.v, b.v) AS d FROM mn a JOIN mn b ON a.vec_id <> b.vec_id),
knn AS (SELECT id, nid, d, row_number() OVER (PARTITION BY id ORDER BY d, nid) AS rk FROM pairs)"""


@register(
    "smote_knn",
    f"""WITH {MIN_SQL.strip()}
        SELECT id AS vec_id, CAST(rk AS BIGINT) AS neighbor_rank, nid AS neighbor_id, round(d, 6) AS distance FROM knn WHERE rk <= {K}""",
)
def smote_knn(spark, sf_dir):
    """Exact 5 nearest minority neighbours of every minority vector (the
    oracle compares against brute force)."""
    e, lab = _minority(spark, sf_dir)
    m = e.where(F.col("label") == lab).select("vec_id", F.col("embedding").alias("vec"))
    knn = rs.exact_knn(m, K, "vec_id", "vec")
    return knn.select("vec_id", "neighbor_rank", "neighbor_id", F.round("distance", 6).alias("distance"))


@register(
    "smote_oversample",
    f"""WITH {MIN_SQL.strip()},
        cnt AS (SELECT count(*) FILTER (WHERE label <> (SELECT label FROM lab)) - count(*) FILTER (WHERE label = (SELECT label FROM lab)) AS n_new,
                       count(*) FILTER (WHERE label = (SELECT label FROM lab)) AS m FROM embeddings),
        js AS (SELECT j FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS j FROM embeddings) WHERE j < (SELECT n_new FROM cnt)),
        h AS (SELECT j, md5(CAST(j AS VARCHAR) || ':' || '{SEED}') AS h FROM js),
        rr AS (SELECT vec_id, v, row_number() OVER (ORDER BY vec_id) AS r FROM mn),
        syn AS (SELECT j, j % (SELECT m FROM cnt) + 1 AS r,
                       CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % least({K}, (SELECT m FROM cnt) - 1) + 1 AS nn,
                       CAST(('0x' || substr(h, 9, 8)) AS BIGINT) / 4294967296.0 AS gap FROM h)
        SELECT syn.j AS syn_id, rr.vec_id AS base_id, knn.nid AS neighbor_id, round(syn.gap, 9) AS gap,
               CAST(a.axis AS BIGINT) AS axis, round(rr.v[a.axis] + syn.gap * (nb.v[a.axis] - rr.v[a.axis]), 6) AS value
        FROM syn JOIN rr ON syn.r = rr.r JOIN knn ON knn.id = rr.vec_id AND knn.rk = syn.nn JOIN mn nb ON nb.vec_id = knn.nid
             JOIN (SELECT unnest(range(1, 65)) AS axis) a ON a.axis <= len(rr.v)""",
)
def smote_oversample(spark, sf_dir):
    """Synthetic minority rows up to parity with the rest (train-side
    SMOTE): base, neighbour, gap and every coordinate, one row each."""
    e, lab = _minority(spark, sf_dir)
    df = e.select("vec_id", F.col("embedding").alias("vec"), (F.col("label") == lab).cast("int").alias("is_min"))
    syn, _ = rs.oversample_to_parity(df, "is_min", 1, "vec_id", "vec", K, SEED)
    rows = syn.select("syn_id", "base_id", "neighbor_id", F.round("gap", 9).alias("gap"), F.posexplode("vec").alias("axis", "value"))
    return rows.withColumns({"axis": (F.col("axis") + 1).cast("long"), "value": F.round("value", 6)})
