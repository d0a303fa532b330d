"""GR1-GR5: an entity graph as tables, and label-free neighbour features.

Nodes are rows of a DataFrame, edges a DataFrame (txn, entity_type,
entity) from unpivoting entity columns; NULL entities give no edge.  Message
passing is joins + grouped means.  Grouped means are partially aggregated
(a hub entity never sits whole in one task); joins back to the edges are
left to AQE, which broadcasts the entity table at runtime only when its
materialised size is under the threshold and splits skewed hub partitions
otherwise.  No degree cap: every edge is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .learners import fit_standardizer, impute_median, standardize
from .modeltables import keep


def node_table(
    train: DataFrame, test: DataFrame, id_col: str, features: Sequence[str], label: str | None = None
) -> DataFrame:
    """GR1: train and test rows with a mask column, features imputed with
    the train median and scaled with train mean / population std."""
    nodes = train.withColumn("mask", F.lit("train")).unionByName(test.withColumn("mask", F.lit("test")))
    fit = nodes.where(F.col("mask") == "train")
    imputed = impute_median(nodes, features, fit_df=fit)
    scaler = fit_standardizer(imputed.where(F.col("mask") == "train"), features)
    out = standardize(imputed, scaler, features)
    cols = [id_col, "mask", *features] + ([label] if label else [])
    return out.select(*cols)


def edge_table(df: DataFrame, id_col: str, entity_cols: Sequence[str]) -> DataFrame:
    """GR3: distinct (txn, entity_type, entity) for non-NULL entities."""
    e = df.select(
        F.col(id_col).alias("txn"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("entity_type"), F.col(c).cast("string").alias("entity")) for c in entity_cols])).alias("kv"),
    ).select("txn", "kv.entity_type", "kv.entity")
    return e.where(F.col("entity").isNotNull()).distinct()


def reverse_edges(edges: DataFrame) -> DataFrame:
    """GR3 reverse direction: entity -> txn."""
    return edges.select(
        F.col("entity_type").alias("src_type"), F.col("entity").alias("src"), F.lit("txn").alias("dst_type"), F.col("txn").cast("string").alias("dst")
    )


def entity_nodes(edges: DataFrame) -> DataFrame:
    """GR2: distinct entities with the constant feature 1.0."""
    return edges.select("entity_type", "entity").distinct().withColumn("feature", F.lit(1.0))


#: An entity is a hub if it has more than this share of all edges; there are at
#: most ``1 / HUB_SHARE`` of them, so their means may be broadcast.
HUB_SHARE = 0.001


def hub_entities(degrees: DataFrame, share: float = HUB_SHARE) -> DataFrame:
    """(entity_type, entity, hub) of ``degrees`` (entity_type, entity, n): the hubs,
    written once."""
    total = degrees.agg(F.sum("n").alias("__total"))
    hubs = degrees.crossJoin(F.broadcast(total)).where(F.col("n") > share * F.col("__total"))
    return cut_lineage(hubs.select("entity_type", "entity", F.lit(True).alias("hub")))


def split_hubs(edges: DataFrame, share: float = HUB_SHARE, hubs: DataFrame | None = None) -> DataFrame:
    """``edges`` with the flag ``hub``, a lookup among at most ``1 / share`` hubs;
    ``hubs`` spares counting the edges."""
    if hubs is None:
        edges = keep(edges)
        hubs = hub_entities(edges.groupBy("entity_type", "entity").agg(F.count(F.lit(1)).alias("n")), share)
    flagged = edges.join(F.broadcast(hubs), ["entity_type", "entity"], "left")
    return flagged.withColumn("hub", F.coalesce("hub", F.lit(False)))


def khop_features(nodes: DataFrame, edges: DataFrame, id_col: str, features: Sequence[str], hops: int = 1, share: float = HUB_SHARE) -> DataFrame:
    """GR4: the node's id and, for each hop k, the columns ``nb{k}_{feature}``.
    Per hop an entity's value is the mean of its transactions' features, and a
    transaction sums over entity types the mean of its entities' values.
    Transactions without edges get 0.0.

    Entity means are partially aggregated.  On the way back an entity's edges
    meet its mean by a join on the entity; edges of hubs take theirs from a
    broadcast table of at most 1 / share rows instead, so an entity with a third
    of all edges is never one task."""
    keys = ["entity_type", "entity"]
    # Edges are read three times a hop: as columns of a file, not as checkpointed rows.
    edges = keep(edges)
    cur = keep(nodes.select(F.col(id_col).alias("txn"), *features))
    out, flagged = cur.select("txn"), None
    for k in range(1, hops + 1):
        ent = keep(edges.join(cur, "txn").groupBy(*keys).agg(*[F.avg(f).alias(f) for f in features], F.count(F.lit(1)).alias("n")))
        if flagged is None:  # the first hop has counted the edges of every entity
            hubs = hub_entities(ent.select(*keys, "n"), share)
            flagged = split_hubs(edges, share, hubs)
        ent = ent.drop("n")
        plain = flagged.where("not hub").drop("hub").join(ent, keys)
        heavy = flagged.where("hub").drop("hub").join(F.broadcast(ent.join(F.broadcast(hubs), keys, "left_semi")), keys)
        per_type = plain.unionByName(heavy).groupBy("txn", "entity_type").agg(*[F.avg(f).alias(f) for f in features])
        summed = per_type.groupBy("txn").agg(*[F.sum(f).alias(f) for f in features])
        cur = keep(cur.select("txn").join(summed, "txn", "left").fillna(0.0, list(features)))
        out = out.join(cur.select("txn", *[F.col(f).alias(f"nb{k}_{f}") for f in features]), "txn")
    return out.withColumnRenamed("txn", id_col)


def khop_mean(nodes: DataFrame, edges: DataFrame, id_col: str, features: Sequence[str], hops: int = 1) -> DataFrame:
    """GR4: the columns of the last hop, under the features' names."""
    found = khop_features(nodes, edges, id_col, features, hops)
    return found.select(id_col, *[F.col(f"nb{hops}_{f}").alias(f) for f in features])


def shared_entity_reach(edges: DataFrame, id_col: str = "txn") -> DataFrame:
    """GR5: per transaction and entity type, how many other transactions
    share one of its entities (sum of degree - 1, with multiplicity) and the
    largest entity degree; built from a degree table, never from pairs."""
    deg = edges.groupBy("entity_type", "entity").agg(F.count(F.lit(1)).alias("degree"))
    j = edges.join(deg, ["entity_type", "entity"])
    return j.groupBy(F.col("txn").alias(id_col), "entity_type").agg(
        F.sum(F.col("degree") - 1).cast("long").alias("n_shared"), F.max("degree").cast("long").alias("max_degree")
    )
