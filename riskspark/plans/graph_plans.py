"""Queries for the entity graph (GR1-GR5) and fitted transforms (ML1,
ML2), plus schema catalogues (PF1, TL6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as gr
from ..operators import learners as le
from ..sources.tables import (
    APPLICATIONS_SQL,
    EVENT_TRANSACTIONS_SQL,
    bind_applications,
    bind_event_transactions,
    table,
)
from .registry import register

GRAPH_TRAIN_CUT = "1999-01-01"
ENTITIES = ["part", "supplier", "nation"]
NODE_FEATURES = ["totalprice", "acctbal"]


def r9(c):
    return F.round(F.col(c).cast("double"), 9).alias(c)


def _graph_inputs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    li = table(spark, sf_dir, "lineitem")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    nodes = oc.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("totalprice"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.col("o_orderdate") < F.lit(GRAPH_TRAIN_CUT).cast("timestamp")).alias("__train"),
    )
    ent_rows = li.select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")
    ).unionByName(oc.select(F.col("o_orderkey").alias("id"), F.col("c_nationkey").alias("nation")), allowMissingColumns=True)
    edges = gr.edge_table(ent_rows, "id", ENTITIES)
    return nodes, edges


def _nodes(spark, sf_dir):
    nodes, edges = _graph_inputs(spark, sf_dir)
    tr = nodes.where("__train").drop("__train")
    te = nodes.where(~F.col("__train")).drop("__train")
    return gr.node_table(tr, te, "id", NODE_FEATURES, "label"), edges


NODES_SQL = f"""
WITH oc AS (SELECT o_orderkey AS id, o_totalprice AS totalprice, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal,
                   CAST(o_orderstatus = 'F' AS INTEGER) AS label,
                   CASE WHEN o_orderdate < TIMESTAMP '{GRAPH_TRAIN_CUT}' THEN 'train' ELSE 'test' END AS mask
            FROM orders JOIN customer ON o_custkey = c_custkey),
med AS (SELECT quantile_cont(totalprice, 0.5) AS mt, quantile_cont(acctbal, 0.5) AS ma FROM oc WHERE mask = 'train'),
imp AS (SELECT id, label, mask, coalesce(totalprice, mt) AS totalprice, coalesce(acctbal, ma) AS acctbal FROM oc, med),
sc AS (SELECT avg(totalprice) AS avg_t, coalesce(nullif(stddev_pop(totalprice), 0), 1) AS sd_t,
              avg(acctbal) AS avg_a, coalesce(nullif(stddev_pop(acctbal), 0), 1) AS sd_a FROM imp WHERE mask = 'train'),
nodes AS (SELECT id, mask, label, (totalprice - avg_t) / sd_t AS totalprice, (acctbal - avg_a) / sd_a AS acctbal FROM imp, sc),
ents AS (SELECT l_orderkey AS txn, 'part' AS entity_type, CAST(l_partkey AS VARCHAR) AS entity FROM lineitem
         UNION ALL SELECT l_orderkey, 'supplier', CAST(l_suppkey AS VARCHAR) FROM lineitem
         UNION ALL SELECT o_orderkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey),
edges AS (SELECT DISTINCT txn, entity_type, entity FROM ents WHERE entity IS NOT NULL)"""


@register("graph_nodes", f"{NODES_SQL} SELECT id, mask, round(totalprice, 9) AS totalprice, round(acctbal, 9) AS acctbal, label FROM nodes")
def graph_nodes(spark, sf_dir):
    n, _ = _nodes(spark, sf_dir)
    return n.select("id", "mask", r9("totalprice"), r9("acctbal"), "label")


@register("graph_entities", f"{NODES_SQL} SELECT DISTINCT entity_type, entity, CAST(1.0 AS DOUBLE) AS feature FROM edges")
def graph_entities(spark, sf_dir):
    _, e = _graph_inputs(spark, sf_dir)
    return gr.entity_nodes(e)


@register(
    "graph_edges",
    f"""{NODES_SQL}
        SELECT 'txn' AS src_type, CAST(txn AS VARCHAR) AS src, entity_type AS dst_type, entity AS dst FROM edges
        UNION ALL SELECT entity_type, entity, 'txn', CAST(txn AS VARCHAR) FROM edges""",
)
def graph_edges(spark, sf_dir):
    _, e = _graph_inputs(spark, sf_dir)
    fwd = e.select(F.lit("txn").alias("src_type"), F.col("txn").cast("string").alias("src"), F.col("entity_type").alias("dst_type"), F.col("entity").alias("dst"))
    return fwd.unionByName(gr.reverse_edges(e))


@register(
    "graph_khop_mean",
    f"""{NODES_SQL},
        ent AS (SELECT entity_type, entity, avg(n.totalprice) AS totalprice, avg(n.acctbal) AS acctbal
                FROM edges JOIN nodes n ON edges.txn = n.id GROUP BY entity_type, entity),
        pt AS (SELECT txn, entity_type, avg(ent.totalprice) AS totalprice, avg(ent.acctbal) AS acctbal
               FROM edges JOIN ent USING (entity_type, entity) GROUP BY txn, entity_type),
        s AS (SELECT txn, sum(totalprice) AS totalprice, sum(acctbal) AS acctbal FROM pt GROUP BY txn)
        SELECT nodes.id, round(coalesce(s.totalprice, 0.0), 9) AS totalprice, round(coalesce(s.acctbal, 0.0), 9) AS acctbal
        FROM nodes LEFT JOIN s ON nodes.id = s.txn""",
)
def graph_khop_mean(spark, sf_dir):
    n, e = _nodes(spark, sf_dir)
    return gr.khop_mean(n, e, "id", NODE_FEATURES).select("id", r9("totalprice"), r9("acctbal"))


def _hop_sql(k, source):
    """CTEs of one more hop: ``h{k}`` from the rows (id, totalprice, acctbal) of ``source``."""
    return f"""ent{k} AS (SELECT entity_type, entity, avg(n.totalprice) AS totalprice, avg(n.acctbal) AS acctbal
                FROM edges JOIN {source} n ON edges.txn = n.id GROUP BY entity_type, entity),
        pt{k} AS (SELECT txn, entity_type, avg(e.totalprice) AS totalprice, avg(e.acctbal) AS acctbal
                FROM edges JOIN ent{k} e USING (entity_type, entity) GROUP BY txn, entity_type),
        s{k} AS (SELECT txn, sum(totalprice) AS totalprice, sum(acctbal) AS acctbal FROM pt{k} GROUP BY txn),
        h{k} AS (SELECT nodes.id, coalesce(s.totalprice, 0.0) AS totalprice, coalesce(s.acctbal, 0.0) AS acctbal FROM nodes LEFT JOIN s{k} s ON nodes.id = s.txn)"""


@register(
    "graph_two_hops",
    f"""{NODES_SQL}, {_hop_sql(1, "nodes")}, {_hop_sql(2, "h1")}
        SELECT h2.id, round(h1.totalprice, 6) AS nb1_totalprice, round(h1.acctbal, 6) AS nb1_acctbal,
               round(h2.totalprice, 6) AS nb2_totalprice, round(h2.acctbal, 6) AS nb2_acctbal FROM h2 JOIN h1 USING (id)""",
)
def graph_two_hops(spark, sf_dir):
    """GR4 over two hops: neighbours' means and the means of their neighbours."""
    n, e = _nodes(spark, sf_dir)
    found = gr.khop_features(n, e, "id", NODE_FEATURES, hops=2)
    return found.select("id", *[F.round(f"nb{k}_{f}", 6).alias(f"nb{k}_{f}") for k in (1, 2) for f in NODE_FEATURES])


@register(
    "graph_shared_entity",
    f"""{NODES_SQL},
        deg AS (SELECT entity_type, entity, count(*) AS degree FROM edges GROUP BY ALL)
        SELECT txn AS id, entity_type, CAST(sum(degree - 1) AS BIGINT) AS n_shared, CAST(max(degree) AS BIGINT) AS max_degree
        FROM edges JOIN deg USING (entity_type, entity) GROUP BY txn, entity_type""",
)
def graph_shared_entity(spark, sf_dir):
    _, e = _graph_inputs(spark, sf_dir)
    return gr.shared_entity_reach(e, "id")


CREDIT_TRAIN_T = 915148800


@register(
    "impute_median",
    f"""WITH a AS ({APPLICATIONS_SQL}),
        m AS (SELECT quantile_cont(acctbal, 0.5) AS ma FROM a WHERE t < {CREDIT_TRAIN_T})
        SELECT id, round(coalesce(acctbal, ma), 9) AS acctbal FROM a, m""",
)
def impute_median(spark, sf_dir):
    a = bind_applications(spark, sf_dir)
    out = le.impute_median(a, ["acctbal"], fit_df=a.where(F.col("t") < CREDIT_TRAIN_T))
    return out.select("id", r9("acctbal"))


@register(
    "standardize",
    f"""WITH a AS ({APPLICATIONS_SQL}),
        s AS (SELECT avg(totalprice) AS m, coalesce(nullif(stddev_pop(totalprice), 0), 1) AS sd FROM a WHERE t < {CREDIT_TRAIN_T})
        SELECT id, round((totalprice - m) / sd, 9) AS totalprice FROM a, s""",
)
def standardize(spark, sf_dir):
    a = bind_applications(spark, sf_dir)
    sc = le.fit_standardizer(a.where(F.col("t") < CREDIT_TRAIN_T), ["totalprice"])
    return le.standardize(a, sc, ["totalprice"]).select("id", r9("totalprice"))


def feature_catalog_df(df, exclude=("id", "target", "label")):
    """PF1: numeric and boolean columns minus id and target, in schema
    order, as (position, column)."""
    rows = [(i, c) for i, c in enumerate(df.columns) if c in feature_columns(df, exclude)]
    return df.sparkSession.createDataFrame(rows, "position int, column string")


def feature_columns(df, exclude=("id", "target", "label")) -> list[str]:
    from pyspark.sql import types as T

    from ..operators.profile import NUMERIC

    return [f.name for f in df.schema.fields if isinstance(f.dataType, (*NUMERIC, T.BooleanType)) and f.name not in exclude]


@register("feature_catalog", f"SELECT id, round(totalprice, 6) AS totalprice, round(acctbal, 6) AS acctbal, t FROM ({APPLICATIONS_SQL})")
def feature_catalog(spark, sf_dir):
    """PF1: every application with the columns the catalogue selects."""
    a = bind_applications(spark, sf_dir)
    floats = {"double", "float"}
    return a.select("id", *[F.round(c, 6).alias(c) if dict(a.dtypes)[c] in floats else F.col(c) for c in feature_columns(a)])


def _missing_sql(side, source, columns):
    return [f"""SELECT '{c}' AS "column", '{side}' AS side, CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM ({source})""" for c in columns]


@register(
    "schema_diff",
    " UNION ALL ".join(
        [*_missing_sql("source_only", APPLICATIONS_SQL, ["totalprice", "acctbal"]), *_missing_sql("target_only", EVENT_TRANSACTIONS_SQL, ["card", "amount", "diversity"])]
    ),
)
def schema_diff(spark, sf_dir):
    """TL6: features that only one of two domains has (credit applications,
    event transactions), with their missing values."""
    from ..operators.profile import missing_rates

    source, target = bind_applications(spark, sf_dir), bind_event_transactions(spark, sf_dir)
    s, t = feature_columns(source), feature_columns(target)
    out = []
    for side, df, only in (("source_only", source, [c for c in s if c not in t]), ("target_only", target, [c for c in t if c not in s])):
        out.append(missing_rates(df.select(*only)).select("column", F.lit(side).alias("side"), "n_missing"))
    return out[0].unionByName(out[1])
