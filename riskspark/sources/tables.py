"""Table access and role bindings.

The operators are written against roles (transactions, applications,
scored rows, campaign, drift pair, ...).  ``bind_*`` functions project the
driver's test tables onto those roles with plain ``select``s, so Catalyst
prunes columns and pushes filters down to the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def epoch_seconds(ts_col: str) -> F.Column:
    """Whole seconds since 1970-01-01 UTC (floor), from TIMESTAMP or
    TIMESTAMP_NTZ (the latter is cast with the session time zone, UTC)."""
    return F.floor(F.unix_micros(F.col(ts_col).cast("timestamp")) / F.lit(1_000_000)).cast("long")


# SQL twin of ``epoch_seconds`` for the DuckDB oracle.
def epoch_seconds_sql(ts: str) -> str:
    return f"CAST(floor(epoch_us({ts}) / 1000000) AS BIGINT)"


def bind_event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> transactions role: id, card, t (long seconds), amount,
    category, diversity, label."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("card"),
        epoch_seconds("ts").alias("t"),
        F.col("value").cast("double").alias("amount"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").cast("int").alias("diversity"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


EVENT_TRANSACTIONS_SQL = f"""
SELECT event_id AS id, user_id AS card, {epoch_seconds_sql('ts')} AS t,
       CAST(value AS DOUBLE) AS amount, event_type AS category,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS diversity,
       CAST(event_type = 'error' AS INTEGER) AS label
FROM events"""


def bind_order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> transactions role (has same-second ties per card)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("card"),
        epoch_seconds("o_orderdate").alias("t"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("category"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


ORDER_TRANSACTIONS_SQL = f"""
SELECT o_orderkey AS id, o_custkey AS card, {epoch_seconds_sql('o_orderdate')} AS t,
       o_totalprice AS amount, o_orderpriority AS category,
       CAST(o_orderstatus = 'F' AS INTEGER) AS label
FROM orders"""


def bind_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> scored rows (id, y, score in [0, 1])."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / F.lit(600000.0)).alias("score"),
    )


SCORED_ROWS_SQL = """
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
       o_totalprice / 600000.0 AS score
FROM orders"""


def bind_tied_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> scored rows with many tied scores (discount as score)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10).alias("score"),
    )


TIED_SCORED_ROWS_SQL = """
SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_returnflag = 'R' AS INTEGER) AS y,
       l_discount * 10 AS score
FROM lineitem"""


def bind_applications(spark: SparkSession, sf_dir: str, orders_before: str | None = None) -> DataFrame:
    """orders join customer -> credit applications role.  ``orders_before``
    ('YYYY-MM-DD') keeps applications dated before it, as a predicate on the
    raw column so that it reaches the Parquet scan."""
    o = table(spark, sf_dir, "orders")
    if orders_before is not None:
        o = o.where(F.col("o_orderdate") < F.lit(f"{orders_before} 00:00:00").cast(o.schema["o_orderdate"].dataType))
    return applications_from(o, table(spark, sf_dir, "customer"))


def applications_from(o: DataFrame, c: DataFrame) -> DataFrame:
    """The applications projection over given orders (batch or stream)."""
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        F.col("o_totalprice").alias("totalprice"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        epoch_seconds("o_orderdate").alias("t"),
    )


APPLICATIONS_SQL = f"""
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS target,
       o_totalprice AS totalprice,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal,
       o_orderpriority AS priority, c_mktsegment AS segment,
       {epoch_seconds_sql('o_orderdate')} AS t
FROM orders JOIN customer ON o_custkey = c_custkey"""


def bind_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> uplift campaign role (outcome, treatment, score)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("outcome"),
        F.pmod(F.col("o_orderkey"), F.lit(2)).cast("int").alias("treatment"),
        F.col("o_totalprice").alias("score"),
    )


CAMPAIGN_SQL = """
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS outcome,
       CAST(o_orderkey % 2 AS INTEGER) AS treatment, o_totalprice AS score
FROM orders"""


DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def bind_drift_pair(spark: SparkSession, sf_dir: str, split_year: int = 1999):
    """lineitem split by ship year: expected (earlier) and actual (later)."""
    li = table(spark, sf_dir, "lineitem")
    # A range on the raw column (not year(...)) so the filter reaches the scan.
    cut = F.lit(f"{split_year}-01-01 00:00:00").cast(li.schema["l_shipdate"].dataType)
    cols = DRIFT_FEATURES
    return li.where(F.col("l_shipdate") < cut).select(*cols), li.where(F.col("l_shipdate") >= cut).select(*cols)


def bind_class_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> one probability vector per user: event-type shares in a
    fixed type order."""
    ev = table(spark, sf_dir, "events")
    types = EVENT_TYPES
    counts = ev.groupBy("user_id").agg(
        *[F.sum((F.col("event_type") == t).cast("long")).alias(t) for t in types], F.count("*").alias("n")
    )
    return counts.select(
        F.col("user_id").alias("id"),
        F.array(*[(F.col(t) / F.col("n")).cast("double") for t in types]).alias("probs"),
    )


# Fixed order of the event types that form the probability vector.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

CLASS_PROB_SQL = """
SELECT user_id AS id,
       [sum(CAST(event_type = 'click' AS BIGINT)) / count(*),
        sum(CAST(event_type = 'error' AS BIGINT)) / count(*),
        sum(CAST(event_type = 'purchase' AS BIGINT)) / count(*),
        sum(CAST(event_type = 'signup' AS BIGINT)) / count(*),
        sum(CAST(event_type = 'view' AS BIGINT)) / count(*)] AS probs
FROM events GROUP BY user_id"""
