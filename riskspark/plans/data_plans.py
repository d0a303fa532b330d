"""Queries for checked loads, joins and profiling (IO1-IO3, IO6, J1-J4, J7,
A1-A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import col_
from ..operators import merge as mg
from ..operators import profile as pr
from ..sources import contracts as ct
from ..sources import sinks
from ..sources.tables import (
    APPLICATIONS_SQL,
    EVENT_TRANSACTIONS_SQL,
    bind_applications,
    bind_event_transactions,
    table,
)
from ..streaming.jobs import run_dir
from .registry import register


def roundn(c, d):
    return F.round(col_(c).cast("double"), d).alias(c if isinstance(c, str) else None)


# (table, required columns, key) -- the contracts checked by key_contract_report.
CONTRACTS = [
    ("events", ["event_id", "ts", "user_id", "value"], ["event_id"]),
    ("orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_clerk"], ["o_orderkey"]),
    ("lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], ["l_orderkey", "l_linenumber"]),
    ("documents", ["doc_id", "text"], ["doc_id"]),
    ("labels", ["doc_id", "quality", "toxic"], ["doc_id"]),
]


def _contract_sql():
    parts = []
    present = {
        "events": {"event_id", "ts", "user_id", "event_type", "value", "props"},
        "orders": {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"},
        "lineitem": {"l_orderkey", "l_linenumber", "l_quantity"},
        "documents": {"doc_id", "text"},
        "labels": {"doc_id", "quality", "toxic"},
    }
    for name, req, key in CONTRACTS:
        missing = sorted(set(req) - present[name])
        k = ", ".join(key)
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, "
            f"CAST({len(missing)} AS BIGINT) AS n_missing_columns, '{','.join(missing)}' AS missing_columns, "
            f"CAST(sum(n - 1) AS BIGINT) AS n_duplicate_rows, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_duplicate_keys "
            f"FROM (SELECT {k}, count(*) AS n FROM {name} GROUP BY {k})"
        )
    return "\nUNION ALL\n".join(parts)


@register("key_contract_report", _contract_sql())
def key_contract_report(spark, sf_dir):
    out = None
    for name, req, key in CONTRACTS:
        r = ct.contract_report(table(spark, sf_dir, name), name, req, key)
        out = r if out is None else out.unionByName(r)
    return out


APP_COLUMNS = ["id", "target", "totalprice", "acctbal", "priority", "segment"]


@register("application_projection", f"SELECT {', '.join(APP_COLUMNS)} FROM ({APPLICATIONS_SQL})")
def application_projection(spark, sf_dir):
    return ct.ordered_projection(bind_applications(spark, sf_dir), APP_COLUMNS)


def _merged(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return mg.merge_left_flag(docs, labels, "doc_id", flag="has_label_match")


MERGED_SQL = """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic, l.doc_id IS NOT NULL AS has_label_match
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@register("merge_left_flag", MERGED_SQL)
def merge_left_flag(spark, sf_dir):
    return _merged(spark, sf_dir)


@register("merged_table_written", MERGED_SQL)
def merged_table_written(spark, sf_dir):
    """IO4, J2: both sides are loaded under their contract (columns there, key
    unique), merged, written as a table partitioned by language, and read back."""
    docs = ct.load_checked(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text", "lang"], ["doc_id"])
    labels = ct.load_checked(spark, f"{sf_dir}/labels.parquet", ["doc_id", "quality"], ["doc_id"])
    path = f"{run_dir(spark, 'merged')}/table"
    sinks.write_table(mg.merge_left_flag(docs, labels, "doc_id", flag="has_label_match"), path, partition_by=["lang"])
    return spark.read.parquet(path).select("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic", "has_label_match")


@register(
    "merge_match_rate",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows,
              CAST(count(l.doc_id) AS BIGINT) AS n_matched,
              round(count(l.doc_id) / count(*), 9) AS match_rate
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def merge_match_rate(spark, sf_dir):
    r = mg.match_rate(_merged(spark, sf_dir), "has_label_match")
    return r.select("n_rows", "n_matched", F.round("match_rate", 9).alias("match_rate"))


@register(
    "unmatched_keys",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def unmatched_keys(spark, sf_dir):
    return mg.unmatched_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@register(
    "split_overlap_guard",
    """SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01') AS n_train,
              (SELECT CAST(count(*) AS BIGINT) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01') AS n_test,
              (SELECT CAST(count(*) AS BIGINT) FROM (
                  SELECT DISTINCT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
                  INTERSECT
                  SELECT DISTINCT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')) AS n_shared""",
)
def split_overlap_guard(spark, sf_dir):
    """Orders placed before 1999 (train) vs. line items shipped from 1999 on
    (test): ids shared across the two sides."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp"))
    return mg.split_overlap(o.select(F.col("o_orderkey").alias("k")), li.select(F.col("l_orderkey").alias("k")), "k")


@register(
    "label_rate",
    f"""SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(sum(label) AS BIGINT) AS n_positive,
               CAST(count(*) - sum(label) AS BIGINT) AS n_negative, round(sum(label) / count(*), 9) AS rate
        FROM ({EVENT_TRANSACTIONS_SQL})""",
)
def label_rate(spark, sf_dir):
    r = pr.label_rate(bind_event_transactions(spark, sf_dir))
    return r.select("n_total", "n_positive", "n_negative", F.round("rate", 9).alias("rate"))


def _merged_wide(spark, sf_dir):
    return _merged(spark, sf_dir).drop("has_label_match")


@register(
    "missing_rates",
    """WITH m AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
                 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       SELECT "column", CAST(n_missing AS BIGINT) AS n_missing, round(n_missing / n, 9) AS missing_rate FROM (
         SELECT 'doc_id' AS "column", count(*) - count(doc_id) AS n_missing, count(*) AS n FROM m
         UNION ALL SELECT 'lang', count(*) - count(lang), count(*) FROM m
         UNION ALL SELECT 'source', count(*) - count(source), count(*) FROM m
         UNION ALL SELECT 'text', count(*) - count(text), count(*) FROM m
         UNION ALL SELECT 'n_chars', count(*) - count(n_chars), count(*) FROM m
         UNION ALL SELECT 'quality', count(*) - count(quality), count(*) FROM m
         UNION ALL SELECT 'toxic', count(*) - count(toxic), count(*) FROM m)""",
)
def missing_rates(spark, sf_dir):
    r = pr.missing_rates(_merged_wide(spark, sf_dir))
    return r.select("column", "n_missing", F.round("missing_rate", 9).alias("missing_rate"))


DESCRIBE_SQL = f"""
WITH a AS ({APPLICATIONS_SQL}),
long AS (SELECT target, 'totalprice' AS feature, CAST(totalprice AS DOUBLE) AS value FROM a
         UNION ALL SELECT target, 'acctbal', CAST(acctbal AS DOUBLE) FROM a)
SELECT feature, target, CAST(count(value) AS BIGINT) AS "count",
       round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
       round(min(value), 4) AS "min", round(quantile_cont(value, 0.25), 4) AS p25,
       round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75,
       round(max(value), 4) AS "max"
FROM long GROUP BY feature, target
"""


@register("describe_by_label", DESCRIBE_SQL)
def describe_by_label(spark, sf_dir):
    a = bind_applications(spark, sf_dir).select("id", "target", "totalprice", "acctbal")
    d = pr.describe_by_label(a, "target", ["totalprice", "acctbal"])
    return d.select("feature", "target", "count", *[roundn(c, 4) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@register(
    "rate_by_elapsed_day",
    f"""WITH tx AS ({EVENT_TRANSACTIONS_SQL})
        SELECT CAST((t - (SELECT min(t) FROM tx)) // 86400 AS BIGINT) AS day,
               CAST(count(*) AS BIGINT) AS n_transactions, CAST(sum(label) AS BIGINT) AS n_positive,
               round(avg(label), 9) AS rate
        FROM tx GROUP BY 1""",
)
def rate_by_elapsed_day(spark, sf_dir):
    r = pr.rate_by_elapsed_day(bind_event_transactions(spark, sf_dir))
    return r.select("day", "n_transactions", "n_positive", F.round("rate", 9).alias("rate"))


@register(
    "rate_by_hour",
    f"""WITH tx AS ({EVENT_TRANSACTIONS_SQL})
        SELECT CAST((t % 86400) // 3600 AS BIGINT) AS hour,
               CAST(count(*) AS BIGINT) AS n_transactions, CAST(sum(label) AS BIGINT) AS n_positive,
               round(avg(label), 9) AS rate
        FROM tx GROUP BY 1""",
)
def rate_by_hour(spark, sf_dir):
    r = pr.rate_by_hour(bind_event_transactions(spark, sf_dir))
    return r.select("hour", "n_transactions", "n_positive", F.round("rate", 9).alias("rate"))


EDA_SQL = f"""
WITH tx AS (SELECT id, t, amount, diversity, label FROM ({EVENT_TRANSACTIONS_SQL})),
lr AS (SELECT count(*) AS n, sum(label) AS p FROM tx),
long AS (SELECT label, 't' AS f, CAST(t AS DOUBLE) AS v FROM tx
         UNION ALL SELECT label, 'amount', amount FROM tx
         UNION ALL SELECT label, 'diversity', CAST(diversity AS DOUBLE) FROM tx),
d AS (SELECT f || '|' || CAST(label AS VARCHAR) AS k, count(v) AS c, avg(v) AS mean, stddev_samp(v) AS std,
             min(v) AS mn, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50,
             quantile_cont(v, 0.75) AS p75, max(v) AS mx
      FROM long GROUP BY f, label),
days AS (SELECT CAST((t - (SELECT min(t) FROM tx)) // 86400 AS VARCHAR) AS k, count(*) AS n, avg(label) AS r FROM tx GROUP BY 1),
hours AS (SELECT CAST((t % 86400) // 3600 AS VARCHAR) AS k, count(*) AS n, avg(label) AS r FROM tx GROUP BY 1),
allrows AS (
  SELECT 'label_rate' AS section, 'all' AS key, m AS metric, v AS value FROM lr,
    (VALUES ('n_total'), ('n_positive'), ('n_negative'), ('rate')) s(m),
    LATERAL (SELECT CASE m WHEN 'n_total' THEN n WHEN 'n_positive' THEN p WHEN 'n_negative' THEN n - p ELSE p / n END AS v)
  UNION ALL SELECT 'missing', c, 'n_missing', 0 FROM (VALUES ('id'), ('t'), ('amount'), ('diversity'), ('label')) x(c)
  UNION ALL SELECT 'missing', c, 'missing_rate', 0 FROM (VALUES ('id'), ('t'), ('amount'), ('diversity'), ('label')) x(c)
  UNION ALL SELECT 'describe', k, 'count', c FROM d
  UNION ALL SELECT 'describe', k, 'mean', mean FROM d
  UNION ALL SELECT 'describe', k, 'std', std FROM d
  UNION ALL SELECT 'describe', k, 'min', mn FROM d
  UNION ALL SELECT 'describe', k, 'p25', p25 FROM d
  UNION ALL SELECT 'describe', k, 'p50', p50 FROM d
  UNION ALL SELECT 'describe', k, 'p75', p75 FROM d
  UNION ALL SELECT 'describe', k, 'max', mx FROM d
  UNION ALL SELECT 'by_elapsed_day', k, 'n_transactions', n FROM days
  UNION ALL SELECT 'by_elapsed_day', k, 'rate', r FROM days
  UNION ALL SELECT 'by_hour_of_day', k, 'n_transactions', n FROM hours
  UNION ALL SELECT 'by_hour_of_day', k, 'rate', r FROM hours)
SELECT section, key, metric, round(CAST(value AS DOUBLE), 4) AS value FROM allrows
"""


@register("eda_report_long", EDA_SQL)
def eda_report_long(spark, sf_dir):
    tx = bind_event_transactions(spark, sf_dir).select("id", "t", "amount", "diversity", "label")
    r = pr.eda_report_long(tx, "label", "t", "id")
    return r.select("section", "key", "metric", F.round("value", 4).alias("value"))


@register("report_written", EDA_SQL)
def report_written(spark, sf_dir):
    """IO6: the profiling report as JSON lines, read back."""
    path = f"{run_dir(spark, 'report')}/eda"
    sinks.write_report(eda_report_long(spark, sf_dir), path)
    return spark.read.schema("section string, key string, metric string, value double").json(path)
