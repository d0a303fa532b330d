"""Queries that run the Structured Streaming jobs to completion
(``availableNow``) over file streams of the test tables and return what
the sinks hold (ST1-ST3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scorecard as sc
from ..sources.tables import applications_from, epoch_seconds, table
from ..streaming import jobs as sj
from . import credit_plans as cp
from .audit_plans import SCORES_SQL
from .features_plans import VELOCITY_SQL
from .registry import register


def _frozen(spark, sf_dir, root):
    """The scorecard that the batch job has published: loaded, not refitted."""
    sc.publish(spark, root, "credit_scorecard", cp.fit_card(cp._apps(spark, sf_dir)[1]), {})
    return sc.champion(spark, root, "credit_scorecard")[1]


def _app_stream(spark, sf_dir):
    orders = sj.file_stream(spark, sf_dir, "orders.parquet")
    return applications_from(orders, table(spark, sf_dir, "customer"))


@register(
    "stream_score_audit",
    f"WITH b AS ({cp.BATCH_SQL}) SELECT id, score, decision FROM b",
)
def stream_score_audit(spark, sf_dir):
    """ST1: file stream of orders -> applications -> frozen scorecard ->
    decision -> idempotent append to the decision log.  Orders arrive in three
    files; every third one is sent again in the next file."""
    root = sj.run_dir(spark, "score-audit")
    card = _frozen(spark, sf_dir, f"{root}/registry")
    orders = table(spark, sf_dir, "orders")
    file = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    again = F.when(F.col("o_orderkey") % 3 == 0, F.array(file, (file + 1) % 3)).otherwise(F.array(file))
    sent = orders.select("*", F.explode(F.array_sort(again)).alias("__file"))
    sj.feed(sent, f"{root}/in", F.col("__file"), 3)
    # A write makes as many files as the table has partitions.  They arrive together: batches of
    # single files would send the customers to the driver for a broadcast once per file.
    arriving = sj.file_stream(spark, f"{root}/in", "*.parquet", max_files=orders.rdd.getNumPartitions()).drop("__file")
    log = sj.stream_score_audit(
        spark, applications_from(arriving, table(spark, sf_dir, "customer")), card, "id", "t", ["totalprice", "acctbal", "priority", "segment"],
        f"{root}/log", f"{root}/chk",
    )
    return log.select("id", F.round("score", 6).alias("score"), "decision")


WINDOW = "1 day"
DELAY = "1 hour"
FILES = 4


def _event_stream(spark, sf_dir, root):
    """events in several files: by time, but each event up to half the delay too
    early or too late, and then the row that closes the stream."""
    ev = table(spark, sf_dir, "events")
    t = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    low, high = ev.agg(F.min(t), F.max(t)).first()
    shifted = t + F.pmod(F.xxhash64("event_id"), F.lit(3600)) - F.lit(1800)
    part = F.floor((shifted - F.lit(low)) / F.lit((high - low) / FILES + 1))
    folder = f"{root}/in"
    sj.feed(ev, folder, F.least(F.greatest(part, F.lit(0)), F.lit(FILES - 1)), FILES)
    sj.close(spark, folder, "ts", DELAY, user_id=0)
    return sj.file_stream(spark, folder, "*.parquet", max_files=ev.rdd.getNumPartitions())


@register(
    "stream_velocity_tumbling",
    """WITH w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS ws, user_id, count(value) AS n, sum(value) AS s FROM events GROUP BY ALL)
       SELECT CAST(epoch(ws) AS BIGINT) AS window_start, user_id, CAST(n AS BIGINT) AS n_events, round(s, 6) AS amount_sum FROM w""",
)
def stream_velocity_tumbling(spark, sf_dir):
    """ST2: daily windows per user with a one-hour watermark, over events in
    several files; the closing row brings out the last windows."""
    root = sj.run_dir(spark, "velocity")
    out = f"{root}/out"
    sj.stream_velocity_tumbling(_event_stream(spark, sf_dir, root), "ts", "user_id", "value", WINDOW, DELAY, out, f"{root}/chk")
    r = spark.read.parquet(out)
    return r.select(F.unix_timestamp("window_start").alias("window_start"), "user_id", "n_events", F.round("amount_sum", 6).alias("amount_sum"))


@register(
    "stream_psi",
    f"""WITH {SCORES_SQL},
        ball AS (SELECT 'bin_' || CAST(len(list_filter(es, lambda v: v < score)) AS VARCHAR) AS bin FROM sc, ee),
        cb AS (SELECT bin, count(*) AS n_actual FROM ball GROUP BY bin),
        t1 AS (SELECT coalesce(ce.bin, cb.bin) AS bin, coalesce(n_expected, 0) AS ne, coalesce(n_actual, 0) AS na
               FROM ce FULL OUTER JOIN cb ON ce.bin = cb.bin),
        p1 AS (SELECT (ne + 1e-4) / (sum(ne) OVER () + 1e-4 * count(*) OVER ()) AS pe,
                      (na + 1e-4) / (sum(na) OVER () + 1e-4 * count(*) OVER ()) AS pa FROM t1),
        v AS (SELECT sum((pa - pe) * ln(pa / pe)) AS psi FROM p1)
        SELECT CAST(0 AS BIGINT) AS batch_id, CAST((SELECT count(*) FROM sc) AS BIGINT) AS n_rows, round(psi, 9) AS psi,
               CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END AS verdict,
               CASE WHEN psi >= 0.25 THEN 1 ELSE 0 END AS status FROM v""",
)
def stream_psi(spark, sf_dir):
    """ST3: every micro-batch of incoming applications is scored with the
    frozen scorecard and its PSI against the train scores is appended to
    the runs table."""
    root = sj.run_dir(spark, "psi")
    card = _frozen(spark, sf_dir, f"{root}/registry")
    scored = card.score(_app_stream(spark, sf_dir)).select("score")
    runs = sj.stream_psi(spark, scored, card.reference, "score", f"{root}/runs", f"{root}/chk")
    return runs.select("batch_id", "n_rows", F.round("psi", 9).alias("psi"), "verdict", "status")


@register("stream_velocity_exact", VELOCITY_SQL)
def stream_velocity_exact(spark, sf_dir):
    """ST2 (exact): events in several files, in mixed order within the delay,
    through a per-card stateful processor; each row's 1h / 1d count and sum over
    (t - d, t], for all rows."""
    root = sj.run_dir(spark, "velocity-exact")
    ev = _event_stream(spark, sf_dir, root).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("card"), epoch_seconds("ts").alias("t"), F.col("value").alias("amount")
    )
    out = f"{root}/out"
    sj.stream_velocity_exact(ev, "card", "t", "id", "amount", {"1h": 3600, "1d": 86400}, out, f"{root}/chk", DELAY)
    r = spark.read.parquet(out)
    return r.select(
        "id", "card", "t", "card_txn_count_1h", F.round("card_amt_sum_1h", 6).alias("card_amt_sum_1h"),
        "card_txn_count_1d", F.round("card_amt_sum_1d", 6).alias("card_amt_sum_1d"),
    )
