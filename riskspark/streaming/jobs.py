"""ST1-ST3: Structured Streaming versions of scoring, velocity and drift.

All jobs read a file source (``readStream`` with a glob filter), run with
``trigger(availableNow=True)`` and checkpoint into the shared checkpoint
folder, so a restarted job resumes where it stopped.  Sinks go through
``foreachBatch`` with idempotent appends keyed by the batch id.

What the watermark holds back comes out when a later event arrives; ``close``
writes one such event behind the last file of a folder that gets no more.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators import audit as au
from ..operators.registry import PsiReference, monitor_status
from ..operators.scorecard import Scorecard
from ..session import checkpoint_dir


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def file_stream(spark: SparkSession, folder: str, file_glob: str, max_files: int = 1) -> DataFrame:
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", file_glob).option("maxFilesPerTrigger", max_files).parquet(folder)
    )


def feed(df: DataFrame, folder: str, part: Column, parts: int) -> None:
    """Appends the rows of ``part`` 0, 1, ... to a folder, one write after the
    other, so that a file stream sees them in this order."""
    for k in range(parts):
        df.where(part == k).write.mode("append").parquet(folder)


def close(spark: SparkSession, folder: str, time_col: str, delay: str, **values) -> None:
    """Appends one row with NULL in all columns but the given ones and the time,
    which lies ``delay`` and a day behind all others."""
    there = spark.read.parquet(folder)
    at = there.agg(F.max(F.col(time_col).cast("timestamp") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 DAY")).alias("at"))
    value = {f.name: F.lit(values.get(f.name)).cast(f.dataType) for f in there.schema.fields}
    value[time_col] = F.col("at").cast(there.schema[time_col].dataType)
    at.where("at IS NOT NULL").select(*[value[c].alias(c) for c in there.columns]).write.mode("append").parquet(folder)


def stream_score_audit(
    spark: SparkSession,
    requests: DataFrame,
    card: Scorecard,
    id_col: str,
    time_col: str,
    input_cols,
    log_path: str,
    checkpoint: str,
    resent: str = "1 day",
):
    """ST1: score each micro-batch with the frozen scorecard, decide, and
    append to the decision log (idempotent per batch id).  A request id that
    arrives again within ``resent`` of its first arrival, in the same or a later
    batch, gets no second decision; the ids are kept for that long.  Arrival time
    is the batch's, so no request is late."""
    requests = requests.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", resent).dropDuplicatesWithinWatermark([id_col]).drop("__arrived")
    # The card's tables were written once: no refit and no mutable state per batch.
    decided = card.decide(requests)
    rows = au.decision_rows(decided, "credit", "scorecard-frozen", id_col, F.col(time_col), "score", "decision", input_cols)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        au.append_decisions(batch_df, log_path, batch_id=batch_id)

    q = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(log_path)


def stream_velocity_tumbling(
    events: DataFrame, ts_col: str, key_col: str, value_col: str, window: str, delay: str, out_table: str, checkpoint: str
) -> None:
    """ST2: tumbling-window count/sum per key with a watermark; append mode
    emits a window once the watermark passes its end, late rows dropped."""
    ts = F.col(ts_col).cast("timestamp")
    agg = (
        events.withColumn("__ts", ts)
        .withWatermark("__ts", delay)
        .groupBy(F.window("__ts", window).alias("w"), F.col(key_col))
        .agg(F.count(F.col(value_col)).alias("n_events"), F.sum(F.col(value_col)).alias("amount_sum"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key_col, "n_events", "amount_sum")
    )
    q = agg.writeStream.outputMode("append").format("parquet").option("path", out_table).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
    q.awaitTermination()


def stream_psi(
    spark: SparkSession, batches: DataFrame, reference: DataFrame | PsiReference, value: str, runs_path: str, checkpoint: str, decimals: int | None = None
):
    """ST3: PSI of every micro-batch against a reference fitted once, one
    folder of the runs table per batch, which a retry replaces."""
    fitted = reference if isinstance(reference, PsiReference) else PsiReference(reference, value, decimals=decimals)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        b = batch_df.withColumn("__b", F.lit(int(batch_id)).cast("long"))
        p = monitor_status(fitted.batches(b, "__b"))
        n = b.agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
        p.crossJoin(n).select("n_rows", "psi", "verdict", "status").write.mode("overwrite").parquet(f"{runs_path}/batch_id={int(batch_id)}")

    q = batches.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("n_rows long, psi double, verdict string, status int, batch_id long").parquet(runs_path)


def window_totals(t: np.ndarray, amount: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the non-missing amounts in (t - d, t] up to each row; rows
    in order of time.  Time is cut into blocks of ``d``: a window is the running
    sum in the row's block and what the block before holds after t - d, so sums
    are put together by addition only."""
    has = ~np.isnan(amount)
    values = np.where(has, amount, 0.0)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(t // d) != 0])) if len(t) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(t))
    upto, since = np.zeros(len(t)), np.zeros(len(t) + 1)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        upto[a:b] = np.cumsum(values[a:b])
        since[a:b] = np.cumsum(values[a:b][::-1])[::-1]
    first = np.repeat(starts, ends - starts)  # of the row's block
    begin = np.searchsorted(t, t - d, side="right")
    counted = np.concatenate([[0], np.cumsum(has)])
    count = counted[1:] - counted[begin]
    total = upto + np.where(begin < first, since[np.minimum(begin, len(t))], 0.0)
    return count, np.where(count > 0, total, np.nan)


#: Cards are held in this many groups: a group costs the same few calls and timers
#: a batch, however many cards and rows it has.  Part of the checkpoint's layout.
CARD_GROUPS = 2048


def cards_totals(card: np.ndarray, t: np.ndarray, amount: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """``window_totals`` of several cards at once; rows in order of (card, t).  The
    cards' times are laid behind one another, whole windows apart."""
    if not len(t):
        return window_totals(t, amount, d)
    number = np.concatenate([[0], np.cumsum(np.diff(card) != 0)])
    apart = (int(t.max() - t.min()) // d + 2) * d
    return window_totals(t + number * apart, amount, d)


class _Velocity(StatefulProcessor):
    """Per group of cards two lists: rows that wait for the watermark, which
    arriving rows are appended to, and the rows of the last ``longest`` seconds that
    are out.  A timer at the end of the first waiting row's minute fires once the
    watermark is there: no earlier row can come any more, and all rows up to the
    watermark get their counts and sums in (t, id) order of their card.  A last timer
    clears a group whose rows have left every window."""

    ROW = "card long, t long, id long, amount double"

    def __init__(self, windows: dict[str, int]):
        self.windows, self.longest = windows, max(windows.values())

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting, self.past = handle.getListState("waiting", self.ROW), handle.getListState("past", self.ROW)

    def handleInputRows(self, key, rows, timerValues):
        for pdf in rows:
            pdf = pdf[pdf["id"].notna()]  # the closing row only moves the watermark
            if len(pdf):
                columns = (pdf[c].astype(kind).tolist() for c, kind in (("card", np.int64), ("t", np.int64), ("id", np.int64), ("amount", np.float64)))
                self.waiting.appendList(list(zip(*columns, strict=True)))
                self._wake(int(pdf["t"].min()))
        return iter(())

    def _wake(self, t: int) -> None:
        self.handle.registerTimer((t // 60 + 1) * 60_000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        waiting = self._rows(self.waiting)
        final, waiting = [r for r in waiting if r[1] <= passed], [r for r in waiting if r[1] > passed]
        past = self._rows(self.past)
        if final:
            every = past + final
            card, t, ids, amount = (np.array(x, k) for x, k in zip(zip(*every, strict=True), (np.int64, np.int64, np.int64, np.float64), strict=True))
            here = np.arange(len(every)) >= len(past)
            order = np.lexsort((amount, ids, here, t, card))
            card, t, ids, amount, here = (x[order] for x in (card, t, ids, amount, here))
            out = {"id": ids[here], "card": card[here], "t": t[here]}
            for label, d in self.windows.items():
                count, total = cards_totals(card, t, amount, d)
                out[f"card_txn_count_{label}"], out[f"card_amt_sum_{label}"] = count[here], total[here]
            yield pd.DataFrame(out)
            self._put(self.waiting, waiting)
            past = every
        if waiting:
            self._wake(min(r[1] for r in waiting))
        kept = [r for r in past if r[1] > passed - self.longest]
        if len(kept) != len(past) or final:
            self._put(self.past, kept)
            if kept:
                self.handle.registerTimer((max(r[1] for r in kept) + self.longest + 1) * 1000)

    @staticmethod
    def _rows(state) -> list[tuple]:
        return [tuple(r) for r in state.get()] if state.exists() else []

    @staticmethod
    def _put(state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()


_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_velocity_exact(
    events: DataFrame, card: str, t: str, id_col: str, amount: str, windows: dict, out_table: str, checkpoint: str, delay: str = "1 hour"
) -> None:
    """ST2 (exact): per-row velocity of live traffic, equal to the batch
    operator whatever the arrival order within ``delay``.  A row is emitted when
    the watermark (latest event time less ``delay``) has passed its minute; newer
    rows wait for later events (``close`` brings out the last ones), and rows
    that come after the watermark has passed them are dropped as late (counted in
    the query's progress).  NULL cards have no history and are left out, as they
    have no features.  State lies in RocksDB."""
    fields = ", ".join(f"card_txn_count_{lb} long, card_amt_sum_{lb} double" for lb in windows)
    src = events.select(
        F.col(id_col).alias("id"), F.col(card).alias("card"), F.col(t).alias("t"), F.col(amount).cast("double").alias("amount"), F.timestamp_seconds(F.col(t)).alias("__at")
    )
    res = (
        src.where("card is not null")
        .withWatermark("__at", delay)
        .withColumn("cards", F.pmod(F.xxhash64("card"), F.lit(CARD_GROUPS)))
        .groupBy("cards")
        .transformWithStateInPandas(_Velocity(dict(windows)), f"id long, card long, t long, {fields}", "append", "eventTime")
    )
    conf, name = events.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, _ROCKS)
    try:
        q = res.writeStream.outputMode("append").format("parquet").option("path", out_table).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start()
        q.awaitTermination()
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)
