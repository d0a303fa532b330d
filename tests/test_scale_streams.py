"""what the streams cost does not follow the number of files or rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.plans import streaming_plans as plans
from riskspark.streaming import jobs as sj


def test_a_feed_arrives_as_one_batch(spark, tmp_path, monkeypatch):
    spark.range(60).select(
        F.col("id").alias("o_orderkey"), F.lit(1).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(2.0).alias("o_totalprice"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.timestamp_seconds("id").alias("o_orderdate"),
    ).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 5.0, "A")], "c_custkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    seen = []
    monkeypatch.setattr(plans, "_frozen", lambda *_: None)
    stream = sj.file_stream
    monkeypatch.setattr(sj, "file_stream", lambda spark, folder, glob, max_files=1: seen.append((folder, max_files)) or stream(spark, folder, glob, max_files))

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(sj, "stream_score_audit", stop)
    with pytest.raises(KeyboardInterrupt):
        plans.stream_score_audit(spark, str(tmp_path))
    ((folder, most),) = seen
    files = len(spark.read.parquet(folder).inputFiles())
    assert files > 3 and most * 3 >= files


class _List:
    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def appendList(self, rows):
        self.rows += rows

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.timers = []

    def getListState(self, *_):
        return _List()

    def registerTimer(self, at):
        self.timers.append(at)


class _At:
    def __init__(self, seconds):
        self.seconds = seconds

    def getCurrentWatermarkInMs(self):
        return self.seconds * 1000


def test_one_timer_for_all_minutes_of_a_group():
    handle, p = _Handle(), sj._Velocity({"h": 3600})
    p.init(handle)
    rows = pd.DataFrame({"card": [i % 5 for i in range(300)], "t": [60 * i for i in range(300)], "id": range(300), "amount": 1.0})
    list(p.handleInputRows((0,), iter([rows]), None))
    assert handle.timers == [60_000]
    (out,) = p.handleExpiredTimer((0,), _At(9000), None)
    assert sorted(out["id"]) == list(range(151)) and handle.timers[1] == 9120_000
    for card, found in out.groupby("card"):
        t = sorted(found["t"])
        want = [sum(1 for u in t if s - 3600 < u <= s) for s in t]
        assert found.sort_values("t")["card_txn_count_h"].tolist() == want == found.sort_values("t")["card_amt_sum_h"].tolist()
