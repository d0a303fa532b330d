import zlib

from pyspark.sql import functions as F

from riskspark.llm import sharding


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 7, 16, 17, 100, 1009):
        got = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n)).collect()]
        assert sorted(got) == list(range(n))
        if n > 50:
            assert got != list(range(n)) and got != [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, seed=5)).collect()]


def test_numbers_follow_the_key_order(spark):
    df = spark.range(500).select((F.col("id") * 37 % 501).alias("k"), F.lit("x").alias("place")).repartition(7)
    numbered, n = sharding.number_rows(df, ["k"])
    rows = sorted(numbered.collect(), key=lambda r: r.row_number)
    assert n == 500 and [r.row_number for r in rows] == list(range(500)) and [r.k for r in rows] == sorted(r.k for r in rows)


def test_one_key_for_a_third_of_all_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    numbered, n = sharding.number_rows(df, ["k"])
    assert sorted(r.row_number for r in numbered.collect()) == list(range(n)) == list(range(3000))


def test_query_law(spark, awkward, empty, tmp_path):
    awkward.write.parquet(str(tmp_path / "a/documents.parquet"))
    rows = sharding.op5_feistel_sharding(spark, str(tmp_path / "a")).collect()
    texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in awkward.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"], r.text_crc32) for r in rows) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert (r.law, r.grown_shard, r.shard, r.slot) == ("rows", None, r.place % 16, r.place // 16)
    sizes = [len(by_shard.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    again = sharding.op5_feistel_sharding(spark, str(tmp_path / "a")).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    empty.write.parquet(str(tmp_path / "e/documents.parquet"))
    assert sharding.op5_feistel_sharding(spark, str(tmp_path / "e")).count() == 0
