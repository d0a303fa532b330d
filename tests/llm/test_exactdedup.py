import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import exactdedup as E
from riskspark.llm import perfecthash

from .conftest import SCHEMA, prose, rows


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(data):
    groups = defaultdict(list)
    for r in data:
        groups[normal(r[1])].append(r[0])
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i))
        out += [(i, order[0], len(ids), at == 0, hashlib.sha256(text.encode()).hexdigest()) for at, i in enumerate(order)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=str)


@pytest.mark.parametrize("history", ["true", "false", "doc_id % 2 = 0", "doc_id > 3"])
def test_awkward_rows(awkward, awkward_rows, history):
    assert got(E.deduplicate(awkward, F.expr(history), per_shard=2, lookups=3)) == brute(awkward_rows)


def test_spacing_alone_makes_texts_equal(spark):
    data = rows((3, "a \t\n b"), (1, "a b"), (2, " a b"), (4, "a\xa0b"), (5, "a\x0b\x0c\r b"), (6, "a b "))
    assert got(E.deduplicate(spark.createDataFrame(data, SCHEMA), F.col("doc_id") > 2)) == brute(data)


def test_group_of_a_third_is_served_by_several_copies(spark):
    data = rows(*[(i, "same text" if i % 3 == 0 else prose(i % 400, 12)) for i in range(1500)])
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    done = E.deduplicate(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, per_shard=50, lookups=60)
    assert got(done) == brute(data)


def test_no_task_gets_the_hot_group(spark, monkeypatch):
    data = rows(*[(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)])
    seen = []
    real = E.cut_lineage
    monkeypatch.setattr(E, "cut_lineage", lambda df: seen.append(real(df)) or seen[-1])
    E.deduplicate(spark.createDataFrame(data, SCHEMA), F.lit(True), per_shard=100, lookups=120).count()
    heavy = next(x for x in seen if x.columns == ["shard", "copies"]).collect()
    assert heavy and max(r.copies for r in heavy) >= 1000 // 120


def test_empty_tables(empty):
    for history in (F.lit(True), F.lit(False)):
        assert E.deduplicate(empty, history).collect() == []


def test_carried_and_clashing_columns(spark):
    df = spark.createDataFrame([("b", "x y", 1, 2.0), ("a", "x  y", 3, None), (None, "x y", 5, 1.0)], "name string, body string, shard int, place double")
    done = E.deduplicate(df, F.col("name") == "b", "body", "name", ["shard", "place"])
    assert sorted(map(str, done.drop("digest").collect())) == sorted(
        [
            "Row(shard=1, place=2.0, name='b', keep_id='a', group_size=3, kept=False)",
            "Row(shard=3, place=None, name='a', keep_id='a', group_size=3, kept=True)",
            "Row(shard=5, place=1.0, name=None, keep_id='a', group_size=3, kept=False)",
        ]
    )
    with pytest.raises(ValueError, match="result columns"):
        E.deduplicate(df.withColumn("Kept", F.lit(1)), F.lit(True), "body", "name", ["Kept"])


def test_perfect_hash_is_minimal_and_checked():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 256, (5000, 32), np.uint8)
    for n in (0, 1, 2, 5000):
        made, slots = perfecthash.build(keys[:n])
        assert sorted(slots) == list(range(n))
        assert (perfecthash.lookup(made, keys[:n]) == slots).all()
        others = perfecthash.lookup(made, rng.integers(0, 256, (1000, 32), np.uint8))
        assert others.max() < max(n, 1)  # a slot of the set, or none: the digest in it decides
    with pytest.raises(ValueError, match="distinct"):
        perfecthash.build(np.repeat(keys[:1], 2, axis=0))


def test_slot_of_another_digest_is_no_member(spark):
    """Nonmembers often reach a slot; the byte check sends them to their own group."""
    old = rows(*[(i, f"old {i}") for i in range(300)])
    new = rows(*[(1000 + i, f"new {i // 2}") for i in range(600)])
    assert got(E.deduplicate(spark.createDataFrame(old + new, SCHEMA), F.col("doc_id") < 1000, per_shard=64)) == brute(old + new)
