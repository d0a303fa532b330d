import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import decontamination as D

from .conftest import SCHEMA, prose, rows


def normal(text):
    return [w for w in re.split(r"[^0-9a-z\u0080-\U0010ffff]+", (text or "").lower()) if w]


def plain_tiling(a, b, k):
    """Greedy string tiling by comparing every pair of places."""
    k = min(k, len(a), len(b))
    mark_a, mark_b, out = [False] * len(a), [False] * len(b), []
    while k:
        best = (0, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not mark_a[i + n] and not mark_b[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < k:
            break
        i, j, n = best
        mark_a[i : i + n] = mark_b[j : j + n] = [True] * n
        out.append(best)
    return out


def test_tiles_equal_plain_tiling():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(3) for _ in range(rng.randrange(0, 30))]
        b = [rng.randrange(3) for _ in range(rng.randrange(0, 20))]
        got = D.tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert got == plain_tiling(a, b, 3)


ITEMS = {i: prose(700 + i, 20 + i) for i in range(8)} | {100: "Only four little words", 101: "", 102: None, 103: prose(700, 20).upper()}


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    out = []
    for i in range(40):
        item = ITEMS[i % 8].split()
        half = len(item) // 2
        passage = {0: item, 1: item[half:] + ["between"] + item[:half], 2: item[: half - 2], 3: [], 4: item[: int(len(item) * 0.9)]}[i % 5]
        body = prose(900 + i, rng.randrange(5, 90)).split()
        at = rng.randrange(len(body))
        out.append((i, " ".join(body[:at] + passage + body[at:])))
    return rows(*out, (200, None), (201, ""), (202, "some only FOUR, little words here"), (203, out[0][1]), (203, out[0][1]), (None, out[0][1]))


def test_leaks_equal_plain_tiling(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    bench = spark.createDataFrame(list(ITEMS.items()), "item_id long, text string")
    per_doc, _ = D.leaks(df, bench)
    got = sorted((r.id if r.id is not None else -1, r.item, r.n_matched) for r in per_doc.collect())
    expected = []
    for doc_id, text, *_ in docs:
        for item, words in ITEMS.items():
            b = normal(words)
            if item == 103 or not b:
                continue  # equal words of item 0
            matched = sum(n for *_, n in plain_tiling(normal(text), b, 5))
            if matched >= 0.8 * len(b):
                expected.append((doc_id if doc_id is not None else -1, item, matched))
    assert got == sorted(expected) and len(got) > 15
    clean = D.without_leaks(df.withColumn("key", F.lit("mine")).withColumn("id", F.lit(0)), bench)
    bad = {i for i, *_ in expected}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d[0] for d in docs if d[0] is not None and d[0] not in bad)
    assert {r.key for r in clean.collect()} == {"mine"}


def test_empty_sides(spark, empty, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    bench = spark.createDataFrame(list(ITEMS.items()), "item_id long, text string")
    none = bench.filter("item_id < 0")
    assert D.leaks(df, none)[0].count() == 0 and D.leaks(empty, bench)[0].count() == 0
    assert D.without_leaks(df, none).count() == len(docs)
    assert D.leaks(df, bench.filter("item_id > 100 and item_id < 103"))[0].count() == 0


def test_repeated_words_give_the_same_tiles_without_pairs():
    rng = np.random.default_rng(7)
    for _ in range(60):
        a, b = (rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint64) for _ in range(2))
        assert D.tiles(a, b, 3, most_pairs=0) == D.tiles(a, b, 3, most_pairs=10**9)
    same = np.full(400_000, 5, np.uint64)
    assert D.tiles(same, same[:60], 5) == [(0, 0, 60)]
    mixed = np.where(np.arange(400_000) % 50 == 49, 9, 5).astype(np.uint64)
    assert D.tiles(mixed, same[:60], 5) == [(0, 0, 49), (50, 49, 11)]
