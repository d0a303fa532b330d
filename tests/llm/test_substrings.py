import random
import re
from collections import Counter

from pyspark.sql import functions as F

from riskspark.llm import blocks as B
from riskspark.llm.substrings import remove_repeated_windows

import numpy as np


def brute(texts, k):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + k]) for w in split for i in range(len(w) - k + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append((" ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone), gone))
    return out


def check(df, texts_of, k):
    got = remove_repeated_windows(df, "text", k).collect()
    expected = brute([texts_of(r) for r in got], k)
    for r, (kept, n, removed, gone) in zip(got, expected, strict=True):
        assert (r.kept_text, r.n_words, r.n_removed) == (kept, n, removed)
        marked = [False] * n
        for s in r.removed_spans:
            assert not (s.start and marked[s.start - 1])  # maximal
            marked[s.start : s.end] = [True] * (s.end - s.start)
        assert marked == gone
    return got


def test_awkward_rows(awkward):
    got = check(awkward, lambda r: r.text, 35)
    assert len(got) == awkward.count()
    assert {r.doc_id for r in got if r.n_removed} == {1, 2, 7, None}


def test_small_alphabet_many_overlaps(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))) for i in range(200)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), lambda r: r.text, 6)


def test_overlap_inside_one_document(spark):
    text = " ".join("ab"[i % 2] for i in range(11))
    (r,) = remove_repeated_windows(spark.createDataFrame([(1, text)], "doc_id long, text string"), "text", 4).collect()
    assert r.n_removed == 11 and r.kept_text == ""


def test_empty_table_and_clashing_column(spark, empty, awkward):
    assert remove_repeated_windows(empty).count() == 0
    extra = awkward.withColumn("n_words", F.lit("mine")).withColumn("block", F.lit(1))
    done = remove_repeated_windows(extra)
    assert done.schema["n_words"].dataType.simpleString() == "bigint" and done.filter("block = 1").count() == awkward.count()


def test_packed_keys_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        keys = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64, endpoint=False))
        back, at = B.unpack_sorted(B.pack_sorted(keys) + b"rest")
        assert (back == keys).all() and at == len(B.pack_sorted(keys))
        for buckets in (1, 3, 7):
            edges = B.bucket_edges(keys, buckets)
            assert (np.repeat(np.arange(buckets), np.diff(edges)) == B.buckets_of(keys, buckets)).all()
