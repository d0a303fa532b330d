import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import lm
from riskspark.llm.eliasfano import EliasFano

END = object()


def test_elias_fano_equals_a_sorted_array(tmp_path):
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (7, 3), (500, 40), (500, 10**9), (3000, 3000)):
        values = np.sort(rng.integers(0, top, n))
        ef = EliasFano.build(values).save(str(tmp_path), f"s{n}-{top}")
        assert (ef.get(np.arange(n)) == values).all()
        asked = np.unique(np.concatenate([values, values + 1, rng.integers(0, top + 5, 200), [0, top + 100]]))
        assert (ef.next_geq(asked) == np.searchsorted(values, asked)).all()


def test_trie_finds_its_pairs_and_nothing_else(tmp_path):
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 60, (900, 2)), axis=0)
    count = rng.integers(1, 6, len(pairs))
    trie = lm.Trie(str(tmp_path), pairs[:, 0], pairs[:, 1], count)
    asked, n = np.arange(0, 70, 3), np.full(24, 64)
    kinds, codes = trie.lookup(asked, n, np.tile(np.arange(64), 24))
    got = lm.decode(codes).reshape(24, 64)
    known = {tuple(x): c for x, c in zip(pairs.tolist(), count.tolist())}
    for i, v in enumerate(asked.tolist()):
        own = [known.get((v, w), 0) for w in range(64)]
        assert got[i].tolist() == own
        assert kinds[:, i].tolist() == [own.count(1), own.count(2), sum(c > 2 for c in own)]


def test_codes_keep_small_counts_and_a_relative_step():
    count = np.unique(np.concatenate([np.arange(5000), np.geomspace(1, 1e13, 4000).astype(np.int64)]))
    back = lm.decode(lm.encode(count))
    assert (back[count < lm.EXACT] == count[count < lm.EXACT]).all()
    assert np.allclose(back, count, rtol=3e-4) and lm.encode(count).max() < 65535


def plain(docs):
    tokens = [[*[w.decode() for w in (t or "").encode().lower().split()], END] for t, _ in docs]
    c, pairs = Counter(), Counter()
    for words, (_, trained) in zip(tokens, docs):
        if trained:
            c.update(words)
            pairs.update(zip([END, *words[:-1]], words))
    total, distinct = sum(c.values()), len(c)
    d = lm.discounts(lm.counts_of_counts(np.array(list(pairs.values()), np.int64)))
    mass = Counter()
    for (v, _), n in pairs.items():
        mass[v] += d[min(n, 3) - 1] / c[v]
    out = []
    for words in tokens:
        base = score = 0.0
        for v, w in zip([END, *words[:-1]], words):
            u = (c[w] + 1) / (total + distinct + 1)
            n = pairs[v, w]
            base += math.log10(u)
            score += math.log10(((n - d[min(n, 3) - 1]) / c[v] if n else 0) + mass[v] * u if c[v] else u)
        out.append((len(words), sum(c[w] > 0 for w in words), total, base, score))
    return out


@pytest.mark.parametrize("buckets", [1, 6])
def test_scores_equal_the_plain_model(awkward, buckets):
    df = awkward.withColumn("trained", F.when(F.col("doc_id") % 3 == 0, F.lit(False)).when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.lit(True)))
    got = lm.score_texts(df.withColumn("score", F.lit("mine")).withColumn("n_docs", F.lit(1)), "trained", buckets=buckets).collect()
    assert len(got) == awkward.count()
    for r, (n, known, total, base, score) in zip(got, plain([(r.text, r.trained) for r in got]), strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-6)  # no count here is quantised


@pytest.mark.parametrize("buckets", [1, 6])
def test_frequent_context_with_one_successor(spark, buckets):
    """No probability is 0, however much a context is seen."""
    docs = [("a b " * 400_000, True), ("c d", True), ("a c", False), ("a zzz", False), ("c a", False), ("zzz b", False)]
    df = spark.createDataFrame(docs, "text string, trained boolean").repartition(3)
    got = {r.text: r.score for r in lm.score_texts(df, "trained", buckets=buckets).collect()}
    for (text, _), (n, *_, score) in zip(docs, plain(docs), strict=True):
        # counts from EXACT on have a step of 0.0005, half of which is 0.00011 in log10
        assert math.isfinite(got[text]) and got[text] == pytest.approx(score, rel=1e-9, abs=1.1e-4 * n)


def test_frequent_contexts_are_split_and_still_sum_to_one(spark):
    texts = [" ".join(f"the w{(i * 7 + k) % 50}" for k in range(60)) for i in range(20)]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, trained boolean").repartition(4)
    one, many = (
        {r.doc_id: r.score for r in lm.score_texts(df, "trained", buckets=b).collect()} for b in (1, 8)
    )
    assert all(many[i] == pytest.approx(one[i], rel=1e-9) for i in one)


def test_nothing_to_learn_and_empty_table(spark, empty, awkward):
    got = lm.score_texts(awkward.withColumn("trained", F.lit(False)), "trained", buckets=3).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    assert lm.score_texts(empty.withColumn("trained", F.lit(True)), "trained").count() == 0
