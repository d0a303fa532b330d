import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskspark.llm import quality

from .conftest import SCHEMA, prose, rows


class Plain:
    """Interpolated modified Kneser-Ney over padded words, in dictionaries."""

    def __init__(self, texts, order=quality.ORDER):
        self.order = order
        top = Counter(g for t in texts for w in words(t) for g in grams(w, order))
        self.levels = {order: top}
        for k in range(order - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.cut, self.total, self.mass = {}, {}, {}
        for k, level in self.levels.items():
            n = Counter(level.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            d = [min(max(c - (c + 1) * y * n[c + 1] / n[c] if n[c] else c / 2, 0.05 * c), 0.95 * c) for c in (1, 2, 3)]
            self.cut[k] = d
            total, mass = Counter(), defaultdict(float)
            for g, c in level.items():
                total[g[:-1]] += c
                mass[g[:-1]] += d[min(c, 3) - 1]
            self.total[k], self.mass[k] = total, mass

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.levels[1]) + 1)
        context = gram[:-1]
        lower = self.p(gram[1:]) if k > 1 else self.p("")
        if not self.total[k][context]:
            return lower
        c = self.levels[k][gram]
        own = (c - self.cut[k][min(c, 3) - 1]) / self.total[k][context] if c else 0
        return own + self.mass[k][context] / self.total[k][context] * lower

    def perplexity(self, text):
        logs = [math.log(self.p(g)) for w in words(text) for g in grams(w, self.order)]
        return math.exp(-sum(logs) / len(logs)) if logs else None


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def grams(word, order):
    padded = "\x02" * (order - 1) + word + "\x03"
    return [padded[i - order + 1 : i + 1] for i in range(order - 1, len(padded))]


@pytest.fixture(scope="module")
def trusted_texts():
    return [prose(100 + i, 60) for i in range(12)]


@pytest.fixture(scope="module")
def model(spark, trusted_texts):
    return quality.train(spark.createDataFrame([(t,) for t in trusted_texts], "text string").repartition(3), buckets=5)


def test_perplexities_equal_the_plain_model(awkward, model, trusted_texts):
    plain = Plain(trusted_texts)
    got = quality.score(awkward.withColumn("perplexity", F.lit("mine")).withColumn("bucket", F.lit(1)), model).collect()
    assert len(got) == awkward.count()
    for r in got:
        expected = plain.perplexity(r.text)
        assert (r.perplexity is None) == (expected is None)
        if expected:
            assert r.perplexity == pytest.approx(expected, rel=1e-4)


def test_perplexities_across_word_ends_equal_the_plain_model(spark, awkward, trusted_texts, monkeypatch):
    apart = words
    monkeypatch.setitem(globals(), "words", lambda t: [" ".join(apart(t))] if apart(t) else [])
    plain = Plain(trusted_texts)
    model = quality.train(spark.createDataFrame([(t,) for t in trusted_texts], "text string").repartition(3), buckets=5, across=True)
    for r in quality.score(awkward, model).collect():
        expected, w = plain.perplexity(r.text), apart(r.text)
        assert (r.perplexity is None) == (expected is None)
        assert r.repeated == pytest.approx(sum(x in w[max(0, i - quality.NEAR) : i] for i, x in enumerate(w)) / max(1, len(w)))
        if expected:
            assert r.perplexity == pytest.approx(expected, rel=1e-4)


def test_order_raises_perplexity_and_repeats_are_rejected(spark):
    def text(seed, n):  # each word has one that follows it
        return " ".join(f"{a} {b}" for a, b in zip(prose(seed, n).replace(".", "").split(), prose(seed + 1000, n).upper().replace(".", "").split()))

    sound = [(i, text(i, 60)) for i in range(40)]
    scrambled = sorted(sound[39][1].split())
    junk = [(50, " ".join(scrambled)), (51, " ".join(["the"] * 80)), (52, " ".join(["an THE"] * 40)), (53, " ".join(["the THE"] * 9 + ["an ST"] * 30))]
    df = spark.createDataFrame(rows(*sound, *junk), SCHEMA)
    model = quality.train(df.filter("doc_id < 30"), buckets=3, across=True)
    scored = quality.score(df, model)
    got = {r.doc_id: r for r in quality.decide(scored, quality.thresholds(scored, spark.range(30).withColumnRenamed("id", "doc_id"))).collect()}
    assert all(got[i].keep for i in range(40)) and not any(got[i].keep for i in (51, 52, 53))
    assert got[50].perplexity > 1.1 * got[39].perplexity


def test_probabilities_sum_to_one(spark, trusted_texts):
    counts = quality.gram_counts(spark.createDataFrame([(t,) for t in trusted_texts], "text string"))
    table = {r.gram: (r.log_p, r.log_bow) for r in quality.kneser_ney(counts).collect()}
    symbols = {g for g in table if len(g) == 1 and table[g][0] is not None}

    def p(gram):
        if gram in table and table[gram][0] is not None:
            return math.exp(table[gram][0])
        bow = table.get(gram[:-1], (None, None))[1]
        return math.exp(bow or 0.0) * p(gram[1:])

    unknown = math.exp(table[""][0]) * math.exp(table[""][1])
    for context in ("", "t", "\x02\x02\x02\x02", "\x02\x02\x02t", "zz", "the\x02", "tion"):
        total = sum(p(context + s) for s in symbols)
        rest = unknown
        for i in range(len(context)):
            bow = table.get(context[i:], (None, None))[1]
            rest *= math.exp(bow) if bow is not None else 1.0
        assert total + rest == pytest.approx(1.0, abs=1e-9)


def test_decisions(spark, model):
    docs = rows(*[(i, prose(300 + i, 80)) for i in range(40)], (50, "XX&& ##QQ " * 20), (51, None), (52, " ")) + rows((60, prose(9, 50)), lang=None)
    df = spark.createDataFrame(docs, SCHEMA)
    trusted = spark.createDataFrame([(i,) for i in range(30)] + [(999,)], "doc_id long")
    scored = quality.score(df, model)
    kept = {r.doc_id: r.keep for r in quality.decide(scored, quality.thresholds(scored, trusted)).collect()}
    assert all(kept[i] for i in range(40)) and kept[60] and not kept[50] and not kept[51] and not kept[52]
    nothing = trusted.filter("doc_id < 0")
    free = {r.doc_id: r.keep for r in quality.decide(scored, quality.thresholds(scored, nothing)).collect()}
    assert free[50] and not free[51]


def test_training_sample_is_bounded_and_deterministic(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    trusted = spark.range(0, 100, 2).select(F.col("id").alias("doc_id"))
    one = {r.doc_id for r in quality.training_sample(docs, trusted, most=10).collect()}
    assert len(one) == 10 and one == {r.doc_id for r in quality.training_sample(docs.repartition(5), trusted, most=10).collect()}


def test_empty_tables(spark, empty, model):
    assert quality.score(empty, model).count() == 0
    blank = quality.train(spark.createDataFrame([], "text string"), buckets=2)
    (r,) = quality.score(spark.createDataFrame([("ab",)], "text string"), blank).collect()
    assert r.perplexity == pytest.approx(1.0)
