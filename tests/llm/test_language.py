import random

import pytest
from pyspark.sql import functions as F

from riskspark.llm import language as L

PARTS = {"en": "the ing ed an tion wh ou ly", "de": "sch ein der ung ich pf zu ß", "es": "ción qué ñ los ez rr ll ado"}


def text(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(PARTS[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def training(spark):
    rows = [(text(x, i, 80), x) for x in PARTS for i in range(20)] + [(None, "en"), ("no language", None), ("", "de")]
    return spark.createDataFrame(rows, "text string, lang string").repartition(4)


@pytest.fixture(scope="module")
def model(training):
    return L.learn(training)


def test_held_out_accuracy(model):
    texts = [(x, text(x, 1000 + i, n)) for x in PARTS for i in range(30) for n in (6, 60)]
    got = L.infer(model, [t for _, t in texts])
    right = [g[0] == x for (x, _), g in zip(texts, got)]
    assert sum(right) / len(right) >= 0.98
    assert all(0 <= g[1] <= 1 for g in got) and sum(len(g[2]) == 1 for g in got) / len(got) >= 0.95


def test_mixtures_get_their_proportions(model):
    mixed = text("en", 1, 300) + " " + text("de", 2, 100)
    ((lang, score, parts),) = L.infer(model, [mixed])
    share = dict(parts)
    assert lang == "en" and set(share) == {"en", "de"} and abs(share["de"] - 0.25) < 0.1 and score < 0.95


def test_a_batch_gives_what_single_texts_give(model):
    texts = [text(x, i, n) for i, n in enumerate((1, 5, 50)) for x in PARTS] + ["", "12 !!", "x"]
    assert L.infer(model, texts) == [L.infer(model, [t])[0] for t in texts]


def test_tables(spark, awkward, empty, training, model):
    got = {r.doc_id: r for r in L.identify(awkward.withColumn("score", F.lit("mine")), model).collect()}
    assert L.identify(awkward, model).count() == awkward.count()
    for i in (3, 4, 5):
        assert (got[i].lang_pred, got[i].score, got[i].languages) == ("und", 0.0, [])
    assert got[8].lang_pred in PARTS and got[6].lang_pred == "en"
    assert L.identify(empty, model).count() == 0
    nothing = L.learn(training.filter("lang = 'xx'"))
    assert {r.lang_pred for r in L.identify(awkward, nothing).collect()} == {"und"}


def test_hashed_counts_equal_plain_counts(training):
    cells = 1 << 12
    counted = {(r.lang, r.cell): r.n for r in L.gram_counts(training, cells=cells).collect()}
    plain = {}
    for r in training.filter("text is not null and lang is not null").collect():
        for cell in L._grams([r.text], cells)[1].tolist():
            plain[r.lang, cell] = plain.get((r.lang, cell), 0) + 1
    assert counted == plain
    # trigrams with a letter in the middle, or a space between two letters of one text
    assert [len(L._grams([t], cells)[0]) for t in ("ab", "", "--ab--", "a", "ab cd")] == [2, 0, 2, 1, 5]
    assert len(L._grams(["ab", "", "--ab--", "a"], cells)[0]) == 5
