import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskspark.llm import bpe, stages

from .conftest import SCHEMA, prose, rows
from .test_decontamination import normal
from .test_simhash import groups, plain_fingerprint
from .test_substrings import brute


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    item = prose(40_000, 30)
    shared = prose(50_000, 60)
    clean = [(i, prose(10_000 + i, 150 + i)) for i in range(30)]
    copies = [(100 + i, clean[i][1]) for i in range(5)]
    passages = [(200 + i, prose(20_000 + i, 100) + " " + shared + " " + prose(21_000 + i, 100)) for i in range(3)]
    leaked = [(300, prose(30_000, 70) + " " + item + " " + prose(30_001, 70))]
    junk = [(400, "###&&& %%QQ$$ " * 30), (401, None), (402, "")]
    docs = rows(*clean, *copies, *passages, *leaked, *junk) + rows((500, prose(60_000, 90)), lang=None)
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(25)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_whole_pipeline(spark, folder):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert set(got) == {*range(30), 200, 201, 202, 500}
    library = Tokenizer.from_file(bpe.word_vocabulary())
    kept = [i for i in docs if i < 30 or i in (200, 201, 202, 300, 500)]
    after = dict(zip(kept, brute([docs[i] for i in kept], 35)))
    for i, r in got.items():
        text, _, removed, _ = after[i]
        assert (removed > 0) == (i in (200, 201, 202))
        assert r.text == (text if removed else docs[i]) and r.n_chars == len(r.text)
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_rows(spark, folder, awkward, empty, name, stage):
    extra = awkward.withColumns({c: F.lit("mine") for c in ("ids", "kept_text", "fingerprint", "keep", "key", "perplexity", "_extra")})
    done = stage(spark, extra, folder)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert last or done.columns == extra.columns
    got = done.collect()
    assert all(r.key == "mine" and r.kept_text == "mine" for r in got)
    texts = [r.text for r in awkward.collect()]
    if name == "quality_classifier":
        assert {r.doc_id for r in got} >= {1, 2, 6, 7, 10, 11} and not {3, 4, 5} & {r.doc_id for r in got}
    elif name == "simhash_near_dedup":
        assert len(got) == len(set(groups([plain_fingerprint(t) for t in texts])))
    else:
        assert len(got) == len(texts)
    assert stage(spark, empty, folder).count() == 0


def test_guard_is_in_the_entry_alone():
    for path in (corpus_pipeline.__file__, stages.__file__):
        assert not re.search(r"except\s+(ImportError|ModuleNotFoundError)", open(path).read())
    assert normal("A-b") == ["a", "b"]
