import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm import bpe


@pytest.fixture(scope="module")
def both():
    path = bpe.word_vocabulary()
    return Tokenizer.from_file(path), bpe.ForcedBoundaryBPE(open(path, encoding="utf-8").read())


ODD = ["a", "é", "é", "Σ", "İ", "ß", " ", "\n", "\x1c", "\x85", "​", "　", "'s", "'T", "<|endoftext|>", "<|ENDOFTEXT|>", "漢", "😀", "１", "½", "!?", "##", "\x00", "ǅ", "ﬁ", "ẞ", "क्ष", "Th"]


def test_equals_the_library_on_random_text(both):
    library, own = both
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(ODD) if rng.random() < 0.8 else chr(rng.choice([rng.randrange(32, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(rng.randrange(25)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_use_the_heap_and_agree(both):
    library, own = both
    for word in ("a" * 700, "ab" * 400, "thonon" * 90):
        assert own.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_cuts_are_pairs_that_no_token_contains(both):
    _, own = both
    tokens = {t.removesuffix(own.end) for t in own.vocab}
    for word in ("ñó", "zqxj", "thé", "!#$"):
        parts = own.fragments(word)
        assert "".join(parts) == "".join(own.as_text[b] for b in word.encode())
        for left, right in zip(parts, parts[1:]):
            assert not any(left[-1] + right[0] in t for t in tokens)


def test_table(awkward, empty, both):
    library, _ = both
    path = bpe.word_vocabulary()
    done = bpe.encode_decode(awkward.withColumn("ids", F.lit("clash")), path).collect()
    assert len(done) == awkward.count()
    for r in done:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    two = bpe.decode(bpe.encode(awkward, path), path)
    assert sorted((r.decoded, r.ids) for r in two.collect()) == sorted((r.decoded, r.ids) for r in done)
    assert bpe.encode_decode(empty, path).count() == 0
