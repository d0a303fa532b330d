import random

import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import fingerprints as P

from .conftest import SCHEMA, prose, rows


def test_order_does_not_matter_and_updates_add_up():
    parts = P.paragraphs(prose(1, 200))
    mixed = parts[:]
    random.Random(1).shuffle(mixed)
    whole = P.vector_sum(parts)
    assert (whole == P.vector_sum(mixed)).all()
    assert (P.vector_sum(parts[:5]) + P.vector_sum(parts[5:]) == whole).all()
    assert (P.delete(P.insert(whole, "more"), "more") == whole).all()
    assert (P.insert(P.vector_sum(parts[1:]), parts[0]) == whole).all()
    assert not (P.vector_sum([*parts, parts[0]]) == whole).all()
    assert (P.from_hex(P.as_hex(whole)) == whole).all()
    assert not P.fingerprint(None).any() and not P.fingerprint(" \n ").any()


def plain(parts):
    """The fingerprint in whole numbers of Python, lane by lane."""
    top = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 31) * 0x7FB5D329728EA185 & top
        x = (x ^ x >> 27) * 0x81DADEF4BC2DD44D & top
        return x ^ x >> 33

    wide, signs = [0] * 8, [0] * 128
    for p in parts:
        h = xxhash.xxh3_128_intdigest(p.encode())
        for k in range(8):
            wide[k] += mixed(h >> 64 ^ mixed((h & top) + (k + 1) * 0x9E3779B97F4A7C15 & top))
        for k in range(128):
            signs[k] += 1 if h >> (127 - k) & 1 else -1
    return "".join(f"{x & top:016x}" for x in wide) + "".join(f"{x & 0xFFFFFFFF:08x}" for x in signs)


def test_equals_a_plain_version():
    for parts in ([], ["a"], ["b"] * 3, P.paragraphs(prose(4, 300)), ["é 漢字", "", "x" * 64]):
        assert P.as_hex(P.vector_sum(parts)) == plain(parts)


@pytest.mark.parametrize("n", [1 << 15, 1 << 16, 1 << 17])
def test_many_copies_neither_vanish_nor_collide(n):
    a, b, none = P.fingerprint("a\n" * n), P.fingerprint("b\n" * n), P.fingerprint("")
    assert len({P.as_hex(x) for x in (a, b, none)}) == 3
    assert P.likeness(a, b) < 0.6 and P.likeness(a, none) < 0.6 and P.likeness(a, a) == 1
    assert (P.from_hex(P.as_hex(a)) == a).all()
    assert (a - P.vector_sum(["a"] * n) == none).all()
    assert P.likeness(a, P.fingerprint("a\n" * (n + 1))) < 1


def test_likeness():
    a, b = P.paragraphs(prose(1, 2000)), P.paragraphs(prose(2, 2000))
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    va, vb, half = P.vector_sum(a), P.vector_sum(b), P.vector_sum(a[: n // 2] + b[n // 2 :])
    assert P.likeness(va, va) == 1 and P.likeness(P.fingerprint(""), P.fingerprint(None)) == 1
    assert P.likeness(va, vb) < 0.35 and 0.3 < P.likeness(va, half) < 0.75


def expected(data):
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t, *_) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        new = P.edited(t, n)
        f, g = P.fingerprint(t), P.fingerprint(new)
        out.append((i, len(t), new, P.as_hex(f), P.as_hex(g), P.likeness(f, g), P.likeness(f, P.fingerprint(n))))
    return out


@pytest.mark.parametrize("n", [1, 2, 57])
def test_edited_texts_equal_brute_force(spark, n):
    data = rows(*[(i * 7 - 20, None if i % 11 == 3 else "" if i % 13 == 5 else prose(i, i % 40)) for i in range(n)])
    got = P.edited_fingerprints(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(expected(data))


def test_awkward_rows(awkward, empty):
    got = P.edited_fingerprints(awkward.withColumn("edited", F.lit("mine"))).collect()
    assert len(got) == awkward.count()
    texts = {}
    for r in awkward.collect():
        texts.setdefault(r.doc_id, set()).add(P.as_hex(P.fingerprint(r.text)))
    assert all(r.fingerprint in texts[r.doc_id] and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert P.edited_fingerprints(empty).count() == 0
    assert [r.fingerprint for r in P.add_fingerprint(awkward.filter("doc_id = 7")).collect()] == [P.as_hex(P.fingerprint(prose(2, 60)))] * 2


def test_edit_rule():
    assert P.edited("abcde", "XYZ") == "abcXY" and P.edited("abcdef", "X") == "abcX" and P.edited("", "X") == "" and P.edited("éñ", "漢字") == "é漢"
