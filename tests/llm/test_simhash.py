import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import simhash
from riskspark.llm.components import components


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, most=3):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= most:
            parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def clouds(seed, n_centres, per, spread):
    rng = random.Random(seed)
    out = []
    for _ in range(n_centres):
        centre = rng.getrandbits(64)
        for _ in range(per):
            x = centre
            for b in rng.sample(range(64), rng.randrange(spread + 1)):
                x ^= 1 << b
            out.append(x)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def check_groups(spark, prints, **settings):
    rows = [(i, signed(x)) for i, x in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    links = simhash.near_links(df.select("fingerprint").distinct(), **settings)
    roots = {r.node: r.root for r in components(links).collect()}
    mine = [roots.get(signed(x), signed(x)) for x in prints]
    plain = groups(prints)
    assert len(set(zip(mine, plain))) == len(set(mine)) == len(set(plain))


def test_fingerprints_and_groups_of_awkward_rows(awkward):
    got = simhash.simhash_groups(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {}
    for r in awkward.collect():
        by_id.setdefault(r.doc_id, set()).add(signed(plain_fingerprint(r.text)))
    assert all(r.fingerprint in by_id[r.doc_id] for r in got)
    named = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert named[1] == named[2] == 1 and named[3] == named[4] == named[5] == 3 and named[7] == 7


def test_links_equal_brute_force(spark):
    check_groups(spark, clouds(1, 12, 25, 4))


def test_dense_files_are_filed_again(spark):
    check_groups(spark, clouds(2, 3, 120, 5), dense=4)


def test_flipping_equals_comparing():
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 1 << 10, 400).astype(np.uint64) << np.uint64(5))
    free = ((1 << 16) - 1) << 3
    assert (simhash._linked(prints, free, 2, dense=10**6) == simhash._linked(prints, free, 2, dense=1)).all()


def test_dense_file_with_the_sign_bit_free():
    """Rows as Spark delivers them, by signed fingerprint."""
    rng = np.random.default_rng(7)
    free = ((1 << 15) - 1) << 3 | 1 << 63
    places = [i for i in range(64) if free >> i & 1]
    picked = rng.choice(1 << 16, 900, replace=False).tolist()
    prints = np.sort(np.array([signed(sum((x >> k & 1) << p for k, p in enumerate(places))) for x in picked], np.int64))
    assert prints[0] < 0 < prints[-1]
    mask = signed(~free & ((1 << 64) - 1))
    batch = pa.RecordBatch.from_arrays([pa.array(np.full(900, mask)), pa.array(np.zeros(900, np.int64)), pa.array(prints)], ["mask", "filed", "fingerprint"])
    unsigned = prints.view(np.uint64).tolist()
    at = {x: i for i, x in enumerate(unsigned)}
    for most in (1, 2, 3):
        parent = list(range(900))
        for out in simhash._stars(most, 16)([batch]):
            for a, b in zip(*(np.asarray(out.column(k)).view(np.uint64).tolist() for k in ("a", "b")), strict=True):
                while parent[at[a]] != at[a]:
                    a = unsigned[parent[at[a]]]
                while parent[at[b]] != at[b]:
                    b = unsigned[parent[at[b]]]
                parent[at[a]] = at[b]
        plain = groups(unsigned, most)
        assert sum(parent[i] == i for i in range(900)) == len(set(plain))


def test_long_chains_are_one_component(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and got[101] == got[100] == 100


def test_keep_one(spark, awkward, empty):
    kept = simhash.keep_one(awkward.withColumn("fingerprint", F.lit("mine"))).collect()
    prints = [plain_fingerprint(r.text) for r in kept]
    assert len(set(groups(prints))) == len(kept)
    everything = [plain_fingerprint(r.text) for r in awkward.collect()]
    assert len(kept) == len(set(groups(everything)))
    assert {r.fingerprint for r in kept} == {"mine"} and {1, 3, 7} <= {r.doc_id for r in kept}
    assert simhash.keep_one(empty).count() == 0 and simhash.simhash_groups(empty).count() == 0
