"""SimHash near-duplicate groups by pigeonhole blocks.

A text's fingerprint has a bit set where more than half of its shingle hashes
(XXH64, seed 42) have it.  Two fingerprints that differ in at most ``d`` bits
agree on at least ``k - d`` of ``k`` bit blocks; for d = 3 and k = 6 each
fingerprint is filed under its 20 choices of three blocks (about 32 bits), and
close pairs share a file.  Fingerprints in one file are compared in numpy
inside a task, and only a spanning star of each linked group leaves the task,
never its pairs.  A file with more than ``dense`` fingerprints is filed again
by three of the six halves of its free blocks: then at most 16 bits are free,
which bounds a file by 65,536 distinct fingerprints, and links are found by
flipping up to ``d`` free bits.

Equal fingerprints are one node, so copies cost nothing; the groups are the
connected components of all links.

Defined cases: NULL and empty texts have no words, fingerprint zero, and are
linked like any other; a text shorter than a shingle is hashed whole; repeated
rows and ids fall in one group; NULL ids get a group but never name one; an
empty table gives an empty result; extra columns do not matter (only id and
text are read).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from .catalog import query
from .components import components, star_edges

SHINGLE = 3
MAX_BITS = 3
DENSE = 4096
_PAIR_ROWS = 512

_POPCOUNT16 = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def popcount(x: np.ndarray) -> np.ndarray:
    return _POPCOUNT16[x.astype(np.uint64).view(np.uint16).reshape(*x.shape, 4)].sum(axis=-1, dtype=np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text: A-Z lowered, words [^\\x20\\x09-\\x0D]+."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], 42) for a, b in zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)], np.uint64
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last, bitorder="little").tobytes(), "little")


def add_fingerprint(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE, out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made.view(np.int64))], [*batch.schema.names, out])

    return df.mapInArrow(run, df.select("*", F.lit(0).cast("long").alias(out)).schema)


def _spread(bits: list[int], parts: int) -> list[list[int]]:
    cut = np.array_split(np.array(bits), parts)
    return [c.tolist() for c in cut]


def _masks(bits: list[int], blocks: int, shared: int) -> list[int]:
    """One mask of kept bits for each choice of ``shared`` of ``blocks`` blocks of ``bits``."""
    parts = _spread(bits, blocks)
    return [sum(1 << b for part in chosen for b in part) for chosen in combinations(parts, shared)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(prints: np.ndarray, free: int, most: int, dense: int = DENSE) -> np.ndarray:
    """Component label of each distinct fingerprint of one file, given in
    ascending (unsigned) order: a dense file is searched by bisection."""
    n = len(prints)
    a_all, b_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if n <= dense:
        for at in range(0, n, _PAIR_ROWS):
            rows = prints[at : at + _PAIR_ROWS, None] ^ prints[None, at:]
            a, b = np.nonzero(popcount(rows) <= most)
            keep = a < b
            a_all.append(a[keep] + at)
            b_all.append(b[keep] + at)
            if sum(map(len, a_all)) > 1 << 20:  # a dense file: keep a spanning star of what was found
                label = star_edges(n, np.concatenate(a_all), np.concatenate(b_all))
                a_all, b_all = [np.arange(n)], [label]
    else:
        places = [i for i in range(64) if free >> i & 1]
        for size in range(1, most + 1):
            for flips in combinations(places, size):
                other = prints ^ np.uint64(sum(1 << i for i in flips))
                at = np.minimum(np.searchsorted(prints, other), n - 1)
                hit = np.flatnonzero(prints[at] == other)
                a_all.append(hit)
                b_all.append(at[hit])
            label = star_edges(n, np.concatenate(a_all), np.concatenate(b_all))
            a_all, b_all = [np.arange(n)], [label]
    return star_edges(n, np.concatenate(a_all), np.concatenate(b_all))


def _stars(most: int, dense: int):
    """Rows sorted by (mask, filed, fingerprint) -> spanning links of each file."""

    def links(mask, filed, prints):
        new = np.ones(len(prints), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (filed[1:] != filed[:-1])
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], len(prints))
        sizes = ends - begins
        out_a, out_b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        pairs = begins[sizes == 2]  # most files with company: one vectorised comparison
        close = popcount(prints[pairs] ^ prints[pairs + 1]) <= most
        out_a.append(prints[pairs[close]])
        out_b.append(prints[pairs[close] + 1])
        for i, j in zip(begins[sizes > 2].tolist(), ends[sizes > 2].tolist(), strict=True):
            own = np.sort(prints[i:j])  # Spark sorts them as signed longs: those with bit 63 come first
            label = _linked(own, ~int(mask[i]) & ((1 << 64) - 1), most, dense)
            moved = np.flatnonzero(label != np.arange(len(own)))
            out_a.append(own[moved])
            out_b.append(own[label[moved]])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            now = [np.asarray(batch.column(k)).view(np.uint64) for k in ("mask", "filed", "fingerprint")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            # the last file may go on in the next batch; a file is bounded, so this is too
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = int(np.argmax(last))
            if cut:
                yield links(*[x[:cut] for x in now])
            held = [x[cut:] for x in now]
        if held is not None and len(held[0]):
            yield links(*held)

    return run


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None, dense: int = DENSE) -> DataFrame:
    """Spanning links (a, b) of all pairs of distinct ``fingerprint`` values
    that differ in at most ``max_bits`` bits."""
    blocks = blocks or 2 * max_bits
    shared = blocks - max_bits
    first = _masks(list(range(64)), blocks, shared)
    files = prints.select("fingerprint", F.explode(F.array(*[F.lit(_signed(m)) for m in first])).alias("mask")).withColumn(
        "filed", F.col("fingerprint").bitwiseAND(F.col("mask"))
    )
    hot = files.groupBy("mask", "filed").agg(F.count("*").alias("n")).filter(F.col("n") > dense).drop("n").withColumn("hot", F.lit(True))
    marked = files.join(hot, ["mask", "filed"], "left")
    finer = F.create_map(
        *[
            x
            for m in first
            for x in (
                F.lit(_signed(m)),
                F.array(*[F.lit(_signed(m | s)) for s in _masks([i for i in range(64) if not m >> i & 1], blocks, shared)]),
            )
        ]
    )
    again = (
        marked.filter("hot")
        .select("fingerprint", F.explode(F.element_at(finer, F.col("mask"))).alias("mask"))
        .withColumn("filed", F.col("fingerprint").bitwiseAND(F.col("mask")))
        .distinct()
    )
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filed = marked.filter("hot is null").select("mask", "filed", "fingerprint").unionByName(again.select("mask", "filed", "fingerprint"))
    dealt = filed.repartition(parts, "mask", "filed").sortWithinPartitions("mask", "filed", "fingerprint")
    return dealt.mapInArrow(_stars(max_bits, dense), "a long, b long")


def near_groups(df: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` (an id, a fingerprint, more) with component_id, the smallest id
    that can be reached over links of at most ``max_bits`` differing bits, and
    component_root, the component's smallest fingerprint."""
    own = df.groupBy("fingerprint").agg(F.min(id_col).alias("_least"))
    roots = components(near_links(own.select("fingerprint"), max_bits))
    rooted = own.join(roots, own["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root")
    )
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_print = rooted.join(named, "_root").select("fingerprint", "component_id", F.col("_root").alias("component_root"))
    return df.join(by_print, "fingerprint")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: id, fingerprint (signed long), component_id."""
    prints = cut_lineage(add_fingerprint(df.select(id_col, text_col), text_col, shingle).select(id_col, "fingerprint"))
    return near_groups(prints, id_col, max_bits)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group, all columns: the row with the
    smallest id (NULL ids last), then the smallest text hash.  Rows are found
    again by id and text hash, so nothing depends on how the table is read."""
    own = F.xxhash64(text_col)
    keyed = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), own.alias("_hash"))
    prints = cut_lineage(add_fingerprint(keyed, "_text", shingle).select("_id", "_hash", "fingerprint"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash")).alias("first")
    chosen = near_groups(prints, "_id", max_bits).groupBy("component_root").agg(first).select("first._id", "first._hash")
    tagged = df.withColumn("_own_hash", own)
    same = (tagged["_own_hash"] == chosen["_hash"]) & tagged[id_col].eqNullSafe(chosen["_id"])
    return tagged.join(chosen, same, "left_semi").dropDuplicates([id_col, "_own_hash"]).drop("_own_hash")


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 3 bits."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
