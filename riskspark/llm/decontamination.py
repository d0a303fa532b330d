"""Benchmark decontamination by greedy string tiling.

1. Seeds: every run of ``SEED`` words of a benchmark item (an item with fewer
   words is one seed).  A document is kept as a suspect if it hits at least as
   many seeds as the least demanding item needs; hits are looked up in a
   bitmap of fixed size, so the benchmark may be of any size.
2. Suspect texts and items are joined on their shared seeds.  The item words
   under shared seeds bound the coverage from above; pairs below the threshold
   go no further.
3. Greedy string tiling of each remaining pair: Karp-Rabin windows find the
   common runs, the longest run of unmarked words is marked as a tile, and
   again, until no run of ``SEED`` words is left.  Tiles may stand in any
   order, so reordered passages are covered too.
4. An item is leaked if its tiles cover at least ``COVERAGE`` of its words.

Words are lower-cased runs of letters, digits and non-ASCII characters.  A
text is judged once, however many documents have it; items of equal words are
one item, named by the smallest id.

Defined cases: NULL and empty texts or items never match; a very long text is
looked up alone, and memory follows its words however often they repeat; repeated
rows each get the verdict of their text; an empty table on either side gives an empty
result; columns other than ids and texts are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from .blocks import cut
from .catalog import query
from .words import NOT_ALNUM, Words, windows

SEED = 5
COVERAGE = 0.8
#: Bits of the seed bitmap: 4 MB to broadcast, for any benchmark.
BITMAP = 1 << 25
#: Pairs of agreeing places in a text and an item that are held at once.
MOST_PAIRS = 1 << 18
#: Bytes of text worked on at once.
BATCH_BYTES = 4 << 20


def normal_words(texts) -> Words:
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return Words(pc.utf8_lower(texts.cast(pa.string())), separates=NOT_ALNUM)


def seeds_of(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``length`` words; the length is in the hash."""
    at, h = windows(words.hash, words.first, length)
    return at, h + np.uint64(length)


def _free_runs(x: np.ndarray, marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the runs of ``length`` words without a marked one."""
    at, h = windows(x, np.array([0, len(x)]), length)
    sums = np.concatenate([[0], np.cumsum(marked)])
    free = sums[at + length] == sums[at]
    return at[free], h[free]


def _tiles_by_length(a: np.ndarray, b: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same tiles in memory that follows the words and not the pairs: the
    length of the longest common free run is found by halving, as every shorter
    length has one too; then the first place in b that has it, and its first in a."""
    marked_a, marked_b, out, most = np.zeros(len(a), bool), np.zeros(len(b), bool), [], min(len(a), len(b))

    def common(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at_a, ha = _free_runs(a, marked_a, length)
        at_b, hb = _free_runs(b, marked_b, length)
        shared = np.isin(hb, ha)
        return at_a, ha, at_b[shared], hb[shared]

    while most >= k and len(common(k)[2]):
        low, high = k, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[2]) else (low, middle - 1)
        at_a, ha, at_b, hb = common(low)
        y = int(at_b[0])
        x = int(at_a[np.flatnonzero(ha == hb[0])[0]])
        out.append((x, y, low))
        marked_a[x : x + low], marked_b[y : y + low], most = True, True, low
    return out


def tiles(a: np.ndarray, b: np.ndarray, shortest: int, most_pairs: int = MOST_PAIRS) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word-hash sequences: (start in a, start in
    b, length), longest first; ties go to the earliest place in b, then in a.
    Where words repeat so much that more than ``most_pairs`` pairs of places agree,
    the pairs are not made; the result is the same."""
    k = min(shortest, len(a), len(b))
    if not k:
        return []
    first = lambda x: np.array([0, len(x)])
    at_a, ha = windows(a, first(a), k)
    at_b, hb = windows(b, first(b), k)
    order = np.argsort(ha, kind="stable")
    lo, hi = np.searchsorted(ha[order], hb, "left"), np.searchsorted(ha[order], hb, "right")
    n = hi - lo
    if n.sum() > most_pairs:
        return _tiles_by_length(a, b, k)
    j = np.repeat(at_b, n)
    i = at_a[order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
    by_diagonal = np.lexsort((j, i - j))
    i, j = i[by_diagonal], j[by_diagonal]
    out = []
    while len(i):
        # runs of neighbours on one diagonal are maximal common runs
        new = np.ones(len(i), bool)
        new[1:] = (i[1:] - i[:-1] != 1) | (j[1:] - j[:-1] != 1)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(i)))
        best = begin[np.lexsort((i[begin], j[begin], -size))[0]]
        length = int(size[np.searchsorted(begin, best)]) + k - 1
        x, y = int(i[best]), int(j[best])
        out.append((x, y, length))
        free = ((i + k <= x) | (i >= x + length)) & ((j + k <= y) | (j >= y + length))
        i, j = i[free], j[free]
    return out


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words, n): distinct items as joined normal words."""

    def run(batches):
        for batch in batches:
            w = normal_words(batch.column(1))
            data = w.data.tobytes()
            joined = [
                b" ".join(data[s:e] for s, e in zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True))
                for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(joined, pa.binary()).cast(pa.string()), pa.array(w.count, pa.int64())], ["item", "words", "n"]
            )

    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "item long, words string, n long").filter("n > 0").groupBy("words", "n").agg(F.min("item").alias("item"))


def _item_seeds(items: DataFrame, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            w = normal_words(batch.column("words"))
            for k in range(1, seed + 1):
                at, h = seeds_of(w, k)
                own = w.doc()[at]
                fits = np.minimum(w.count, seed)[own] == k
                at, h, own = at[fits], h[fits], own[fits]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("words").take(pa.array(own)), pa.array(h.view(np.int64)), pa.array(at - w.first[own]), pa.array(np.full(len(at), k))],
                    ["words", "seed", "at", "length"],
                )

    return items.select("words").mapInArrow(run, "words string, seed long, at long, length long")


def _suspects(docs: DataFrame, id_col: str, text_col: str, bitmap, lengths: list[int], least: int) -> DataFrame:
    def run(batches):
        for batch in (part for whole in batches for part in cut(whole, BATCH_BYTES)):
            w = normal_words(batch.column(1))
            seeds: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for k in lengths:
                at, h = seeds_of(w, k)
                hit = np.flatnonzero(bitmap.value[(h >> np.uint64(42)).astype(np.int64)] >> ((h >> np.uint64(39)) & np.uint64(7)).astype(np.uint8) & 1)
                own = w.doc()[at[hit]]
                for d in np.unique(own).tolist():
                    seeds[d] += np.unique(h[hit[own == d]]).view(np.int64).tolist()
            keep = pa.array([len(s) >= least for s in seeds])
            found = pa.array(seeds, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(c.filter(keep) for c in batch.columns), found.filter(keep)], ["id", "text", "seeds"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    found = rows.mapInArrow(run, "id long, text string, seeds array<long>")
    return cut_lineage(found.withColumn("key", F.sha2(F.col("text").cast("binary"), 256)))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    seed: int = SEED,
    coverage: float = COVERAGE,
) -> tuple[DataFrame, DataFrame]:
    """(per document, per text): the leaked items of each suspect document as
    (id, item, n_words, n_matched, coverage, tiles), and the same by ``key``,
    the SHA-256 of the text."""
    spark = docs.sparkSession
    items = cut_lineage(_items(benchmark, item_col, item_text_col))
    item_seeds = cut_lineage(_item_seeds(items, seed).distinct())
    # at most BITMAP cells, so the collected cells and the bitmap are bounded
    cells = item_seeds.select(F.shiftrightunsigned("seed", 39).alias("cell")).distinct().toPandas()["cell"].to_numpy()
    bits = np.zeros(BITMAP // 8, np.uint8)
    np.bitwise_or.at(bits, cells >> 3, (1 << (cells & 7)).astype(np.uint8))
    lengths = [r[0] for r in item_seeds.select("length").distinct().orderBy("length").collect()]
    least = least_hits(item_seeds, items, seed, coverage)
    suspects = _suspects(docs, id_col, text_col, spark.sparkContext.broadcast(bits), lengths, least)

    texts = suspects.select("key", "text").dropDuplicates(["key"])
    hits = suspects.select("key", "seeds").dropDuplicates(["key"]).select("key", F.explode("seeds").alias("seed"))
    shared = hits.join(item_seeds, "seed")
    placed = shared.groupBy("key", "words").agg(F.collect_set("at").alias("ats"), F.first("length").alias("length"))
    under = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda p: F.sequence(p, p + F.col("length") - 1)))))
    pairs = placed.withColumn("under", under).join(items, "words").filter(F.col("under") >= F.ceil(F.lit(coverage) * F.col("n") - 1e-9))

    def run(batches):
        for batch in (part for whole in batches for part in cut(whole, BATCH_BYTES)):
            a, b = normal_words(batch.column("text")), normal_words(batch.column("words"))
            found = [tiles(a.hash[a.first[i] : a.first[i + 1]], b.hash[b.first[i] : b.first[i + 1]], seed) for i in range(batch.num_rows)]
            kind = pa.list_(pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))
            rows = [[{"doc_start": x, "item_start": y, "length": n} for x, y, n in t] for t in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("item"), batch.column("n"), pa.array([sum(t[2] for t in f) for f in found], pa.int64()), pa.array(rows, kind)],
                ["key", "item", "n_words", "n_matched", "tiles"],
            )

    schema = "key string, item long, n_words long, n_matched long, tiles array<struct<doc_start:long,item_start:long,length:long>>"
    tiled = texts.join(pairs.select("key", "words", "item", "n"), "key").select("key", "item", "n", "text", "words").mapInArrow(run, schema)
    by_text = cut_lineage(tiled.withColumn("coverage", F.col("n_matched") / F.col("n_words")).filter(F.col("coverage") >= coverage - 1e-12))
    return suspects.select("id", "key").join(by_text, "key").drop("key"), by_text


def least_hits(item_seeds: DataFrame, items: DataFrame, seed: int, coverage: float) -> int:
    """Distinct seeds that a document must share to cover any item: a seed
    covers at most ``length`` words at each of its places in the item, so the
    seeds with the most places set the bound; at least one."""
    per_seed = item_seeds.groupBy("words", "seed").agg(F.count("*").alias("places"), F.first("length").alias("length"))
    most = per_seed.groupBy("words").agg(F.max(F.col("places") * F.col("length")).alias("most"))
    need = items.join(most, "words").select(F.ceil((F.lit(coverage) * F.col("n") - 1e-9) / F.col("most")).alias("need"))
    return max(1, int(need.agg(F.min("need")).first()[0] or 1))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose text leaks no benchmark item; all columns."""
    _, by_text = leaks(docs.withColumn("_leak_id", F.lit(0)), benchmark, "_leak_id", text_col, **settings)
    bad = by_text.select("key").distinct()
    key = F.sha2(F.col(text_col).cast("binary"), 256)
    return docs.withColumn("_leak_key", key).join(bad, F.col("_leak_key") == bad["key"], "left_anti").drop("_leak_key")


@query("op6_benchmark_decontamination")
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, with the item and its coverage."""
    found, _ = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_words", "n_matched", F.round("coverage", 6).alias("coverage"), F.size("tiles").alias("n_tiles")
    )
