"""Phrase collocations by stripes: each prefix keys a counter of next words.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces
into words ``[^\\x20\\x09]+``.  Everything is counted per language.

1. *Words.*  Each block of documents sends its distinct (language, word) pairs
   with their counts, packed by slice of the hash space; a slice adds them up,
   numbers the words that occur ``least`` times and replies with the numbers.
   No phrase with a rarer word can be a candidate, so such words end a phrase.
2. *Stripes.*  Each block keeps, for every prefix of two numbered words, an
   associative counter of the next word (0: none).  Stripes are dealt by a hash
   of their prefix, so no frequent word gathers its followers in one place, and
   are merged elementwise.  One merged stripe gives the extensions (phrases of
   three words), the prefix total (the count of the two) and the largest
   extension, which may subsume the prefix.
3. *Scores.*  Candidates are joined to the counts of their parts, exactly in
   decimals, and ranked in each language by a window whose limit Spark applies
   before the shuffle.

Memory per task follows the block size: there is a slice for every two blocks.
Words of one language are told apart within a block by 64-bit hashes (two of a
million would be taken for one in 3 of 100 million blocks) and by their bytes
everywhere else; numbers, prefixes and counts are exact.

Defined cases: a NULL text is empty, a NULL language is ``und`` (and counts with
the real ``und``); a text longer than ``LONG`` bytes is cut between its pieces;
equal rows count as often as they stand there; an empty table has no rows; other
columns are not read, whatever their names.  Of candidates with equal score and
count the phrase that is less in UTF-8 bytes comes first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.operators.modeltables import keep
from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from . import blocks as B
from .catalog import query
from .words import Words, mix

LEAST, MOST, SUBSUMED = 10, 2000, 50

#: Bytes of a text beyond which it is cut between pieces.
LONG = 4 << 20

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEPARATES = _BREAKS.copy()
_SEPARATES[[0x20, 0x09]] = True
_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")

_VOCABULARY, _TOTALS = -1, -2  # block numbers of what a slice keeps for itself


def _split_long(batches) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text); long texts as several rows, cut behind a separator."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        if not batch.num_rows or pc.max(sizes).as_py() <= LONG:
            yield batch
            continue
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            data, at = b"" if text.as_py() is None else text.as_buffer().to_pybytes(), 0
            while True:
                end = _BREAK.search(data, at + LONG) if len(data) - at > LONG else None
                part = data[at : end.end()] if end else data[at:]
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([part], pa.binary()).cast(pa.string())], ["lang", "text"])
                if not end:
                    break
                at = end.end()


class _Block:
    """Words of a block, and its distinct (language, word) pairs by hash."""

    def __init__(self, docs: pa.Table):
        langs = docs.column("lang").combine_chunks().dictionary_encode()
        seeds = np.array([xxhash.xxh64_intdigest(x) for x in langs.dictionary.to_pylist()] or [0], np.uint64)
        codes = langs.indices.to_numpy(zero_copy_only=False)
        words = Words(docs.column("text"), lower=True, separates=_SEPARATES)
        doc = words.doc()
        keys = mix(words.hash ^ seeds[codes[doc]]) if len(doc) else np.empty(0, np.uint64)
        order = np.argsort(keys)
        inner = keys[order]
        new = np.ones(len(inner), bool)
        new[1:] = inner[1:] != inner[:-1]
        self.keys = inner[new]
        starts = np.flatnonzero(new)
        self.counts = np.diff(np.append(starts, len(inner)))
        self.of = np.empty(len(inner), np.int64)  # each word's pair
        self.of[order] = np.cumsum(new) - 1
        shown = order[starts]  # one place of each pair
        first, size = words.start[shown], (words.end - words.start)[shown]
        offsets = np.concatenate([[0], np.cumsum(size)])
        body = words.data[np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])] if len(shown) else np.empty(0, np.uint8)
        plain = pa.Array.from_buffers(pa.large_binary(), len(shown), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)])
        lang = langs.dictionary.take(pa.array(codes[doc[shown]])).cast(pa.large_string()).cast(pa.large_binary())
        # a word holds no tab, so the last one parts language and word
        self.pairs = pc.binary_join_element_wise(lang, plain, pa.scalar(b"\t", pa.large_binary()))
        broken = np.concatenate([[0], np.cumsum(_BREAKS[words.data])])[words.start] if len(doc) else np.empty(0, np.int64)
        self.same_piece = np.zeros(len(doc), bool)  # as the next word
        self.same_piece[:-1] = (broken[1:] == broken[:-1]) & (doc[1:] == doc[:-1])

    def by_bucket(self, buckets: int) -> list[tuple[int, int, int]]:
        edges = B.bucket_edges(self.keys, buckets)
        return [(b, int(edges[b]), int(edges[b + 1])) for b in np.flatnonzero(np.diff(edges)).tolist()]


def _words_asked(buckets: int):
    def keys_of(docs: pa.Table) -> list[tuple[int, bytes]]:
        x = _Block(docs)
        rows = pa.RecordBatch.from_arrays([x.pairs, pa.array(x.counts, pa.int64())], ["pair", "n"])
        return [(b, B.dump(rows.slice(i, j - i))) for b, i, j in x.by_bucket(buckets)]

    return keys_of


def _numbered(buckets: int, least: int):
    """Adds a slice's counts up: numbers for each asking block, and the slice's
    own vocabulary and totals by language."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        asked = [B.load(p.as_buffer()) for p in group.column("payload")]
        rows = pa.concat_tables(asked).combine_chunks()
        coded = rows.column("pair").combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, codes, rows.column("n").to_numpy())
        often = np.flatnonzero(total >= least)
        often = often[pc.sort_indices(coded.dictionary.take(pa.array(often))).to_numpy()]
        numbers = np.zeros(len(total), np.int64)
        numbers[often] = np.arange(len(often)) * buckets + bucket + 1
        if numbers.max() >= 1 << 32:
            raise ValueError("more words than 32-bit numbers can tell apart")
        replies = np.split(numbers[codes], np.cumsum([a.num_rows for a in asked])[:-1])
        squeeze = zstandard.ZstdCompressor(level=1).compress
        vocabulary = pa.RecordBatch.from_arrays([pa.array(numbers[often]), coded.dictionary.take(pa.array(often)), pa.array(total[often])], ["id", "pair", "f"])
        lang = pc.replace_substring_regex(coded.dictionary.cast(pa.large_string()), r"(?s)\t[^\t]*\z", "")
        totals = pa.table({"lang": lang, "n": total}).group_by("lang").aggregate([("n", "sum")]).rename_columns(["lang", "n"]).combine_chunks()
        own = [B.dump(vocabulary), B.dump(totals.to_batches()[0])]
        blocks = [*group.column("block").to_pylist(), _VOCABULARY, _TOTALS]
        B.tidy()
        return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array([bucket] * len(blocks), pa.int32()), "payload": pa.array([*[squeeze(r.astype("<u4").tobytes()) for r in replies], *own], pa.binary())})

    return run


def _unmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(pow(0x81DADEF4BC2DD44D, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0x7FB5D329728EA185, -1, 1 << 64))
    return x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))


class Stripes:
    """Counters of next words: ``prefix`` ascending and distinct, ``degree``
    entries for each, ``next`` ascending within a prefix, ``count``."""

    def __init__(self, prefix: np.ndarray, next_: np.ndarray, count: np.ndarray):
        """Elementwise sum of entries in any order."""
        order = np.lexsort((next_, prefix))
        prefix, next_, count = prefix[order], next_[order], count[order]
        fresh = np.ones(len(prefix), bool)
        fresh[1:] = prefix[1:] != prefix[:-1]
        entry = fresh.copy()
        entry[1:] |= next_[1:] != next_[:-1]
        at = np.flatnonzero(entry)
        self.next, self.count = next_[at], np.add.reduceat(count, at) if len(at) else count
        self.prefix = prefix[fresh]
        self.start = np.append(np.searchsorted(at, np.flatnonzero(fresh)), len(at))

    @property
    def degree(self) -> np.ndarray:
        return np.diff(self.start)

    def totals(self) -> np.ndarray:
        return np.add.reduceat(self.count, self.start[:-1]) if len(self.prefix) else self.count

    def dump(self, i: int, j: int) -> bytes:
        """Prefixes i to j."""
        a, b = self.start[i], self.start[j]
        parts = [B.pack_sorted(self.prefix[i:j]), *[_thin(x) for x in (self.degree[i:j], self.next[a:b], self.count[a:b])]]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _thin(x: np.ndarray) -> bytes:
    """Numbers in as many bytes as the largest needs, byte planes apart."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return len(x).to_bytes(8, "little") + bytes([width]) + planes.tobytes()


def _wide(data: bytes, at: int) -> tuple[np.ndarray, int]:
    n, width = int.from_bytes(data[at : at + 8], "little"), data[at + 8]
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 9).reshape(width, n).T
    return wide.view("<u8").ravel().astype(np.int64), at + 9 + n * width


def _entries(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    prefix, at = B.unpack_sorted(data)
    degree, at = _wide(data, at)
    next_, at = _wide(data, at)
    count, at = _wide(data, at)
    return np.repeat(prefix, degree), next_.astype(np.uint32), count


def _stripes_of(docs: pa.Table, replies: dict[int, bytes], buckets: int) -> Stripes:
    x = _Block(docs)
    numbers = np.zeros(len(x.keys), np.uint64)
    for b, i, j in x.by_bucket(buckets):
        numbers[i:j] = np.frombuffer(zstandard.ZstdDecompressor().decompress(replies[b]), "<u4")
    number = numbers[x.of]
    ahead = np.zeros_like(number)  # the next word of the piece, 0 if there is none or it is rare
    ahead[:-1] = np.where(x.same_piece[:-1], number[1:], 0)
    after = np.zeros_like(number)
    after[:-1] = np.where(x.same_piece[:-1], ahead[1:], 0)
    at = np.flatnonzero((number > 0) & (ahead > 0))
    return Stripes(mix(number[at] << np.uint64(32) | ahead[at]), after[at].astype(np.uint32), np.ones(len(at), np.int64))


def _stripes_asked(buckets: int):
    def keys_of(docs: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        block = replies.pop(-1)
        x = _stripes_of(docs, replies, buckets)
        edges = B.bucket_edges(x.prefix, buckets)
        parts = [(b, x.dump(int(edges[b]), int(edges[b + 1]))) for b in np.flatnonzero(np.diff(edges)).tolist()]
        B.tidy()
        return pa.table({"bucket": pa.array([b for b, _ in parts], pa.int32()), "block": pa.array([block] * len(parts), pa.int64()), "payload": pa.array([p for _, p in parts], pa.binary())})

    return keys_of


_GRAMS = "w1 long, w2 long, w3 long, a long, two long, longest long"


def _merged(least: int):
    """All blocks' stripes of one slice, merged -> candidates.  A phrase of two
    words has w3 NULL and its largest extension; one of three has the count of
    its first two."""

    def run(group: pa.Table) -> pa.Table:
        parts = [_entries(p.as_py()) for p in group.column("payload")]
        x = Stripes(*(np.concatenate([p[k] for p in parts]) for k in range(3)))
        del parts
        totals, extends = x.totals(), np.where((x.next > 0) & (x.count >= least), x.count, 0)
        longest = np.maximum.reduceat(extends, x.start[:-1])
        words = _unmix(x.prefix)
        w1, w2 = (words >> np.uint64(32)).astype(np.int64), (words & np.uint64(0xFFFFFFFF)).astype(np.int64)
        two, three = np.flatnonzero(totals >= least), np.flatnonzero(extends)
        owner = np.repeat(np.arange(len(x.prefix)), x.degree)[three]
        none = np.zeros(len(two), np.int64)
        made = {
            "w1": np.concatenate([w1[two], w1[owner]]),
            "w2": np.concatenate([w2[two], w2[owner]]),
            "w3": pa.array(np.concatenate([none, x.next[three].astype(np.int64)]), mask=np.concatenate([none == 0, np.zeros(len(three), bool)])),
            "a": np.concatenate([totals[two], x.count[three]]),
            "two": np.concatenate([totals[two], totals[owner]]),
            "longest": np.concatenate([longest[two], np.zeros(len(three), np.int64)]),
        }
        B.tidy()
        return pa.table(made)

    return run


def _vocabulary(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("payload"):
            for part in B.load(blob.as_buffer()).to_batches(max_chunksize=10_000):
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("pair").cast(pa.binary()).cast(pa.string()), part.column("f")], ["id", "pair", "f"])


def _totals(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("payload"):
            for part in B.load(blob.as_buffer()).to_batches():
                yield pa.RecordBatch.from_arrays([part.column("lang").cast(pa.string()), part.column("n")], ["lang", "n"])


def candidates(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, block_bytes: int = B.BLOCK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grams, vocabulary, totals): phrases of two and three words that occur
    ``least`` times by word number, the numbered words (pair: language, tab,
    word) and all word occurrences of each language."""
    docs = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    buckets = B.bucket_count_of(docs, "text", block_bytes)
    asked = B.ask_rows(docs, _words_asked(buckets), block_bytes, _split_long)
    answers = cut_lineage(asked.groupBy("bucket").applyInArrow(_numbered(buckets, least), "block long, bucket int, payload binary"))
    blocks = B.pack(docs, block_bytes, keep=False, first=_split_long)
    stripes = B.ask_again(blocks, answers.filter("block >= 0"), _stripes_asked(buckets))
    grams = keep(stripes.groupBy("bucket").applyInArrow(_merged(least), _GRAMS))
    words = keep(answers.filter(F.col("block") == _VOCABULARY).select("payload").mapInArrow(_vocabulary, "id long, pair string, f long"))
    totals = answers.filter(F.col("block") == _TOTALS).select("payload").mapInArrow(_totals, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    return grams, words, totals


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exact for counts up to 10^15."""
    d = [F.col(c).cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", d[0] * d[0] * F.lit(1_000_000).cast("decimal(7,0)"), d[1] * d[2])


def collocations(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most: int = MOST, subsumed: int = SUBSUMED, block_bytes: int = B.BLOCK_BYTES
) -> DataFrame:
    """The ``most`` best phrases of each language: lang, rank, phrase, a, l, r,
    n, score.  A phrase of two words goes if one of three words that holds it
    has at least ``subsumed`` per cent of its count."""
    grams, words, totals = candidates(df, text_col, lang_col, least, block_bytes)

    def named(k: int) -> DataFrame:
        return words.select(F.col("id").alias(f"w{k}"), F.col("f").alias(f"f{k}"), F.col("pair").alias(f"p{k}"))

    two, three = grams.filter("w3 IS NULL"), grams.filter("w3 IS NOT NULL")
    ends = three.groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("longer"))
    best = F.greatest("longest", F.coalesce("longer", F.lit(0)))
    alone = two.join(ends, ["w1", "w2"], "left").filter((best == 0) | (F.lit(100) * best < F.lit(subsumed) * F.col("a"))).select("w1", "w2", "a")
    alone = alone.join(named(1), "w1").join(named(2), "w2").select(
        F.col("p1").alias("pair"), F.substring_index("p2", "\t", -1).alias("rest"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score")
    )
    tail = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    triple = three.select("w1", "w2", "w3", "a", F.col("two").alias("f12")).join(tail, ["w2", "w3"]).join(named(1), "w1").join(named(3), "w3").join(named(2).drop("f2"), "w2")
    triple = triple.withColumns({"s1": _score("a", "f1", "f23"), "s2": _score("a", "f12", "f3")})
    early = F.col("s1") <= F.col("s2")
    triple = triple.select(
        F.col("p1").alias("pair"),
        F.concat_ws(" ", F.substring_index("p2", "\t", -1), F.substring_index("p3", "\t", -1)).alias("rest"),
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    word = F.substring_index("pair", "\t", -1)
    found = alone.unionByName(triple).select(
        F.expr("left(pair, length(pair) - length(substring_index(pair, '\\t', -1)) - 1)").alias("lang"), F.concat_ws(" ", word, "rest").alias("phrase"), "a", "l", "r", "score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, i < len(w) AS has2, i + 1 < len(w) AS has3 FROM spots),
f1 AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM grams WHERE has2 GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE has3 GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (
  SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, x.f AS l, y.f AS r,
    CAST(1000000 AS HUGEINT) * b.f * b.f // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM f2 b JOIN f1 x ON x.lang = b.lang AND x.w1 = b.w1 JOIN f1 y ON y.lang = b.lang AND y.w1 = b.w2
  LEFT JOIN longer g ON g.lang = b.lang AND g.w1 = b.w1 AND g.w2 = b.w2
  WHERE b.f >= 10 AND NOT coalesce(100 * g.f >= 50 * b.f, false)),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
    CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(x.f AS HUGEINT) * yz.f) AS s1,
    CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(xy.f AS HUGEINT) * z.f) AS s2
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 z ON z.lang = t.lang AND z.w1 = t.w3
  JOIN f2 xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2 JOIN f2 yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3),
found AS (
  SELECT * FROM two UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM found)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_mining", SQL)
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
