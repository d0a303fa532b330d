"""Exact substring deduplication over fixed-length token windows.

Every window of ``window`` consecutive words gets a Karp-Rabin hash (64 bits
of one polynomial and 16 of a second one).  The hashes of all windows are
counted by Spark: each block of documents sends its distinct hashes, sorted
and packed by slice of the hash space, and each slice is counted whole in one
task.  The reply is one bit per hash, in the order sent: does it start in any
other block as well.  Repeats inside one block are known to the block.  All
words of repeated windows are then removed; overlapping windows merge into
maximal intervals.

Windows are judged on the input: copies do not keep a first occurrence.  Two
different windows are taken for one with probability 2^-80; for n windows in
the corpus that is n^2 / 2^81 expected errors, 3e-5 for 8 billion windows.

Defined cases: NULL and empty texts have no words, kept text '' and no spans;
documents shorter than a window lose nothing; equal rows are separate
documents and remove each other's windows; an empty table gives an empty
result.  Extra columns are carried along, but one named like an output column
(kept_text, n_words, n_removed, removed_spans) is replaced.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.sources.tables import table

from . import blocks as B
from .catalog import query
from .words import Words, mix, windows

WINDOW = 35
_SECOND_BASE = 0xAF251AF3B0F025B5

OUTPUT = T.StructType(
    [
        T.StructField("kept_text", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


class _Keys:
    """A block's windows: distinct (hash, check) pairs in ascending order."""

    def __init__(self, words: Words, length: int):
        self.at, h = windows(words.hash, words.first, length)
        check = (windows(mix(words.hash ^ np.uint64(0x5851F42D4C957F2D)), words.first, length, _SECOND_BASE)[1] >> np.uint64(48)).astype(np.uint16)
        order = np.argsort(h, kind="stable")
        h, check = h[order], check[order]
        same = h[1:] == h[:-1]
        if (check[1:] != check[:-1])[same].any():  # equal hashes, different windows: sort on both
            again = np.lexsort((check, h))
            order, h, check = order[again], h[again], check[again]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        self.order, self.group = order, np.cumsum(new) - 1
        self.hash, self.check = h[new], check[new]
        self.repeats = np.bincount(self.group, minlength=len(self.hash)) > 1

    def by_bucket(self, buckets: int) -> list[tuple[int, int, int]]:
        edges = B.bucket_edges(self.hash, buckets)
        return [(b, int(edges[b]), int(edges[b + 1])) for b in np.flatnonzero(np.diff(edges)).tolist()]


def _asker(text_col: str, length: int, buckets: int):
    def keys_of(docs: pa.Table):
        keys = _Keys(Words(docs.column(text_col)), length)
        return [(b, B.pack_sorted(keys.hash[i:j]) + keys.check[i:j].tobytes()) for b, i, j in keys.by_bucket(buckets)]

    return keys_of


def _elsewhere(_: int, payloads: list[bytes]) -> list[bytes]:
    """One bit per hash of each payload: some other payload has it too."""
    hashes, checks = [], []
    for p in payloads:
        h, at = B.unpack_sorted(p)
        hashes.append(h)
        checks.append(np.frombuffer(p, np.uint16, len(h), at))
    sizes = [len(h) for h in hashes]
    h, c = np.concatenate(hashes), np.concatenate(checks)
    order = np.argsort(h, kind="stable")
    sh, sc = h[order], c[order]
    if (sc[1:] != sc[:-1])[sh[1:] == sh[:-1]].any():
        order = np.lexsort((c, h))
        sh, sc = h[order], c[order]
    twin = (sh[1:] == sh[:-1]) & (sc[1:] == sc[:-1])
    found = np.zeros(len(h), bool)
    found[order[1:]] |= twin
    found[order[:-1]] |= twin
    return [np.packbits(part).tobytes() for part in np.split(found, np.cumsum(sizes)[:-1])]


def _spans(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def _finisher(text_col: str, length: int, buckets: int):
    def finish(docs: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        words = Words(docs.column(text_col))
        keys = _Keys(words, length)
        repeated = keys.repeats.copy()
        for b, i, j in keys.by_bucket(buckets):
            repeated[i:j] |= np.unpackbits(np.frombuffer(replies[b], np.uint8), count=j - i).astype(bool)
        starts = keys.at[keys.order[repeated[keys.group]]]
        depth = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + length, -1)
        gone = np.cumsum(depth[:-1]) > 0
        data, first = words.data.tobytes(), words.first
        kept, removed, spans = [], [], []
        for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            mask = gone[a:b]
            n = int(mask.sum())
            own = data[words.start[a] : words.end[b - 1]].split() if b > a else []
            kept.append(b" ".join(compress(own, ~mask) if n else own))
            removed.append(n)
            spans.append(_spans(mask) if n else [])
        made = {
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            "n_words": pa.array(words.count, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "removed_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        }
        for name, values in made.items():
            docs = docs.append_column(name, values)
        return docs

    return finish


def remove_repeated_windows(df: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with kept_text (kept words joined by one space), n_words,
    n_removed and removed_spans (word positions [start, end), maximal)."""
    df = B.make_room(df, OUTPUT.names, text_col)
    packed = B.pack(df)
    buckets = B.bucket_count(packed)
    replies = B.answer(B.ask(packed, _asker(text_col, window, buckets)), _elsewhere)
    return B.use(packed, replies, _finisher(text_col, window, buckets), T.StructType(df.schema.fields + OUTPUT.fields))


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 35 words over all documents, as per-document digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_windows(docs, "text", WINDOW).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"), F.size("removed_spans").alias("n_spans")
    )
