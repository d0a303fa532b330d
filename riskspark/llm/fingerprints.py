"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs: pieces that end at a line break
or at a sentence mark followed by a space (long ones are cut further).  Each paragraph is hashed
(XXH3, 128 bits) to a wide vector: 8 full-width lanes of 64 hashed bits and 128
sign lanes of +1 or -1.  The fingerprint is the lane-wise sum, modulo 2^64 and,
for the sign lanes as they are written down, modulo 2^32.  Hence

* order does not matter, and equality is equality of the multisets: two given
  different multisets collide with probability about 2^-128, and no number of
  copies below 2^48 makes a paragraph vanish or take another's place;
* inserting or deleting a paragraph adds or subtracts its vector (``insert``,
  ``delete``), and fingerprints of parts add up;
* the squared length of the difference of two fingerprints' sign lanes
  estimates the size of the multisets' difference, which gives ``likeness`` in
  0..1 without the texts: 1 for equal multisets alone, about 0 (with a standard
  deviation of sqrt(2/128)) for disjoint ones.  Sums are read as signed, which
  is exact below 2^31 paragraphs.

Defined cases: NULL and empty texts have no paragraph and the zero
fingerprint, and two of them have likeness 1; very long texts are summed in
slices; equal rows have equal fingerprints; an empty table gives an empty
result; columns other than the id and the text are not read.  Ids are whole
numbers; NULL ids come first in the order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.sources.tables import table

from .catalog import query
from .words import mix

WIDE, SIGNS = 8, 128
LONGEST = 64
_SLICE = 1 << 14
_LANE = np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def paragraphs(text: str | None) -> list[str]:
    """Pieces between line breaks or sentence ends, stripped, without empty
    ones; a longer piece is cut every ``LONGEST`` code points from its start,
    so that a change late in a long paragraph leaves its beginning alike."""
    text = (text or "").replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n")
    pieces = [p for part in text.split("\n") if (p := part.strip())]
    return [p[i : i + LONGEST] for p in pieces for i in range(0, len(p), LONGEST)]


def vector_sum(parts: list[str]) -> np.ndarray:
    """Lane-wise sum of the paragraphs' vectors, modulo 2^64: full-width lanes
    first, then sign lanes."""
    total = np.zeros(WIDE + SIGNS, np.uint64)
    digest = xxhash.xxh3_128_digest
    for at in range(0, len(parts), _SLICE):
        raw = np.frombuffer(b"".join([digest(p.encode("utf-8", "surrogatepass")) for p in parts[at : at + _SLICE]]), np.uint8).reshape(-1, SIGNS // 8)
        words = raw.view(">u8").astype(np.uint64)
        total[:WIDE] += mix(words[:, :1] ^ mix(words[:, 1:] + _LANE)).sum(axis=0, dtype=np.uint64)
        ones = np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
        total[WIDE:] += (2 * ones - len(raw)).astype(np.uint64)
    return total


def insert(print_: np.ndarray, paragraph: str) -> np.ndarray:
    return print_ + vector_sum([paragraph])


def delete(print_: np.ndarray, paragraph: str) -> np.ndarray:
    return print_ - vector_sum([paragraph])


def fingerprint(text: str | None) -> np.ndarray:
    return vector_sum(paragraphs(text))


def as_hex(print_: np.ndarray) -> str:
    return print_[:WIDE].astype(">u8").tobytes().hex() + print_[WIDE:].astype(np.uint32).astype(">u4").tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    raw = bytes.fromhex(text)
    signs = np.frombuffer(raw, ">i4", SIGNS, 8 * WIDE).astype(np.int64).astype(np.uint64)
    return np.concatenate([np.frombuffer(raw, ">u8", WIDE).astype(np.uint64), signs])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 if all lanes are equal; else 1 - |a-b|^2 / (|a|^2 + |b|^2) over the
    sign lanes, clipped to 0 and the number below 1."""
    if (a == b).all():
        return 1.0
    diff, sa, sb = ((x[WIDE:].view(np.int64).astype(np.float64) ** 2).sum() for x in (a - b, a, b))
    return float(min(np.nextafter(1.0, 0.0), max(0.0, 1.0 - diff / (sa + sb)))) if sa + sb else 0.0


def edited(text: str, other: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def add_fingerprint(df: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the hex fingerprint of ``text_col``."""

    def run(batches):
        for batch in batches:
            made = pa.array([as_hex(fingerprint(t.as_py())) for t in batch.column(text_col)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, out])

    return df.mapInArrow(run, df.select("*", F.lit("").alias(out)).schema)


def _dealt_in_order(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(slice, id, text, own) with each slice of the id order in one partition,
    sorted, followed by the first row of the next slice (own = false); the
    last slice is followed by the very first row."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = 4 * parts  # several per partition, so that hashing them to partitions evens out
    # NULL ids sort first, as in ascending order
    rows = df.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("double"), F.lit(float("-inf"))).alias("place")
    )
    edges = rows.filter("id is not null").approxQuantile("place", [i / slices for i in range(1, slices)], max(0.1 / slices, 1e-4))
    splits = [float("-inf"), *sorted({0.0, *edges}), float("inf")]  # at least one edge
    cut = Bucketizer(splits=splits, inputCol="place", outputCol="slice").transform(rows).drop("place")
    cut = cut.select(F.col("slice").cast("int").alias("slice"), "id", "text", F.xxhash64("text").alias("tie"))
    # one row per slice: bounded by the shuffle partitions, so are the window and the broadcast
    firsts = cut.groupBy("slice").agg(F.min(F.struct("id", "tie")).alias("low"))
    ring = Window.orderBy("slice")
    last = firsts.agg(F.max("slice").alias("last"))
    firsts = firsts.crossJoin(F.broadcast(last)).select("slice", "low", F.coalesce(F.lag("slice").over(ring), "last").alias("before"))
    led = cut.join(F.broadcast(firsts), "slice")
    leads = F.col("id").eqNullSafe(F.col("low.id")) & (F.col("tie") == F.col("low.tie"))
    at = F.struct(F.col("slice"), F.lit(True).alias("own"))
    copies = F.when(leads, F.array(at, F.struct(F.col("before").alias("slice"), F.lit(False).alias("own")))).otherwise(F.array(at))
    return (
        led.select("id", "text", "tie", F.explode(copies).alias("at"))
        .select("at.slice", "id", "text", "tie", "at.own")
        .repartition(parts, "slice")
        .sortWithinPartitions("slice", F.desc("own"), "id", "tie")
        .select("slice", "id", "text", "own")
    )


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_chars, edited (the edited text's digest is left
    to the caller), fingerprint, edited_fingerprint, near_edited, near_next.
    The next document follows in ascending id; equal ids are ordered by a hash
    of the text.  Rows are range-dealt once, sorted, and streamed: a task holds
    two documents at a time beside its Arrow batch."""

    def run(batches):
        waiting = None  # (slice, id, text, fingerprint)
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for cell, key, text, own in zip(*(batch.column(k).to_pylist() for k in ("slice", "id", "text", "own")), strict=True):
                text = text or ""
                if not own and (waiting is None or waiting[0] != cell):
                    continue  # a further equal copy of the row that follows the slice
                print_ = fingerprint(text)
                if waiting is not None:
                    _, key0, text0, print0 = waiting
                    new = edited(text0, text)
                    after = fingerprint(new)
                    out.append((key0, len(text0), new, as_hex(print0), as_hex(after), likeness(print0, after), likeness(print0, print_)))
                    size += len(new)
                waiting = (cell, key, text, print_) if own else None
                if size > 4 << 20:
                    yield _rows(id_col, out)
                    out, size = [], 0
        if waiting is not None:
            raise ValueError("a slice of the id order lacks the row that follows it")
        if out:
            yield _rows(id_col, out)

    if id_col in _MADE:
        raise ValueError(f"column {id_col} is made here; rename it first")
    kinds = "n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    whole = df.withColumn(id_col, F.col(id_col).cast("long"))
    return _dealt_in_order(whole, id_col, text_col).mapInArrow(run, f"`{id_col}` long, {kinds}")


_MADE = ("n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _rows(id_col: str, out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [id_col, *_MADE])


@query("op8_multiset_fingerprints")
def op8_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    made = edited_fingerprints(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
