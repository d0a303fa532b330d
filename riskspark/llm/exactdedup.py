"""Exact dedup against a history, by a sharded minimal perfect hash.

Texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]``
has become one space.  The digest is the SHA-256 of that form.

* ``build_index``: the history's distinct digests, dealt to shards by a hash
  of them; each shard is one row with a minimal perfect hash whose slots
  hold the full digest, the winner's locator (id and place) and the row count.
* ``admit``: a batch's distinct digests look their slots up.  The digest in the
  slot is compared byte by byte: members update winner and count, nonmembers
  are grouped separately and get a perfect hash of their own in the same shard.
* ``resolve``: every row looks its digest up and learns who stays.  A shard
  that many rows ask (a group of copies with a third of all rows) is handed out
  in several copies, one for every ``LOOKUPS`` rows, so no task gets the group.

Shards follow the number of rows, so neither memory nor a task's share grows
with the corpus; nothing but row counts reaches the driver.

Defined cases: a NULL text is empty; a blank text is one space, which differs
from the empty one.  Of equal texts the smallest id stays; NULL ids come last;
of rows with the same id and text exactly one stays (the first place).  An empty
table gives no rows, an empty history makes every digest a nonmember.  A very
long text is hashed where it is read and not kept.  Columns named in ``carry``
come back, and one that has the name of a result column is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from . import blocks as B
from . import perfecthash
from .catalog import query

#: Distinct digests of a shard (expected, at most) and rows that one copy of it serves.
PER_SHARD = 2048
LOOKUPS = 2560

RESULT = ["keep_id", "group_size", "kept", "digest"]
_INDEX = "shard long, sizes array<long>, bits binary, slots binary, new_sizes array<long>, new_bits binary, new_slots binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


def entries(rows: DataFrame) -> DataFrame:
    """Distinct digests of rows (id, place, digest): the winner's locator and
    the number of rows.  Partially aggregated, so copies meet few at a time."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("place"))).alias("first")
    return rows.groupBy("digest").agg(first, F.count("*").alias("n")).select("digest", F.col("first.id").alias("id"), F.col("first.place").alias("place"), "n")


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1) if len(column) else np.empty((0, 32), np.uint8)


def _hashed(found: pa.Table) -> tuple[list[int], bytes, bytes]:
    made, slots = perfecthash.build(_bytes(found.column("digest")))
    by_slot = found.take(pa.array(np.argsort(slots))).combine_chunks()
    batches = by_slot.to_batches() or [pa.RecordBatch.from_pylist([], schema=found.schema)]
    return made.sizes.tolist(), made.bits.tobytes(), B.dump(batches[0])


def _slots_of(sizes: pa.Scalar, bits: pa.Scalar, slots: pa.Scalar, digests: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """The slots and, for each digest, the slot that holds its very bytes or -1."""
    held = B.load(slots.as_buffer())
    own = _bytes(held.column("digest"))
    at = perfecthash.lookup(perfecthash.PerfectHash(np.array(sizes.as_py(), np.int64), np.frombuffer(bits.as_py(), np.uint8)), digests)
    asked = np.flatnonzero(at >= 0)
    differs = (own[at[asked]] != digests[asked]).any(axis=1)
    at[asked[differs]] = -1
    return held, at


def _index_row(shard: int, old: tuple, new: tuple) -> pa.Table:
    values = [shard, *old, *new]
    kinds = [pa.int64(), *[pa.list_(pa.int64()), pa.binary(), pa.binary()] * 2]
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["shard", "sizes", "bits", "slots", "new_sizes", "new_bits", "new_slots"])


def build_index(found: DataFrame, shards: int) -> DataFrame:
    """One row per shard for distinct ``found`` (digest, id, place, n)."""

    def run(group: pa.Table) -> pa.Table:
        shard, rows = group.column("shard")[0].as_py(), group.drop_columns(["shard"])
        return _index_row(shard, _hashed(rows), _hashed(rows.slice(0, 0)))

    return found.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(run, _INDEX)


def _earlier(a: pa.Table, b: pa.Table) -> np.ndarray:
    """Rows of ``a`` whose locator comes before that of the same row of ``b``:
    NULL ids last, then ids, then places."""
    ai, bi = a.column("id").combine_chunks(), b.column("id").combine_chunks()
    a_null, b_null = (x.is_null().to_numpy(zero_copy_only=False) for x in (ai, bi))
    less = pc.fill_null(pc.less(ai, bi), False).to_numpy(zero_copy_only=False)
    same = (a_null & b_null) | pc.fill_null(pc.equal(ai, bi), False).to_numpy(zero_copy_only=False)
    return (b_null & ~a_null) | less | (same & (a.column("place").to_numpy() < b.column("place").to_numpy()))


def admit(index: DataFrame, found: DataFrame, shards: int) -> DataFrame:
    """The index after a batch's distinct digests ``found``: members change
    their slot's winner and count, the others fill the shard's second hash."""

    def run(old: pa.Table, new: pa.Table) -> pa.Table:
        if not new.num_rows:
            return old
        shard, new = new.column("shard")[0].as_py(), new.drop_columns(["shard"]).combine_chunks()
        if not old.num_rows:
            return _index_row(shard, _hashed(new.slice(0, 0)), _hashed(new))
        held, at = _slots_of(*(old.column(c)[0] for c in ("sizes", "bits", "slots")), _bytes(new.column("digest")))
        members, slots = np.flatnonzero(at >= 0), at[at >= 0]
        n = held.column("n").to_numpy().copy()
        n[slots] += new.column("n").to_numpy()[members]
        joined = new.take(pa.array(members)).combine_chunks()
        wins = _earlier(joined, held.take(pa.array(slots)).combine_chunks())
        # rows of held, or past its end the batch's row that takes the slot
        source = np.arange(held.num_rows)
        source[slots[wins]] = held.num_rows + np.flatnonzero(wins)
        both = pa.concat_tables([held, joined.cast(held.schema)]).combine_chunks().take(pa.array(source))
        both = both.set_column(both.column_names.index("n"), "n", pa.array(n, pa.int64())).combine_chunks()
        rest = new.take(pa.array(np.flatnonzero(at < 0)))
        kept = (old.column("sizes")[0].as_py(), old.column("bits")[0].as_py(), B.dump(both.to_batches()[0]))
        return _index_row(shard, kept, _hashed(rest))

    return index.groupBy("shard").cogroup(found.withColumn("shard", _shard(shards)).groupBy("shard")).applyInArrow(run, _INDEX)


def resolve(rows: DataFrame, index: DataFrame, shards: int, lookups: int = LOOKUPS) -> DataFrame:
    """``rows`` (id, place, digest, own) with keep_id, group_size and kept."""
    rows = rows.withColumn("shard", _shard(shards))
    heavy = rows.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(lookups)).alias("copies")).filter("copies > 1")
    heavy = cut_lineage(heavy)  # small: at most a row for every ``lookups`` rows
    copies = F.coalesce(F.col("copies"), F.lit(1)).cast("long")
    asked = rows.join(heavy, "shard", "left").withColumn("copy", F.pmod(F.xxhash64("place"), copies)).drop("copies")
    served = index.join(heavy, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("copies")
    schema = T.StructType([f for f in rows.schema.fields if f.name not in ("shard", "place")]).add("keep_id", rows.schema["id"].dataType).add("group_size", "long").add("kept", "boolean")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns(["shard", "copy"])
        if not left.num_rows:
            return left.drop_columns(["place"]).append_column("keep_id", left.column("id")).append_column("group_size", pa.array([], pa.int64())).append_column("kept", pa.array([], pa.bool_()))
        digests = _bytes(left.column("digest"))
        old, at = _slots_of(*(right.column(c)[0] for c in ("sizes", "bits", "slots")), digests)
        new, at_new = _slots_of(*(right.column(c)[0] for c in ("new_sizes", "new_bits", "new_slots")), digests)
        if ((at < 0) & (at_new < 0)).any():
            raise ValueError("a digest that is in no slot")
        place = np.where(at >= 0, at, old.num_rows + at_new)
        won = pa.concat_tables([old, new.cast(old.schema)]).combine_chunks().take(pa.array(place))
        stays = won.column("place").to_numpy() == left.column("place").to_numpy()
        return left.drop_columns(["place"]).append_column("keep_id", won.column("id")).append_column("group_size", won.column("n")).append_column("kept", pa.array(stays))

    return asked.groupBy("shard", "copy").cogroup(served.groupBy("shard", "copy")).applyInArrow(run, schema)


def deduplicate(
    df: DataFrame, history: Column, text_col: str = "text", id_col: str = "doc_id", carry: Sequence[str] = (), per_shard: int = PER_SHARD, lookups: int = LOOKUPS
) -> DataFrame:
    """One row per row of ``df``: the ``carry`` columns and the id, then
    keep_id, group_size, kept and digest (binary).  Rows where ``history``
    holds make the index; all others are the batch that is looked up in it."""
    if bad := [c for c in (*carry, id_col) if c.lower() in RESULT]:
        raise ValueError(f"columns {bad} have names of result columns")
    own = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("boolean")
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.monotonically_increasing_id().alias("place"),
        F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256)).alias("digest"),
        F.coalesce(history, F.lit(False)).alias("historical"),
        own.alias("own"),
    )
    rows = cut_lineage(rows)  # narrow, and fixes each row's place
    shards = max(1, -(-rows.count() // per_shard))
    old, new = (entries(rows.filter(c)) for c in ("historical", "not historical"))
    index = cut_lineage(admit(build_index(old, shards), new, shards))
    done = resolve(rows.drop("historical"), index, shards, lookups)
    return done.select(*[F.col(f"own.`{c}`").alias(c) for c in carry], F.col("id").alias(id_col), *RESULT)


SQL = r"""
SELECT doc_id,
  min(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept,
  sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
WINDOW same AS (PARTITION BY norm)
"""


@query("op13_exact_dedup", SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; history: those whose crc32(doc_id as text) is even."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    history = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return deduplicate(docs, history).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
