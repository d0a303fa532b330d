"""Blocks of documents and block-wise lookups.

A *block* is one row holding a few megabytes of whole documents as a
compressed Arrow batch.  Counting n-grams row by row would shuffle one row per
token; here each block asks about its *distinct* keys at once, packed into one
binary value per hash bucket:

    blocks --ask--> (bucket, block, payload) --answer, by bucket-->
        (block, bucket, reply) --use, with the block itself--> documents

Every distinct key reaches a bucket at most once per block, so a key held by a
third of all rows weighs as much there as any other.  Buckets are slices of
the hash space whose number follows the number of blocks, so a task's memory
does not grow with the corpus.  Nothing passes through the driver.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.session import cut_lineage

#: glibc keeps freed heap pages unless asked; other C libraries have no such call.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

#: Raw bytes of documents in a block; a longer document has a block of its own.
BLOCK_BYTES = 8 << 20

_BLOCKS = "block long, docs binary"
_ASKED = "bucket int, block long, payload binary"
_REPLIES = "block long, bucket int, payload binary"


def dump(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def tidy() -> None:
    """Hands freed memory back, Arrow's and the C library's: idle Python workers
    stay alive, and several of them share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def load(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all().combine_chunks()


def cut(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Halves of a batch until each has at most ``most`` bytes or one row, so
    that a task's memory does not follow the rows of an Arrow batch."""
    if batch.num_rows <= 1 or batch.nbytes <= most:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from cut(batch.slice(0, half), most)
        yield from cut(batch.slice(half), most)


def _packer(most: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def emit() -> pa.RecordBatch:
            nonlocal held, size, made
            blob = dump(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            # place and content: a block that is made again has its name only if it is the same
            name = xxhash.xxh64_intdigest(blob, seed=place << 20 | made) >> 1
            held, size, made = [], 0, made + 1
            tidy()
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([blob], pa.binary())], ["block", "docs"])

        for batch in batches:
            for part in cut(batch, most // 4):
                if not part.num_rows:
                    continue
                if held and size + part.nbytes > most:
                    yield emit()
                held.append(part)
                size += part.nbytes
        if held:
            yield emit()

    return pack


def pack(df: DataFrame, block_bytes: int = BLOCK_BYTES, keep: bool = True, first: Callable | None = None) -> DataFrame:
    """Rows of ``df`` as blocks (block, docs); whole rows, any columns.
    ``first`` changes the record batches before, in the same Python worker.

    ``keep`` checkpoints the blocks.  Without it they are made again for each
    use; a block's name holds a digest of its content, so a block that comes out
    otherwise finds no replies and ``use`` fails instead of mixing them up."""
    packer = _packer(block_bytes)
    blocks = df.mapInArrow((lambda batches: packer(first(batches))) if first else packer, _BLOCKS)
    return cut_lineage(blocks) if keep else blocks


def bucket_count(blocks: DataFrame) -> int:
    """Buckets for a lookup: one for every two blocks, so that a bucket's keys
    take about the memory of two blocks' keys at any corpus size."""
    return max(1, -(-blocks.count() // 2))


def bucket_count_of(df: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> int:
    """``bucket_count`` of the blocks of ``df``, from the texts' bytes."""
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    return max(1, -(-size // (2 * block_bytes)))


def ask(blocks: DataFrame, keys_of: Callable[[pa.Table], list[tuple[int, bytes]]]) -> DataFrame:
    """Runs ``keys_of`` on each block's documents; it returns (bucket, payload)
    pairs for the buckets that have keys."""
    return blocks.mapInArrow(_asker(keys_of), _ASKED)


def ask_rows(df: DataFrame, keys_of: Callable[[pa.Table], list[tuple[int, bytes]]], block_bytes: int = BLOCK_BYTES, first: Callable | None = None) -> DataFrame:
    """``ask(pack(df, keep=False, first=first), keys_of)`` in one Python worker
    per task instead of two, which halves the workers' memory."""
    packer, asker = _packer(block_bytes), _asker(keys_of)
    return df.mapInArrow(lambda batches: asker(packer(first(batches) if first else batches)), _ASKED)


def _asker(keys_of: Callable[[pa.Table], list[tuple[int, bytes]]]):
    def run(batches):
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("docs"), strict=True):
                asked = keys_of(load(blob.as_buffer()))
                tidy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _ in asked], pa.int32()),
                        pa.array([block] * len(asked), pa.int64()),
                        pa.array([p for _, p in asked], pa.binary()),
                    ],
                    ["bucket", "block", "payload"],
                )

    return run


def answer(asked: DataFrame, reply_to: Callable[[int, list[bytes]], list[bytes]]) -> DataFrame:
    """``reply_to(bucket, payloads)`` sees one bucket whole and returns a reply
    for each payload, in their order."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        replies = reply_to(bucket, group.column("payload").to_pylist())
        tidy()
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "payload": pa.array(replies, pa.binary())})

    return asked.groupBy("bucket").applyInArrow(run, _REPLIES)


def answer_from(asked: DataFrame, known: DataFrame, reply_to: Callable[[pa.Table, list[bytes]], list[bytes]]) -> DataFrame:
    """Like ``answer``; ``reply_to`` also sees the rows of ``known`` that have
    the same ``bucket``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = reply_to(right, left.column("payload").to_pylist())
        tidy()
        return pa.table({"block": left.column("block"), "bucket": left.column("bucket"), "payload": pa.array(replies, pa.binary())})

    return asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(run, _REPLIES)


def ask_again(blocks: DataFrame, replies: DataFrame, keys_of: Callable[[pa.Table, dict[int, bytes]], pa.Table]) -> DataFrame:
    """A second round: ``keys_of(documents, replies)`` returns the rows
    (bucket, block, payload) to ask; the block's name is reply -1."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = _by_bucket(left, right) | {-1: left.column("block")[0].as_py()}
        tidy()
        return keys_of(load(left.column("docs")[0].as_buffer()), got)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, _ASKED)


def _by_bucket(left: pa.Table, right: pa.Table) -> dict[int, bytes]:
    if not left.num_rows:
        raise ValueError("replies to a block that was made otherwise the second time")
    return dict(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist(), strict=True))


def use(blocks: DataFrame, replies: DataFrame, finish: Callable[[pa.Table, dict[int, bytes]], pa.Table], schema) -> DataFrame:
    """``finish(documents, {bucket: reply})`` for each block with its replies."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        done = finish(load(left.column("docs")[0].as_buffer()), _by_bucket(left, right))
        tidy()
        return done

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def make_room(df: DataFrame, made: list[str], *needed: str) -> DataFrame:
    """``df`` without the columns that the operator makes itself: an extra
    column of that name is replaced.  The operator's own inputs may not be."""
    taken = {m.lower() for m in made}
    if bad := [c for c in needed if c.lower() in taken]:
        raise ValueError(f"input columns {bad} have names of output columns")
    return df.drop(*[c for c in df.columns if c.lower() in taken])


# -- sorted 64-bit keys in a payload ------------------------------------------


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys: count, width, then differences in ``width`` bytes each."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    body = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return len(keys).to_bytes(4, "little") + bytes([width]) + body.tobytes()


def unpack_sorted(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The keys and the position after them."""
    n, width = int.from_bytes(data[at : at + 4], "little"), data[at + 4]
    raw = np.frombuffer(data, np.uint8, n * width, at + 5).reshape(n, width)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = raw
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64), at + 5 + n * width


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, in agreement with ``bucket_edges``."""
    return np.minimum(keys // np.uint64((1 << 64) // buckets), np.uint64(buckets - 1)).astype(np.int32) if buckets > 1 else np.zeros(len(keys), np.int32)


def bucket_edges(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's slice begins and ends in ascending keys: the hash
    space is cut into ``buckets`` equal ranges."""
    # multiples of floor(2^64 / buckets); the last range takes the remainder
    limits = np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets) if buckets > 1 else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, limits), [len(sorted_keys)]]).astype(np.int64)
