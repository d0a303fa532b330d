"""Language-model scoring with sharded Elias-Fano bigram tries.

The model interpolates bigrams with the add-one unigram model:

    P(w | v) = (c(v, w) - D) / c(v) + mass(v) * (c(w) + 1) / (N + V + 1)

with the three modified Kneser-Ney discounts D and mass(v) the discounts given
up by v's successors.  The discounts come from the corpus's counts of counts,
so scores do not depend on how it is dealt.  The first token of a text follows
the end token; an unknown context falls back to the unigrams.

1. Words.  Blocks of documents send their distinct words' hashes with their
   training counts to buckets of the hash space.  A bucket sums them, ranks the
   words that occur in training, and replies with (rank, count).  Ranks plus
   the buckets' offsets are word ids in hash order.
2. Bigrams.  Blocks send their distinct (context, successor) ids with training
   counts to shards.  A shard builds a trie of its part: contexts, pointers
   and successors are Elias-Fano sequences (successors made monotone by adding
   the last value of the context before), all in memory-mapped files of the
   task's scratch folder.  A successor's level value is its discount class and
   its relative frequency, quantised on a logarithmic scale to 16 bits (counts
   below ``EXACT`` are kept as they are); a context has the number of its
   successors in each class.  Each block's bigrams are then looked up by a
   successor search relative to their context, and the codes returned.
3. Scores.  Each shard's counts of counts (four numbers) give the discounts
   once for all; blocks put counts, codes and discounts together and sum
   log10 P per text.  A context's mass is exact and above 0, however frequent
   the context is.

Contexts are dealt to shards by hash.  A context with more than a quarter of a
shard's share of all tokens is split into pieces by its successors; a block
asks all pieces for their part of the mass.  There are two buckets of words and two shards
for every block, so memory per task does not follow the corpus.  Nothing passes
through the driver but two numbers per bucket and four per shard.  Counts cover every training text, so what moves
grows with the corpus.  Words are told apart by 64-bit hashes.

Defined cases: NULL and empty texts are one end token; texts are scored whole;
repeated rows count and score each; without training rows N = V = 0 and every
probability is 1, in all other cases it is above 0; an empty table gives an empty result.  Extra columns are
carried along, but one named like an output column is replaced.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from . import blocks as B
from .catalog import query
from .eliasfano import EliasFano
from .language import remainder
from .words import Words, mix

_END = np.uint64(0x5BD1E995A1B2C3D4)
_UNKNOWN = np.uint32(0xFFFFFFFF)

#: Counts below are codes themselves (0: not seen); above, code EXACT + k is
#: the count EXACT * STEP ** k.
EXACT, STEP = 2048, 1.0005

OUTPUT = [
    T.StructField(n, t)
    for n, t in (
        ("n_tokens", T.LongType()),
        ("n_known", T.LongType()),
        ("train_tokens", T.LongType()),
        ("base_score", T.DoubleType()),
        ("score", T.DoubleType()),
    )
]


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, byte planes apart: upper planes are mostly 0."""
    planes = (np.ascontiguousarray(np.ascontiguousarray(a).reshape(-1, 1).view(np.uint8).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _plane(raw: bytes, kind: type, n: int, at: int = 0) -> np.ndarray:
    """``n`` numbers of an array that ``_squeeze`` put at byte ``at``."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


class _Tokens:
    """Token sequence of a batch of texts: each text's words, then an end.

    ``hashes``: distinct tokens, ascending; ``of``: each token's index there;
    ``before``: the index of the token before it; ``doc``: its text."""

    def __init__(self, texts, trained: np.ndarray):
        words = Words(texts, lower=True)
        n_docs = len(words.count)
        self.doc = np.repeat(np.arange(n_docs), words.count + 1)
        whole = np.full(len(self.doc), _END)
        whole[np.arange(len(words.hash)) + words.doc()] = words.hash
        self.hashes, self.of = np.unique(whole, return_inverse=True)
        end = np.searchsorted(self.hashes, _END)
        self.before = np.concatenate([[end], self.of[:-1]])[: len(self.of)]
        self.trained, self.texts = trained[self.doc], n_docs
        self.counts = np.bincount(self.of[self.trained], minlength=len(self.hashes))


def _known(docs: pa.Table, text_col: str, train_col: str) -> _Tokens:
    trained = docs.column(train_col).to_numpy(zero_copy_only=False)
    return _Tokens(docs.column(text_col), np.array([bool(x) for x in trained], bool))


# -- 1. words ------------------------------------------------------------------


def _ask_words(text_col: str, train_col: str, buckets: int):
    def keys_of(docs: pa.Table):
        t = _known(docs, text_col, train_col)
        edges = B.bucket_edges(t.hashes, buckets)
        return [
            (b, B.pack_sorted(t.hashes[i:j]) + _squeeze(t.counts[i:j].astype(np.uint32)))
            for b in np.flatnonzero(np.diff(edges)).tolist()
            for i, j in [(edges[b], edges[b + 1])]
        ]

    return keys_of


def _rank_words(_: int, payloads: list[bytes]) -> list[bytes]:
    """Header (known words, their training count), then ranks and counts."""
    parts = []
    for p in payloads:
        h, at = B.unpack_sorted(p)
        parts.append((h, _plane(_expand(p[at:]), np.uint32, len(h))))
    words, of = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    total = np.bincount(of, weights=np.concatenate([c for _, c in parts]), minlength=len(words)).astype(np.int64)
    rank = np.where(total > 0, np.cumsum(total > 0) - 1, _UNKNOWN).astype(np.uint32)
    head = int((total > 0).sum()).to_bytes(8, "big") + int(total.sum()).to_bytes(8, "big")
    out, at = [], 0
    for h, _ in parts:
        own = of[at : at + len(h)]
        at += len(h)
        out.append(head + _squeeze(rank[own], total[own].astype(np.uint64)))
    return out


class _Vocabulary:
    """What the word buckets say about a block's distinct tokens."""

    def __init__(self, t: _Tokens, replies: dict[int, bytes], buckets: int, offsets: np.ndarray):
        edges = B.bucket_edges(t.hashes, buckets)
        self.id, self.count = np.full(len(t.hashes), -1, np.int64), np.zeros(len(t.hashes), np.int64)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            i, j = int(edges[b]), int(edges[b + 1])
            raw = _expand(replies[b][16:])
            rank = _plane(raw, np.uint32, j - i)
            self.count[i:j] = _plane(raw, np.uint64, j - i, 4 * (j - i))
            self.id[i:j] = np.where(rank == _UNKNOWN, -1, rank.astype(np.int64) + offsets[b])


# -- 2. bigrams ----------------------------------------------------------------


class _Bigrams:
    """A block's distinct bigrams of known words, dealt to shards.

    Per shard: its context entries, and its pairs in (context, successor) order."""

    def __init__(self, t: _Tokens, v: _Vocabulary, shards: int, total: int):
        size = len(t.hashes)
        self.valid = (v.id[t.before] >= 0) & (v.id[t.of] >= 0)
        keys, self.pair_of = np.unique(t.before[self.valid] * size + t.of[self.valid], return_inverse=True)
        self.first, then = np.divmod(keys, max(size, 1))
        first = self.first
        self.counts = np.bincount(self.pair_of[t.trained[self.valid]], minlength=len(keys))
        context, successor = v.id[first], v.id[then]
        # pieces of frequent contexts, in proportion to their share of all tokens
        pieces = np.minimum(shards, 1 + (v.count * 4 * shards) // max(total, 1))
        shard = _shard_of(context, mix(successor.astype(np.uint64)) % pieces[first].astype(np.uint64), shards)
        self.order = np.argsort(shard, kind="stable")
        # the mass of every known context is needed, also before unknown words, from all its pieces
        own = np.unique(t.before[v.id[t.before] >= 0])
        extra = np.repeat(own, pieces[own])
        piece = np.arange(len(extra)) - np.repeat(np.cumsum(pieces[own]) - pieces[own], pieces[own])
        extra_shard = _shard_of(v.id[extra], piece.astype(np.uint64), shards)
        entries = np.unique(np.concatenate([shard * size + first, extra_shard * size + extra])) if size else np.empty(0, np.int64)
        self.entry_shard, self.entry = np.divmod(entries, max(size, 1))
        n = np.bincount(np.searchsorted(entries, shard * size + first), minlength=len(entries))
        self.shards = []
        s = shard[self.order]
        for k in np.unique(self.entry_shard).tolist():
            a, b = np.searchsorted(self.entry_shard, [k, k + 1])
            i, j = np.searchsorted(s, [k, k + 1])
            pairs = self.order[i:j]
            self.shards.append((k, slice(a, b), pairs, (v.id[self.entry[a:b]], n[a:b], successor[pairs], self.counts[pairs])))


def _shard_of(context: np.ndarray, piece: np.ndarray, shards: int) -> np.ndarray:
    return (mix(context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + piece) % np.uint64(shards)).astype(np.int64)


def _pack_pairs(context, n, successor, counts) -> bytes:
    head = B.pack_sorted(context.astype(np.uint64))
    width = max(1, (int(successor.max()).bit_length() + 7) // 8) if len(successor) else 1
    body = successor.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    rest = _squeeze(n.astype(np.uint32), counts.astype(np.uint32))
    return head + bytes([width]) + len(successor).to_bytes(4, "little") + body.tobytes() + rest


def _unpack_pairs(data: bytes):
    context, at = B.unpack_sorted(data)
    width, m = data[at], int.from_bytes(data[at + 1 : at + 5], "little")
    wide = np.zeros((m, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, m * width, at + 5).reshape(m, width)
    raw, k = _expand(data[at + 5 + m * width :]), len(context)
    n, counts = _plane(raw, np.uint32, k), _plane(raw, np.uint32, m, 4 * k)
    return context.astype(np.int64), n.astype(np.int64), wide.view("<u8").ravel().astype(np.int64), counts.astype(np.int64)


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many are 1, 2, 3 and 4."""
    return np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    n = [0, *(int(x) for x in n)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return np.array([min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k * 0.5, 0.05 * k), 0.95 * k) for k in (1, 2, 3)])


def encode(count: np.ndarray) -> np.ndarray:
    large = EXACT + np.rint(np.log(np.maximum(count, EXACT) / EXACT) / np.log(STEP))
    return np.where(count < EXACT, count, large).astype(np.uint16)


def decode(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.float64)
    return np.where(code < EXACT, code, EXACT * STEP ** (code - EXACT))


class Trie:
    """Contexts -> successors with quantised counts, and the number of
    successors of each context with count 1, 2 and more.

    ``context``, ``successor``, ``count``: distinct pairs in order, counts > 0."""

    def __init__(self, folder: str, context, successor, count):
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        starts = np.flatnonzero(new)
        own = context[starts]
        ends = np.append(starts[1:], len(context))
        last = np.cumsum(successor[ends - 1]) if len(own) else np.empty(0, np.int64)
        base = last - successor[ends - 1] if len(own) else last
        self.contexts = EliasFano.build(own).save(folder, "contexts")
        self.pointers = EliasFano.build(np.append(starts, len(context))).save(folder, "pointers")
        self.bases = EliasFano.build(base).save(folder, "bases")
        self.successors = EliasFano.build(successor + np.repeat(base, ends - starts)).save(folder, "successors")
        self.codes = self._mapped(folder, "codes", encode(count))
        kinds = np.stack([count == 1, count == 2, count > 2]).astype(np.uint32)
        self.kinds = self._mapped(folder, "kinds", np.add.reduceat(kinds, starts, axis=1) if len(own) else kinds)

    @staticmethod
    def _mapped(folder: str, name: str, values: np.ndarray) -> np.ndarray:
        np.save(f"{folder}/{name}.npy", values)
        return np.load(f"{folder}/{name}.npy", mmap_mode="r") if values.size else values

    def lookup(self, context: np.ndarray, n: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Successors of each context by class (3 rows), and the code of each of
        its ``n`` successors; 0 where the trie has none."""
        kinds, codes = np.zeros((3, len(context)), np.uint32), np.zeros(len(successor), np.uint16)
        at = self.contexts.next_geq(context)
        there = np.flatnonzero(at < self.contexts.n)
        there = there[self.contexts.get(at[there]) == context[there]]
        if not len(there):
            return kinds, codes
        kinds[:, there] = self.kinds[:, at[there]]
        begin, end, base = (np.zeros(len(context), np.int64) for _ in range(3))
        begin[there], end[there], base[there] = self.pointers.get(at[there]), self.pointers.get(at[there] + 1), self.bases.get(at[there])
        of = np.repeat(np.arange(len(context)), n)
        place = np.maximum(self.successors.next_geq(successor + base[of]), begin[of])
        inside = np.flatnonzero(place < end[of])
        found = inside[self.successors.get(place[inside]) == successor[inside] + base[of[inside]]]
        codes[found] = self.codes[place[found]]
        return kinds, codes


def _search(_: int, payloads: list[bytes]) -> list[bytes]:
    """One shard: builds its trie from all blocks' pairs and answers each block.
    A reply begins with the shard's counts of counts."""
    asked = [_unpack_pairs(p) for p in payloads]
    context = np.concatenate([np.repeat(c, n) for c, n, _, _ in asked])
    successor, count = (np.concatenate([a[k] for a in asked]) for k in (2, 3))
    seen = count > 0
    context, successor, count = context[seen], successor[seen], count[seen]
    if max(context.max(initial=0), successor.max(initial=0)) < 1 << 31:
        order = np.argsort(context << 32 | successor, kind="stable")  # every block's pairs ascend already
    else:
        order = np.lexsort((successor, context))
    context, successor, count = (x[order] for x in (context, successor, count))
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (successor[1:] != successor[:-1])
    first = np.flatnonzero(new)
    count = np.add.reduceat(count, first) if len(first) else count
    head = counts_of_counts(count).astype(">u8").tobytes()
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(folder, context[first], successor[first], count)
        out = [head + _squeeze(*trie.lookup(c, n, s)) for c, n, s, _ in asked]
        del trie
    return out


# -- 3. scores -----------------------------------------------------------------


def score_texts(df: DataFrame, train_col: str, text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """``df`` with n_tokens, n_known, train_tokens, base_score and score; the
    model learns from the rows whose ``train_col`` is true."""
    df = B.make_room(df, [f.name for f in OUTPUT], text_col, train_col)
    buckets = buckets or 4 * B.bucket_count_of(df, text_col)
    packed = B.pack(df, keep=False)
    ranked = cut_lineage(B.answer(B.ask(packed, _ask_words(text_col, train_col, buckets)), _rank_words))

    number = lambda at: F.conv(F.hex(F.substring("payload", at, 8)), 16, 10).cast("long")
    sizes = ranked.groupBy("bucket").agg(F.max(number(1)).alias("known"), F.max(number(9)).alias("tokens")).collect()  # one row per bucket
    known = np.zeros(buckets + 1, np.int64)
    for r in sizes:
        known[r["bucket"] + 1] = r["known"]
    offsets, total, distinct = np.cumsum(known), sum(r["tokens"] for r in sizes), int(known.sum())

    def dealt(docs: pa.Table, replies: dict[int, bytes]):
        t = _known(docs, text_col, train_col)
        v = _Vocabulary(t, replies, buckets, offsets)
        return t, v, _Bigrams(t, v, buckets, total)

    def pairs_of(docs: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        name = replies.pop(-1)
        _, _, g = dealt(docs, replies)
        return pa.table(
            {
                "bucket": pa.array([k for k, *_ in g.shards], pa.int32()),
                "block": pa.array([name] * len(g.shards), pa.int64()),
                "payload": pa.array([_pack_pairs(*parts) for *_, parts in g.shards], pa.binary()),
            }
        )

    def finish(docs: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        t, v, g = dealt(docs, {b: p for b, p in replies.items() if b < buckets})
        unigram = (v.count + 1) / (total + distinct + 1)
        given, count = np.zeros(len(t.hashes)), np.zeros(len(g.counts))
        for k, entries, pairs, _ in g.shards:
            raw = _expand(replies[buckets + k][32:])
            n = entries.stop - entries.start
            np.add.at(given, g.entry[entries], off @ _plane(raw, np.uint32, 3 * n).reshape(3, n))
            count[pairs] = decode(_plane(raw, np.uint16, len(pairs), 12 * n))
        of_context = np.maximum(v.count, 1)
        mass = given / of_context
        alpha = (count - np.where(count > 0, off[np.clip(count, 1, 3).astype(np.int64) - 1], 0.0)) / of_context[g.first]
        weight = np.where(v.count > 0, mass, 1.0)  # an unknown context says nothing
        p = weight[t.before] * unigram[t.of]
        p[g.valid] += alpha[g.pair_of]
        by_doc = lambda x: np.bincount(t.doc, weights=x, minlength=t.texts)
        made = [
            pa.array(np.bincount(t.doc, minlength=t.texts), pa.int64()),
            pa.array(by_doc(v.count[t.of] > 0).astype(np.int64), pa.int64()),
            pa.array(np.full(t.texts, total), pa.int64()),
            pa.array(by_doc(np.log10(unigram)[t.of])),
            pa.array(by_doc(np.log10(np.minimum(p, 1.0)))),
        ]
        for field, values in zip(OUTPUT, made, strict=True):
            docs = docs.append_column(field.name, values)
        return docs

    coded = cut_lineage(B.answer(B.ask_again(packed, ranked, pairs_of), _search))
    four = [F.max(number(1 + 8 * k)).alias(f"n{k}") for k in range(4)]
    seen = coded.groupBy("bucket").agg(*four).agg(*[F.sum(f"n{k}") for k in range(4)]).first()
    off = discounts(np.array([x or 0 for x in seen], np.int64))
    both = ranked.unionByName(coded.withColumn("bucket", F.col("bucket") + buckets))
    return B.use(packed, both, finish, T.StructType(df.schema.fields + OUTPUT))


@query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents."""
    rest = remainder("doc_id", 7)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), F.coalesce(rest != 2, F.lit(False)).alias("trained"), "text"
    )
    return score_texts(docs, "trained").drop("text", "trained")
