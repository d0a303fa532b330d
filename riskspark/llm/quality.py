"""Quality classifier: an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted text and predicts each character of a text's
words, joined by single spaces, and the text's end from up to four characters
before it, across word ends (``across``; without it, of each word and its end
from the characters before it inside the word).  Orders below the highest use continuation counts; each order has its own three
discounts from its counts of counts.  All of this is grouping and joining of
gram tables in Spark.  The model is kept in back-off form: (log p, log weight
as a context) per gram, dealt into buckets by the gram's hash.

Scoring is a sharded count join: each block of documents asks the buckets for
its distinct grams and contexts of all orders, but for those that a bitmap of
fixed size shows not to be in the model, and gets the model's numbers for them; a
gram the model does not have is backed off along its contexts.  A
document's perplexity is exp(-mean log p) over its predicted characters.

Words that come again and again cost a model of so few characters little, so
``repeated`` is counted beside it: the share of a text's words that equal one of
the ``NEAR`` words before them.

A document is kept if its perplexity and its repeated share are each at most the
threshold of its language, a high quantile over all trusted documents in that
language times a tolerance.  Languages without trusted documents use the
quantile over all of them.

The model is fitted on at most ``TRAIN_DOCS`` trusted documents (those with the
smallest id hashes); that bound also bounds the broadcast of their ids.
Thresholds cover every trusted document, scores every document.

Defined cases: NULL or blank texts have no perplexity and are not kept; very
long texts are scored whole; repeated rows are scored alike; without any
trusted document there is no threshold and everything with a text is kept; an
empty table gives an empty result.  Extra columns are carried along, but one
named like an output column is replaced.
"""

from __future__ import annotations

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
from .words import Words, mix

ORDER = 5
TRAIN_DOCS = 20_000
#: Raw bytes of a block, and of the part of it whose words are spelled out at
#: once, which takes some twenty times as much memory.
BLOCK_BYTES = 12 << 20
PART_BYTES = 1 << 20
#: Words before a word among which it counts as repeated.
NEAR = 4
QUANTILE = 0.99
TOLERANCE = 1.75
#: Keys over which one language's rows are spread.
SALTS = 64
#: Leading bits of a key that the bitmap of the model's keys goes by (1 MB).
CELL_BITS = 23
#: Binary places of a number in a reply: half a step is 0.000002 of a natural logarithm.
_FRACTION = 18
_BEGIN, _END = "\x02", "\x03"

SCORED = [T.StructField("n_predicted", T.LongType()), T.StructField("log_prob", T.DoubleType()), T.StructField("perplexity", T.DoubleType()), T.StructField("repeated", T.DoubleType())]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit keys in order of appearance, and each key's index there."""
    found = pa.array(keys.view(np.int64)).dictionary_encode()
    return found.dictionary.to_numpy().view(np.uint64), found.indices.to_numpy()


class _Spelled:
    """A batch of texts, spelled with begin and end marks: whole texts with
    ``across``, their distinct words without.

    ``grams``: distinct highest-order grams as code points (n, ORDER);
    ``total(values)``: sum of one value per gram over each text."""

    def __init__(self, texts, across: bool):
        words = Words(texts)
        if across:
            raw = texts.cast(pa.large_binary()).to_pylist()
            own = [b" ".join(t.split()).decode("utf-8", "surrogatepass") for t, n in zip(raw, words.count.tolist(), strict=True) if n]
            self.doc = np.flatnonzero(words.count)
            self.word_of = np.arange(len(own))
        else:
            data = words.data.tobytes()
            _, at, self.word_of = np.unique(words.hash, return_index=True, return_inverse=True)
            own = [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)]
            self.doc = words.doc()
        pad = _BEGIN * (ORDER - 1)
        spelled = "".join([f"{pad}{w}{_END}" for w in own])
        codes = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        firsts = np.cumsum(sizes + ORDER) - (sizes + ORDER)
        self.predicted = sizes + 1
        self.begins = np.cumsum(self.predicted) - self.predicted
        place = np.repeat(firsts + ORDER - 1 - self.begins, self.predicted) + np.arange(self.predicted.sum())
        self.texts, self.repeated = len(words.count), _repeated(words)
        if not len(place):
            self.grams, self.gram_of, self.begins = np.empty((0, ORDER), np.uint32), place, place
            return
        seen = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
        wide, n = codes.astype(np.uint64), len(codes) - ORDER + 1
        # three code points have 63 bits; the hash only tells this batch's grams apart
        key = mix(wide[:n] << np.uint64(42) | wide[1 : n + 1] << np.uint64(21) | wide[2 : n + 2])
        key ^= (wide[3 : n + 3] << np.uint64(21) | wide[4 : n + 4]) * np.uint64(0x9E3779B97F4A7C15)
        keys, self.gram_of = _distinct(key[place - ORDER + 1])
        first = np.empty(len(keys), np.int64)
        first[self.gram_of[::-1]] = place[::-1]
        self.grams = np.ascontiguousarray(seen[first - ORDER + 1])

    def counts(self) -> np.ndarray:
        """How often each gram stands in the texts."""
        weight = np.bincount(self.word_of, minlength=len(self.predicted))
        return np.bincount(self.gram_of, weights=np.repeat(weight, self.predicted), minlength=len(self.grams)).astype(np.int64)

    def total(self, values: np.ndarray) -> np.ndarray:
        if not len(self.begins):
            return np.zeros(self.texts)
        by_word = np.add.reduceat(values[self.gram_of], self.begins)
        return np.bincount(self.doc, weights=by_word[self.word_of], minlength=self.texts)

    def lengths(self) -> np.ndarray:
        return np.bincount(self.doc, weights=self.predicted[self.word_of], minlength=self.texts).astype(np.int64)


def _repeated(words: Words) -> np.ndarray:
    """Share of each text's words that equal one of the ``NEAR`` words before; 0 without words."""
    doc, again = words.doc(), np.zeros(len(words.hash), bool)
    for k in range(1, NEAR + 1):
        again[k:] |= (words.hash[k:] == words.hash[:-k]) & (doc[k:] == doc[:-k])
    return np.bincount(doc, weights=again, minlength=len(words.count)) / np.maximum(words.count, 1)


def gram_keys(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points; the order is part of it."""
    key = np.full(len(codes), codes.shape[1], np.uint64)
    for i in range(codes.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + codes[:, i] + np.uint64(1))
    return key


def _strings(codes: np.ndarray) -> pa.Array:
    """Rows of code points as strings, without a Python object for each."""
    body = np.ascontiguousarray(codes).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    sizes = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(offsets), pa.py_buffer(body))


def gram_counts(df: DataFrame, text_col: str = "text", across: bool = False) -> DataFrame:
    """(gram, n): counts of all highest-order grams, pre-summed per few megabytes of text."""

    def run(batches):
        for batch in (part for whole in batches for part in B.cut(whole, PART_BYTES)):
            found = _Spelled(batch.column(text_col), across)
            yield pa.RecordBatch.from_arrays([_strings(found.grams), pa.array(found.counts(), pa.int64())], ["gram", "n"])
            B.tidy()

    return df.select(text_col).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [k - (k + 1) * y * more / of if of else k * 0.5 for k, of, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(raw, 1)]


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, log_p, log_bow) in back-off form from highest-order counts.

    log_p is the interpolated probability of the gram's last character after
    the others; log_bow is the weight of the lower order after the whole gram.
    The empty context is the gram ''; its log_p is the uniform floor.

    The grams of all orders are the distinct suffixes of the highest-order grams,
    and continuation counts, context totals and discounted shares are one grouping
    or join each for all orders; probabilities are then put together order by
    order, each from its suffix's."""
    counts = cut_lineage(counts)  # read twice below; without this all training texts would be counted twice
    tails = F.transform(F.sequence(F.lit(1), F.lit(order - 1)), lambda k: F.expr("gram").substr(F.lit(order + 1) - k, k))
    lower = counts.select(F.explode(tails).alias("gram")).distinct()
    kept = cut_lineage(counts.unionByName(lower.withColumn("n", F.lit(None).cast("long"))))
    # distinct characters seen before a gram of a lower order
    before = kept.filter(F.length("gram") > 1).groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("seen"))
    level = cut_lineage(kept.join(before, "gram", "left").select("gram", F.coalesce("n", "seen").alias("n"), F.length("gram").alias("k")))
    found = level.groupBy("k").agg(F.count("*").alias("all"), *[F.count_if(F.col("n") == c).alias(f"n{c}") for c in (1, 2, 3, 4)]).collect()
    cuts = {r["k"]: _discounts(r["n1"], r["n2"], r["n3"], r["n4"]) for r in found}  # one row per order
    symbols = next((r["all"] for r in found if r["k"] == 1), 0)
    table_ = F.array(*[F.array(*[F.lit(float(d)) for d in cuts.get(k, [0.0] * 3)]) for k in range(1, order + 1)])
    cut = F.element_at(F.element_at(table_, F.col("k")), F.least(F.col("n"), F.lit(3)).cast("int"))
    parts = level.select("gram", "n", "k", cut.alias("cut"), F.expr("substring(gram, 1, k - 1)").alias("context"))
    contexts = cut_lineage(parts.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("cut")).select("context", "total", (F.col("cut") / F.col("total")).alias("mass")))
    shares = cut_lineage(parts.join(contexts, "context").select("gram", "k", ((F.col("n") - F.col("cut")) / F.col("total")).alias("share"), "mass"))
    p = counts.sparkSession.range(1).select(F.lit("").alias("gram"), F.lit(1.0 / (symbols + 1)).alias("p"))
    found = p
    for k in range(1, order + 1):  # each order from the one below, which has every suffix
        own = shares.filter(F.col("k") == k).withColumn("tail", F.expr("substring(gram, 2)"))
        p = cut_lineage(own.join(p.withColumnsRenamed({"gram": "tail", "p": "lower"}), "tail").select("gram", (F.col("share") + F.col("mass") * F.col("lower")).alias("p")))
        found = found.unionByName(p)
    p = found
    bow = contexts.select(F.col("context").alias("gram"), F.log("mass").alias("log_bow"))
    return p.join(bow, "gram", "full_outer").select("gram", F.log("p").alias("log_p"), "log_bow")


class Model:
    """A trained model: rows (bucket, key, log_p, log_bow), the floor, whether
    contexts run across word ends, and a bitmap of ``2 ** CELL_BITS`` cells that
    says which leading bits its keys have."""

    def __init__(self, rows: DataFrame, buckets: int, floor: float, floor_bow: float, across: bool, cells: bytes):
        self.rows, self.buckets, self.floor, self.floor_bow, self.across, self.cells = rows, buckets, floor, floor_bow, across, cells


def _cells(rows: DataFrame) -> bytes:
    """The bitmap; the driver gets a number per cell in use, ``2 ** CELL_BITS`` at most."""
    used = rows.select(F.shiftrightunsigned("key", 64 - CELL_BITS).cast("int").alias("cell")).distinct().toArrow().column("cell").to_numpy()
    flags = np.zeros(1 << CELL_BITS, bool)
    flags[used] = True
    return np.packbits(flags).tobytes()


def _maybe_known(keys: np.ndarray, cells: bytes) -> np.ndarray:
    """Whether the model may have each key; all it has are among them."""
    cell = (keys >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    return (np.frombuffer(cells, np.uint8)[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)


def train(df: DataFrame, text_col: str = "text", buckets: int | None = None, across: bool = False) -> Model:
    """Fits the model on all rows of ``df``."""
    buckets = buckets or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def key(batches):
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            keys = np.zeros(len(grams), np.uint64)
            for k in range(1, ORDER + 1):
                at = [i for i, g in enumerate(grams) if len(g) == k]
                if at:
                    codes = np.frombuffer("".join([grams[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, k)
                    keys[at] = gram_keys(codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(B.buckets_of(keys, buckets)), pa.array(keys.view(np.int64)), batch.column("log_p"), batch.column("log_bow")],
                ["bucket", "key", "log_p", "log_bow"],
            )
        B.tidy()

    grams = cut_lineage(kneser_ney(gram_counts(df, text_col, across)))
    empty = grams.filter("gram = ''").first()
    rows = cut_lineage(grams.filter("gram <> ''").mapInArrow(key, "bucket int, key long, log_p double, log_bow double"))
    return Model(rows, buckets, empty["log_p"], empty["log_bow"] or 0.0, across, _cells(rows))


def _asked(found: _Spelled) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of the grams of orders ORDER..1 and the contexts of orders ORDER-1..1:
    distinct keys, and their index for each highest-order gram.  Each order is
    made of the distinct grams of the one above, which are fewer and fewer."""
    rows, index = found.grams, np.arange(len(found.grams), dtype=np.int32)
    grams, contexts = [], []
    for _ in range(ORDER):
        keys, of = _distinct(gram_keys(rows))
        if rows.shape[1] > 1:
            before, before_of = _distinct(gram_keys(rows[:, :-1]))
            contexts.append((before, before_of[index]))
        index = of[index]
        grams.append((keys, index))
        first = np.empty(len(keys), np.int64)
        first[of[::-1]] = np.arange(len(of))[::-1]
        rows = rows[first, 1:]
    return grams + contexts


def _spelled_parts(docs: pa.Table, text_col: str, across: bool) -> list[_Spelled]:
    """A block in parts; what is kept of a part is far smaller than what its making takes."""
    return [_Spelled(part.column(text_col), across) for whole in docs.combine_chunks().to_batches() for part in B.cut(whole, PART_BYTES)]


class _Asked:
    """A block's distinct keys that the model may have, ascending (``keys``), and
    for each part and each of its ``_asked`` lists the keys' places there, -1 for
    what is not asked, with the lists' index for each gram."""

    def __init__(self, parts: list[_Spelled], cells: bytes):
        flat, index = [np.empty(0, np.uint64)], []
        for p in parts:
            for keys, own in _asked(p):
                flat.append(keys)
                index.append(own)
            p.grams = np.empty((len(p.grams), 0), np.uint32)  # only their number is needed from here on
        sizes = [len(k) for k in flat[1:]]
        distinct, of = _distinct(np.concatenate(flat))
        del flat
        order = np.argsort(distinct)
        maybe = _maybe_known(distinct[order], cells)
        self.keys = distinct[order[maybe]]
        place = np.full(len(distinct), -1, np.int32)
        place[order[maybe]] = np.arange(len(self.keys), dtype=np.int32)
        slots = [place[x] for x in np.split(of, np.cumsum(sizes)[:-1])] if sizes else []
        lists = list(zip(slots, index, strict=True))
        each = 2 * ORDER - 1
        self.lists = [lists[at : at + each] for at in range(0, len(lists), each)]
        del distinct, of, order, maybe, place
        B.tidy()


def _reply(model: pa.Table, payloads: list[bytes]) -> list[bytes]:
    """Per key log_p and log_bow, NaN where the model has none (``_values``)."""
    keys = model.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    values = np.stack([model.column(c).to_numpy(zero_copy_only=False)[order] for c in ("log_p", "log_bow")])
    keys, out = keys[order], []
    for p in payloads:
        asked, _ = B.unpack_sorted(p)
        got = np.full((2, len(asked)), np.nan)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            hit = keys[at] == asked
            got[:, hit] = values[:, at[hit]]
        there = ~np.isnan(got)
        # flags, then the values there are as 24-bit fixed point, byte by byte of all of them, which compresses better
        fixed = np.rint(got[there] * -(1 << _FRACTION)).clip(0, (1 << 24) - 1).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
        raw = len(asked).to_bytes(4, "little") + np.packbits(there).tobytes() + fixed.T.tobytes()
        out.append(zstandard.compress(raw, 1))
    return out


def _values(reply: bytes) -> np.ndarray:
    """(keys, 2) numbers of a reply."""
    raw = zstandard.decompress(reply)
    n = int.from_bytes(raw[:4], "little")
    out, end = np.full((2, n), np.nan), 4 + (2 * n + 7) // 8
    there = np.unpackbits(np.frombuffer(raw, np.uint8, end - 4, 4), count=2 * n).astype(bool).reshape(2, n)
    wide = np.zeros((int(there.sum()), 4), np.uint8)
    wide[:, :3] = np.frombuffer(raw, np.uint8, -1, end).reshape(3, -1).T
    out[there] = wide.view("<u4").ravel() / -(1 << _FRACTION)
    return out.T


def _backed_off(found: _Spelled, lists: list[tuple[np.ndarray, np.ndarray]], values: np.ndarray, floor: float, floor_bow: float) -> np.ndarray:
    """log p of each gram, along the back-off chain; the last row of ``values``
    stands for keys that were not asked."""

    def get(a: tuple[np.ndarray, np.ndarray], column: int) -> np.ndarray:
        return values[a[0], column][a[1]]

    out = np.full(len(found.grams), floor + floor_bow)  # a character never seen in training
    for k in range(ORDER - 1, -1, -1):  # from the unigram up to the whole gram
        if k < ORDER - 1:
            bow = get(lists[ORDER + k], 1)
            out = out + np.where(np.isnan(bow), 0.0, bow)
        own = get(lists[k], 0)
        out = np.where(np.isnan(own), out, own)
    return out


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with n_predicted, log_prob, perplexity and repeated."""
    df = B.make_room(df, [f.name for f in SCORED], text_col)
    buckets, floor, floor_bow, across, cells = model.buckets, model.floor, model.floor_bow, model.across, model.cells
    packed = B.pack(df, BLOCK_BYTES, keep=False)

    def keys_of(docs: pa.Table):
        keys = _Asked(_spelled_parts(docs, text_col, across), cells).keys
        edges = B.bucket_edges(keys, buckets)
        return [(b, B.pack_sorted(keys[edges[b] : edges[b + 1]])) for b in np.flatnonzero(np.diff(edges)).tolist()]

    def finish(docs: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        parts = _spelled_parts(docs, text_col, across)
        asked = _Asked(parts, cells)
        edges = B.bucket_edges(asked.keys, buckets)
        got = [_values(replies[b]) for b in np.flatnonzero(np.diff(edges)).tolist()]
        values = np.concatenate([np.empty((0, 2)), *got, np.full((1, 2), np.nan)])
        n, log_prob, repeated = np.empty(0, np.int64), np.empty(0), np.empty(0)
        for found, lists in zip(parts, asked.lists, strict=True):
            sums = found.total(_backed_off(found, lists, values, floor, floor_bow)) if len(found.grams) else np.zeros(found.texts)
            n, log_prob, repeated = np.append(n, found.lengths()), np.append(log_prob, sums), np.append(repeated, found.repeated)
        perplexity = pa.array(np.exp(-log_prob / np.maximum(n, 1)), mask=n == 0)
        for field, made in zip(SCORED, (pa.array(n), pa.array(log_prob), perplexity, pa.array(repeated)), strict=True):
            docs = docs.append_column(field.name, made)
        return docs

    replies = B.answer_from(B.ask_rows(df, keys_of, BLOCK_BYTES), model.rows, _reply)
    return B.use(packed, replies, finish, T.StructType(df.schema.fields + SCORED))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.filter(F.col("quality") == 1).select(id_col).filter(F.col(id_col).isNotNull()).distinct()


def training_sample(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", most: int = TRAIN_DOCS) -> DataFrame:
    """At most ``most`` trusted ids (smallest hashes), joined to their rows."""
    chosen = trusted.orderBy(F.xxhash64(id_col), id_col).limit(most)
    return docs.join(F.broadcast(chosen), id_col)


def thresholds(scored: DataFrame, trusted: DataFrame, id_col: str = "doc_id", quantile: float = QUANTILE, tolerance: float = TOLERANCE) -> DataFrame:
    """(lang, threshold, repeat_threshold) over all trusted documents; the NULL
    language has the quantiles over all languages."""
    known = scored.filter("perplexity is not null").join(trusted, id_col).select("lang", "perplexity", "repeated")
    levels = [
        (F.percentile_approx(c, quantile, 10_000) * tolerance).alias(name) for c, name in (("perplexity", "threshold"), ("repeated", "repeat_threshold"))
    ]
    by_lang = known.filter("lang is not null").groupBy("lang").agg(*levels)
    return by_lang.unionByName(known.agg(*levels).withColumn("lang", F.lit(None).cast("string")))


def decide(scored: DataFrame, levels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``scored`` with threshold, repeat_threshold and keep.  A language may hold
    most rows, so its rows spread over ``SALTS`` keys and its thresholds are
    copied to each."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_of_salt")
    own = levels.filter("lang is not null").select(F.col("lang").alias("_own"), F.struct("threshold", "repeat_threshold").alias("_level"), salts)
    rest = levels.filter("lang is null").select(F.struct("threshold", "repeat_threshold").alias("_rest"))  # one row
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64(id_col, "log_prob"), F.lit(SALTS)).cast("int"))
    joined = salted.join(own, (salted["lang"] == own["_own"]) & (salted["_salt"] == own["_of_salt"]), "left").crossJoin(F.broadcast(rest))
    level, repeat_level = (F.coalesce("_level", "_rest")[c] for c in ("threshold", "repeat_threshold"))
    within = (F.col("perplexity") <= level) & (F.col("repeated") <= repeat_level)
    keep = F.col("perplexity").isNotNull() & (level.isNull() | within)
    made = joined.withColumns({"threshold": level, "repeat_threshold": repeat_level, "keep": keep})
    return made.drop("_own", "_level", "_rest", "_salt", "_of_salt")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and decision of every document."""
    docs, trusted = table(spark, sf_dir, "documents"), cut_lineage(trusted_ids(table(spark, sf_dir, "labels")))
    model = train(training_sample(docs.select("doc_id", "text"), trusted), across=True)
    scored = cut_lineage(score(docs.select("doc_id", "lang", "text"), model).drop("text"))
    return decide(scored, thresholds(scored, trusted))
