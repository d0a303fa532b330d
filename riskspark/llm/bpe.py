"""BPE encoding and decoding by forced boundaries.

The vocabulary file names a normaliser (NFC, white space to one space, lower
case per character), a splitting pattern, a byte alphabet and ranked merges
with a word-end mark.  A byte pair that occurs inside no vocabulary token can
never be merged across, so every place where such a pair stands is a certain
cut: the fragments between cuts are encoded independently and their ids
concatenated.  The word-end mark belongs to a word's last fragment only.
Fragments repeat far more often than words do, so their encodings are kept in
a bounded per-task memo.

Special tokens of the file (``<|...|>``) are matched in the raw text and are
single ids, as the tokenizers library does by default.  Decoding joins the
token strings with one space, as that library does for a file without decoder.

Defined cases: NULL and empty texts have no ids and decode to ''; very long
texts and words are encoded whole (a fragment's merges use a heap, so time is
n log n); repeated rows are encoded alike; an empty table gives an empty
result.  Extra columns are carried along, but one named like an output column
(ids, decoded) is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

from riskspark.sources.tables import table

from .blocks import make_room
from .catalog import query

#: Entries in each memo of a task; a full memo is emptied.
MEMO = 1 << 18
#: Longer words are encoded anew each time, so that the memo's memory is bounded.
MEMO_CHARS = 64

#: Longer fragments are merged with a heap instead of by scanning their pairs.
SCAN_CHARS = 256
_NEVER = 1 << 62

#: Code points below this are assigned in every Unicode version in use.  Texts
#: with others may hold letters that Python's tables do not know yet; they are
#: normalised and split by the library's own components.
SETTLED = "\u0378"

#: Characters with the Unicode property White_Space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_alphabet() -> list[str]:
    """One printable character per byte: visible Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in byte order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class ForcedBoundaryBPE:
    """A vocabulary file of the word-end BPE kind, read from its JSON text."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        self.end = model["model"]["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        alphabet = byte_alphabet()
        self.as_text = {b: c for b, c in enumerate(alphabet)}
        self.ranks = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[a, b] = rank
        inside = {t[: -len(self.end)] if self.end and t.endswith(self.end) else t for t in self.vocab}
        #: pairs of byte characters that some token contains; all others are cuts
        self.joined = {t[i : i + 2] for t in inside for i in range(len(t) - 1)}
        pattern = model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace("\\s", WHITE))
        self.exact_normaliser = Tokenizer.from_str(spec).normalizer
        self.exact_words = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.spaces = regex.compile(f"[{WHITE}]+")
        self.separators = re.compile("[\x1c-\x1f]")
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self._pieces: dict[str, list[int]] = {}
        self._chunks: dict[str, list[int]] = {}

    def fragments(self, word: str) -> list[str]:
        """The word's byte characters, cut at every pair that no token contains."""
        chars = "".join(map(self.as_text.__getitem__, word.encode("utf-8", "surrogatepass")))
        cuts = [0, *(i for i in range(1, len(chars)) if chars[i - 1 : i + 1] not in self.joined), len(chars)]
        return [chars[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def chunks(self, text: str) -> list[str]:
        """The normalised text, cut at white space; no word of the splitting
        pattern crosses it."""
        if not text.isascii() and max(text) >= SETTLED:
            return self.exact_normaliser.normalize_str(text).split(" ")
        text = unicodedata.normalize("NFC", text).lower()
        # split() would also cut at four control characters that are no White_Space
        return self.spaces.split(text) if self.separators.search(text) else text.split()

    def split(self, chunk: str) -> list[str]:
        """The words of one chunk."""
        if chunk.isascii() or max(chunk) < SETTLED:
            return self.words.findall(chunk)
        return [w for w, _ in self.exact_words.pre_tokenize_str(chunk)]

    def _merge(self, symbols: list[str]) -> list[int]:
        """Lowest-ranked pair first, leftmost first, until none is left."""
        if len(symbols) > SCAN_CHARS:
            return self._merge_long(symbols)
        rank = self.ranks.get
        pairs = [rank(p, _NEVER) for p in zip(symbols, symbols[1:], strict=False)]
        while pairs and (least := min(pairs)) < _NEVER:
            i = pairs.index(least)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank((symbols[i - 1], symbols[i]), _NEVER)
            if i < len(pairs):
                pairs[i] = rank((symbols[i], symbols[i + 1]), _NEVER)
        return [self.vocab[s] for s in symbols]

    def _merge_long(self, symbols: list[str]) -> list[int]:
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        ranks = self.ranks
        heap = [(ranks[p], i, *p) for i in range(n - 1) if (p := (symbols[i], symbols[i + 1])) in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue  # one side has been merged since
            symbols[i], alive[j] = a + b, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (p := (symbols[i], symbols[after[j]])) in ranks:
                    heapq.heappush(heap, (ranks[p], i, *p))
            if (k := before[i]) >= 0 and (p := (symbols[k], symbols[i])) in ranks:
                heapq.heappush(heap, (ranks[p], k, *p))
        return [self.vocab[s] for s, live in zip(symbols, alive, strict=True) if live]

    def _fragment(self, chars: str, last: bool) -> list[int]:
        key = chars + self.end if last else chars
        ids = self._pieces.get(key)
        if ids is None:
            symbols = list(chars)
            if last:
                symbols[-1] += self.end
            ids = self._merge(symbols)
            if len(chars) <= MEMO_CHARS:
                if len(self._pieces) >= MEMO:
                    self._pieces.clear()
                self._pieces[key] = ids
        return ids

    def _chunk(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for word in self.split(chunk):
            cut = self.fragments(word)
            for f in cut[:-1]:
                ids += self._fragment(f, False)
            ids += self._fragment(cut[-1], True)
        if len(chunk) <= MEMO_CHARS:
            if len(self._chunks) >= MEMO:
                self._chunks.clear()
            self._chunks[chunk] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        known, out = self._chunks, []
        for chunk in self.chunks(text):
            ids = known.get(chunk)
            out += self._chunk(chunk) if ids is None else ids
        return out

    def encode(self, text: str | None) -> list[int]:
        text, out, at = text or "", [], 0
        if self.special:
            for found in self.specials.finditer(text):
                out += self._plain(text[at : found.start()])
                out.append(self.special[found[0]])
                at = found.end()
        return out + self._plain(text[at:])

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


_LOADED: dict[int, ForcedBoundaryBPE] = {}


def _codec(spec) -> ForcedBoundaryBPE:
    """The broadcast vocabulary, built once per Python worker."""
    key = spec.value[0]
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ForcedBoundaryBPE(spec.value[1])
    return _LOADED[key]


def _spec(spark: SparkSession, path: str):
    """The vocabulary file (a few MB, independent of the data) as a broadcast."""
    import hashlib

    text = open(path, encoding="utf-8").read()
    return spark.sparkContext.broadcast((hashlib.sha256(text.encode()).hexdigest(), text))


def _map(df: DataFrame, fields: list[T.StructField], make):
    def run(batches):
        for batch in batches:
            # a few thousand rows of long texts make large id lists: hand them on in slices
            step = max(1, batch.num_rows * (4 << 20) // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part)], [*part.schema.names, *(f.name for f in fields)])

    return df.mapInArrow(run, T.StructType(df.schema.fields + fields))


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.StringType())


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ids array<int> of the vocabulary file at ``path``."""
    df = make_room(df, ["ids"], text_col)
    spec = _spec(df.sparkSession, path)
    return _map(df, [IDS], lambda b: [pa.array([_codec(spec).encode(t.as_py()) for t in b.column(text_col)], pa.list_(pa.int32()))])


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with decoded, the text of ``ids_col``; NULL ids decode to ''."""
    df = make_room(df, ["decoded"], ids_col)
    spec = _spec(df.sparkSession, path)
    return _map(df, [DECODED], lambda b: [pa.array([_codec(spec).decode(i.as_py() or []) for i in b.column(ids_col)], pa.string())])


def encode_decode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ids and decoded in one pass."""
    df = make_room(df, ["ids", "decoded"], text_col)
    spec = _spec(df.sparkSession, path)

    def make(batch):
        codec = _codec(spec)
        ids = [codec.encode(t.as_py()) for t in batch.column(text_col)]
        return [pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec.decode, ids), pa.string())]

    return _map(df, [IDS, DECODED], make)


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_bpe_round_trip")
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and their decoding, as digests."""
    done = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), word_vocabulary())
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
