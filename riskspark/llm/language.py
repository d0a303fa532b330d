"""Language identification by multilingual mixture inference.

Training counts letter trigrams per language (over all training documents, as
one row per language, hash cell and task) and turns them into smoothed
probabilities P(gram | language).  A document is then explained as a mixture:
expectation-maximisation estimates the language proportions pi that maximise

    sum over grams of count * log(sum over languages of pi * P(gram | language)).

The language set is chosen by penalised likelihood: the languages are taken
in the order of their proportions, EM is run again on the first k, and k grows
while the likelihood gains more than ``PENALTY * log(grams)`` per language
(half a log for each parameter, as in BIC, times the trigrams that overlap at
one letter).  The prediction is the largest proportion of the chosen set.

The model is a table of at most ``CELLS`` numbers, whatever the corpus: the
hash cells per language shrink with the number of languages.  That bounds its
broadcast (16 MB).

Defined cases: a NULL text or one without a letter is ``und`` with score 0 and
no languages, and so is every text when nothing could be learned; very long
texts are counted whole; repeated rows are predicted alike; an empty table
gives an empty result.  Extra columns are carried along, but one named like
an output column (lang_pred, score, languages) is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.sources.tables import table

from .blocks import make_room
from .catalog import query

ORDER = 3
CELLS = 1 << 22
MOST_CELLS = 1 << 18
SMOOTHING = 0.25
PENALTY = 0.5 * ORDER
ITERATIONS = 12
UNKNOWN = "und"
#: Code points handled at once; a longer text is handled alone.
_CHARS = 1 << 20
_LANGUAGES_HELD = 32

OUTPUT = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("languages", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("proportion", T.DoubleType())]))),
]

_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-cased code point of each letter, 32 for anything else."""
    if not _TABLE:
        table_ = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table_[c] = ord(low[0])
        _TABLE.append(table_)
    return _TABLE[0]


def _grams(texts: list[str], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, cell) of every trigram of letters and word edges.  Anything
    but letters is one space; texts begin and end with one."""
    whole = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    doc = np.concatenate([[0], np.repeat(np.arange(len(texts)), sizes)])
    codes = _letters()[whole]
    gap = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    # the first letter of a text needs the space before it, which may belong to the text before
    codes, doc = codes[keep].astype(np.uint64), doc[keep]
    if len(codes) < ORDER:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    # every trigram holds a letter; it belongs to the text of its middle, or of the letter beside a middle space
    owner = np.where(codes[1:-1] == 32, doc[2:], doc[1:-1])
    inner = (b != 32) | ((c != 32) & (a != 32) & (doc[:-2] == doc[2:]))
    h = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
    cell = (h >> np.uint64(40)).astype(np.int64) % cells
    return owner[inner], cell[inner]


def _slices(texts: list[str | None]):
    """(first, texts) runs of about _CHARS code points."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= _CHARS:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


@dataclass
class LanguageModel:
    """Learned languages and their gram probabilities (languages x cells)."""

    languages: list[str]
    probabilities: np.ndarray

    @property
    def cells(self) -> int:
        return self.probabilities.shape[1]


def gram_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", cells: int = MOST_CELLS) -> DataFrame:
    """(lang, cell, n) over all rows with a text and a language."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def emit():
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["lang", "cell", "n"]
                )
            held.clear()

        for batch in batches:
            langs = batch.column(lang_col).to_pylist()
            for first, texts in _slices(batch.column(text_col).to_pylist()):
                own = langs[first : first + len(texts)]
                names = sorted(set(own))
                if len(held.keys() | set(names)) > _LANGUAGES_HELD:
                    yield from emit()
                doc, cell = _grams(texts, cells)
                code = np.array([names.index(x) for x in own])[doc] if len(doc) else doc
                for k, name in enumerate(names):
                    counts = np.bincount(cell[code == k], minlength=cells)
                    held[name] = held[name] + counts if name in held else counts
        yield from emit()

    rows = df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(text_col, lang_col)
    return rows.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fits the model on every row of ``df`` with a text and a language."""
    known = df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    n = known.select(lang_col).distinct().count()
    cells = MOST_CELLS
    while cells * n > CELLS and cells > 256:
        cells //= 2
    if cells * n > CELLS:
        raise ValueError(f"{n} languages do not fit a table of {CELLS} cells")
    # at most CELLS rows: bounded for the driver
    counted = gram_counts(df, text_col, lang_col, cells).toPandas()
    languages = sorted(counted["lang"].unique())
    counts = np.zeros((len(languages), cells))
    if languages:
        code = counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
        counts[code, counted["cell"].to_numpy()] = counted["n"].to_numpy()
    used = max(1, int((counts.sum(axis=0) > 0).sum()))
    return LanguageModel(languages, ((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * (used + 1))).astype(np.float32))


def _em(p: np.ndarray, count: np.ndarray, doc: np.ndarray, starts: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions over the allowed languages and the log-likelihood, per document."""
    total = np.add.reduceat(count, starts)
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        w = p * pi[doc]
        w *= (count / w.sum(axis=1))[:, None]
        pi = np.add.reduceat(w, starts, axis=0) / total[:, None]
    return pi, np.add.reduceat(count * np.log((p * pi[doc]).sum(axis=1)), starts)


def infer(model: LanguageModel, texts: list[str]) -> list[tuple[str, float, list[tuple[str, float]]]]:
    """(language, score, [(language, proportion)]) of each text.

    The score is the predicted language's proportion, drawn towards an even
    split by one pseudo-gram per language, so short texts score lower."""
    n_lang, out = len(model.languages), [(UNKNOWN, 0.0, [])] * len(texts)
    doc, cell = _grams(texts, model.cells)
    if not n_lang or not len(doc):
        return out
    keys = np.sort(doc * model.cells + cell)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(keys))).astype(np.float64)
    doc, cell = np.divmod(keys[at], model.cells)
    present, starts = np.unique(doc, return_index=True)
    doc = np.searchsorted(present, doc)
    p = model.probabilities[:, cell].T.astype(np.float64)
    p /= p.max(axis=1, keepdims=True)  # the same factor for every set
    grams = np.add.reduceat(count, starts)

    pi, _ = _em(p, count, doc, starts, np.ones((len(present), n_lang)), ITERATIONS)
    order = np.argsort(-pi, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    singles = np.add.reduceat(count[:, None] * np.log(p), starts, axis=0)
    best = singles.argmax(axis=1)
    chosen = np.eye(n_lang)[best]
    value = singles[np.arange(len(present)), best]
    growing = np.ones(len(present), bool)
    for k in range(2, n_lang + 1):
        live = np.flatnonzero(growing)
        if not len(live):
            break
        rows = growing[doc]
        local = np.searchsorted(live, doc[rows])
        begin = np.flatnonzero(np.diff(local, prepend=-1))
        tried, like = _em(p[rows], count[rows], local, begin, (rank[live] < k).astype(np.float64), ITERATIONS)
        like -= PENALTY * (k - 1) * np.log(grams[live] + 1)
        better = like > value[live]
        chosen[live[better]], value[live[better]] = tried[better], like[better]
        growing[live[~better]] = False
    for k, i in enumerate(present.tolist()):
        share = chosen[k]
        top = int(share.argmax())
        score = (grams[k] * share[top] + 1) / (grams[k] + n_lang)
        parts = [(model.languages[j], float(share[j])) for j in np.argsort(-share, kind="stable") if share[j] > 0]
        out[i] = (model.languages[top], float(min(1.0, score)), parts)
    return out


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and languages; only ``text_col`` is looked at."""
    df = make_room(df, [f.name for f in OUTPUT], text_col)
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.probabilities))

    def run(batches):
        for batch in batches:
            for first, texts in _slices(batch.column(text_col).to_pylist()):
                part = batch.slice(first, len(texts))
                lang, score, parts = zip(*infer(LanguageModel(*shared.value), texts), strict=True)
                kind = pa.list_(pa.struct([("lang", pa.string()), ("proportion", pa.float64())]))
                made = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array([[{"lang": a, "proportion": b} for a, b in x] for x in parts], kind)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *(f.name for f in OUTPUT)])

    return df.mapInArrow(run, T.StructType(df.schema.fields + OUTPUT))


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the documents not held out."""
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    model = learn(docs.filter(remainder("doc_id", 5) != 0))
    return identify(docs.select("doc_id", fold.alias("held_out"), "text"), model).drop("text")
