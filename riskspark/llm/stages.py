"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> documents.

Every stage works on all rows it is given and returns the columns of
``documents`` (and any extra ones, whatever their names); the last one adds
the token columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from . import bpe, decontamination, quality, simhash, substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _apart(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """Runs a stage with extra columns set aside in one struct, so that no
    name of theirs meets a name the stage uses."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = [c for c in docs.columns if c not in COLUMNS]
        if not extra:
            return stage(spark, docs, sf_dir)
        done = stage(spark, docs.select(*COLUMNS, F.struct(*[F.col(f"`{c}`") for c in extra]).alias("_extra")), sf_dir)
        made = [c for c in done.columns if c not in (*COLUMNS, "_extra")]
        kept = [c for c in extra if c not in made]
        return done.select(*COLUMNS, *[F.col(f"_extra.`{c}`").alias(c) for c in kept], *made)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


@_apart
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects.  Scores are made
    twice, once for the thresholds and once to filter whole rows, which costs
    less than storing all texts in between."""
    trusted = cut_lineage(quality.trusted_ids(table(spark, sf_dir, "labels")))
    model = quality.train(quality.training_sample(docs.select("doc_id", "text"), trusted), across=True)
    narrow = quality.score(docs.select("doc_id", "lang", "text"), model).select("doc_id", "lang", "perplexity", "repeated")
    levels = cut_lineage(quality.thresholds(narrow, trusted))
    return quality.decide(quality.score(docs, model), levels).filter("keep").select(docs.columns)


@_apart
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs).select(docs.columns)


@_apart
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of repeated 35-word windows; other texts stay as they
    are, NULL texts too.  A text that loses all its words is ''."""
    done = substrings.remove_repeated_windows(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    length = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumns({"text": text, "n_chars": length}).select(docs.columns)


@_apart
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


@_apart
def add_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids, their number n_tokens, and the decoded text."""
    done = bpe.encode_decode(docs.drop("n_tokens"), bpe.word_vocabulary())
    return done.withColumn("n_tokens", F.size("ids").cast("long"))
