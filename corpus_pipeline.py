"""The corpus pipeline: documents through the stages of STAGES, in order.

Each stage takes (spark, docs, sf_dir), works on every document its
predecessor kept, and is written as Parquet to the shared folder and read
again before the next one starts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import stages
from riskspark.session import checkpoint_dir
from riskspark.sources.tables import table

STAGES = [
    ("quality_classifier", stages.keep_quality),
    ("simhash_near_dedup", stages.drop_near_copies),
    ("substring_dedup", stages.drop_repeated_passages),
    ("benchmark_decontamination", stages.drop_leaks),
    ("bpe_encoding", stages.add_tokens),
]

#: The stages are a language model, fingerprints, hashes and a tokenizer, which
#: SQL cannot express; tests/llm checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    work = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        path = f"{work}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
