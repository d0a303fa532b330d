"""Reproducible shuffle into shards by a Feistel permutation (native).

``number_rows`` gives each row its global number in key order without a
single-task window: rows are range-partitioned and sorted, the place inside
the partition comes from ``monotonically_increasing_id`` and the partition's
offset from one count per partition.  A physical tie-breaker is the last sort
key, so a key value held by a third of all rows still splits over partitions.

``permute`` is a bijection of [0, n) in plain column expressions: a number is
split into (left, right) on an a x b grid that just covers n, the halves are
mixed in turns, and a result outside [0, n) is permuted again (cycle walking).
The shard is the permuted place modulo the shard count and the slot its
quotient, so a row's shard and slot can be computed from its number alone and
any two shards differ by at most one row.

Defined cases: NULL texts count as no bytes; rows with equal keys are numbered
in any order among themselves; an empty table gives an empty result; extra
columns are carried along, names starting with ``_riskshard_`` are reserved.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from .catalog import query

DEFAULT_SEED = 20_240_229
ROUNDS = 6
#: More walks than any number needs: the grid exceeds n by less than a row of
#: it, so each further walk is needed with probability below 1/sqrt(n); for
#: small n the walk is at most sqrt(n) + 2 long.  ``permute`` raises beyond it.
MAX_WALKS = 64

_PART, _SEQ, _TIE, _OFFSET = (f"_riskshard_{x}" for x in ("part", "seq", "tie", "offset"))


def number_rows(df: DataFrame, order: list[str], out: str = "row_number") -> tuple[DataFrame, int]:
    """Adds the 0-based global number of each row in the order of ``order``
    and returns it with the row count.  One range exchange of the given
    columns and one checkpoint, so the numbers survive a lost executor."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(parts, *order, _TIE).sortWithinPartitions(*order, _TIE).drop(_TIE)
    placed = cut_lineage(
        dealt.withColumn(_PART, F.spark_partition_id()).withColumn(_SEQ, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy(_PART).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # At most one row per shuffle partition: bounded, so the window and the broadcast are too.
    offsets = sizes.select(_PART, (F.sum("n").over(Window.orderBy(_PART)) - F.col("n")).alias(_OFFSET))
    numbered = placed.join(F.broadcast(offsets), _PART).withColumn(out, F.col(_OFFSET) + F.col(_SEQ))
    return numbered.drop(_PART, _SEQ, _OFFSET), int(total)



def feistel(number: Column, n: int, seed: int = DEFAULT_SEED, rounds: int = ROUNDS) -> Column:
    """One pass of the permutation of the grid that covers [0, n)."""
    width = max(1, isqrt(max(n - 1, 0)) + 1)
    height = max(1, -(-n // width))
    halves = F.struct(F.pmod(number, F.lit(width).cast("long")).alias("l"), F.floor(number / F.lit(width)).cast("long").alias("r"))
    # aggregate() binds each round's halves once; nested plain expressions would double per round
    steps = F.array(*[F.lit(i).cast("long") for i in range(rounds)])

    def step(acc: Column, i: Column) -> Column:
        salt = i + F.lit(seed * 1_000)
        left = F.pmod(acc["l"] + F.pmod(F.xxhash64(acc["r"], salt), F.lit(width).cast("long")), F.lit(width).cast("long"))
        right = F.pmod(acc["r"] + F.pmod(F.xxhash64(acc["l"], salt), F.lit(height).cast("long")), F.lit(height).cast("long"))
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(F.when(even, left).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(right).alias("r"))

    return F.aggregate(steps, halves, step, lambda acc: acc["r"] * F.lit(width).cast("long") + acc["l"])


def permute(number: Column, n: int, seed: int = DEFAULT_SEED, rounds: int = ROUNDS) -> Column:
    """The place of row ``number`` in the shuffled order of [0, n)."""
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MAX_WALKS)),
        feistel(number, n, seed, rounds),
        lambda acc, _: F.when(acc < n, acc).otherwise(feistel(acc, n, seed, rounds)),
    )
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def shard_rows(df: DataFrame, order: list[str], shards: int = 16, seed: int = DEFAULT_SEED) -> DataFrame:
    """Adds row_number, place, shard (place mod shards) and slot (gapless from
    0 inside each shard); shard sizes differ by at most one row."""
    numbered, n = number_rows(df, order)
    placed = numbered.withColumn("place", permute(F.col("row_number"), n, seed))
    return placed.withColumn("shard", F.pmod(F.col("place"), F.lit(shards)).cast("int")).withColumn(
        "slot", F.floor(F.col("place") / F.lit(shards)).cast("long")
    )


@query("op5_feistel_sharding")
def op5_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards under the law `rows`.  Equal texts are not
    kept together: the law fixes counts, and a hot text must spread."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(keys, ["doc_id", "text_crc32", "size"], 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number", "place"
    )
