"""Key-checked left join with a match flag, coverage, anti and
overlap checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.contracts import contract_report, enforce


def merge_left_flag(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    flag: str = "has_match",
    validate: bool = True,
) -> DataFrame:
    """1:1 left join that keeps every left row and adds ``flag``.

    The flag comes from a literal on the right side, not from NULL-ness of a
    data column (a matched row may have NULL data).  ``validate`` checks key
    uniqueness on both sides first (one aggregate each), so the row count
    cannot change.  The planner picks broadcast vs. sort-merge from sizes
    (AQE), nothing is forced.
    """
    keys = [key] if isinstance(key, str) else list(key)
    for side, name in ((left, "left"), (right, "right")):
        missing = sorted(set(keys) - set(side.columns))
        if missing:
            raise ValueError(f"no join: the {name} side lacks {missing}")
    if validate:
        enforce(contract_report(left, "left", keys, keys))
        enforce(contract_report(right, "right", keys, keys))
    marked = right.withColumn("__m", F.lit(True))
    out = left.join(marked, keys, "left")
    return out.withColumn(flag, F.coalesce(F.col("__m"), F.lit(False))).drop("__m")


def match_rate(merged: DataFrame, flag: str = "has_match") -> DataFrame:
    """Coverage with the counts behind it."""
    if flag not in merged.columns:
        raise ValueError(f"no match rate without the flag {flag!r}")
    return merged.agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count_if(F.col(flag)).cast("long").alias("n_matched"),
        F.avg(F.col(flag).cast("double")).alias("match_rate"),
    )


def unmatched_keys(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left keys with no partner (anti join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.select(*keys).join(right.select(*keys), keys, "left_anti")


def split_overlap(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Sizes and shared ids of two splits (semi join on distinct ids)."""
    tr = train.select(key).distinct()
    te = test.select(key).distinct()
    shared = tr.join(te, key, "left_semi")
    return (
        train.agg(F.count(F.lit(1)).cast("long").alias("n_train"))
        .crossJoin(test.agg(F.count(F.lit(1)).cast("long").alias("n_test")))
        .crossJoin(shared.agg(F.count(F.lit(1)).cast("long").alias("n_shared")))
    )


def assert_no_overlap(train: DataFrame, test: DataFrame, key: str) -> None:
    r = split_overlap(train, test, key).first()
    if r["n_shared"]:
        raise ValueError(f"the sides of the split share {r['n_shared']} of {r['n_test']} test keys ({key})")
