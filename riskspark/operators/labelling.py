"""AL5: labelling rounds with a fit.

A round fits a learner on the labelled rows, evaluates it on a test side,
scores the pool, chooses a batch by a query strategy and moves it.  Each round's
sides are checkpointed, so plans stay short over many rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import learners as le
from .metrics import average_precision
from .sampling import select_query_batch
from .split import move_rows, random_batch

CURVE = "strategy string, round int, n_labeled long, n_pool long, n_positives long, metric double"


def simulate(
    pool: DataFrame, labelled: DataFrame, test: DataFrame, features: Sequence[str], batch_size: int, rounds: int, strategy: str = "entropy",
    label: str = "label", id_col: str = "id", kind: str = "logistic", seed: int = 0, **params,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(learning curve, labelled, pool) after up to ``rounds`` rounds; ends
    early with an empty pool.  The curve has a row for each fit: the labelled
    rows it saw, their positives, the pool left, and the average precision on the
    test side (NULL while the labelled rows have one class).  ``random`` takes
    rows in the order of md5(id:seed + round), and so do the other strategies
    while there is no model."""
    if batch_size < 1 or rounds < 0:
        raise ValueError(f"a batch of {batch_size} rows in {rounds} rounds")
    pool, labelled, test = cut_lineage(pool), cut_lineage(labelled), cut_lineage(test)
    curve = []
    for k in range(rounds + 1):
        seen = labelled.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
        left, positives = pool.count(), seen["p"] or 0
        model, metric = None, None
        if 0 < positives < seen["n"]:
            model, scored = le.fit_and_score(labelled, test, features, label, kind, **params)
            metric = average_precision(scored.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), "score"), validate=False).first()[0]
        curve.append((strategy, k, seen["n"], left, positives, metric))
        if k == rounds or not left:
            break
        if model is None or strategy == "random":
            chosen = random_batch(pool, batch_size, id_col, seed + k)
        else:
            medians = le.fit_medians(labelled, features)
            p = F.col("score")
            asked = le.positive_probability(model.transform(le.assemble(le.fill_medians(pool, medians), features)))
            chosen = select_query_batch(asked.select(id_col, F.array(1 - p, p).alias("__probs")), batch_size, strategy, "__probs", id_col)
        ids = cut_lineage(chosen.select(id_col))  # batch_size rows at most
        labelled, pool = (cut_lineage(x) for x in move_rows(pool, labelled, ids, id_col))
    return pool.sparkSession.createDataFrame(curve, CURVE), labelled, pool
