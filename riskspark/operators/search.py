"""ML7: random search over learner parameters with expanding time folds.

Parameter maps are drawn by md5 of (seed, map, name), the same in any engine.
Each fold's train side is imputed with its own medians and, if asked,
oversampled by SMOTE; both happen inside the fold, so no row of the test side
has a part in them.  A fold is made once and used by all maps; the fits run
from a few driver threads, so that small ones share the cluster; large ones run
one after another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from hashlib import md5

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learners as le
from . import resample as rs
from .metrics import auc_roc
from .modeltables import keep
from .split import time_series_folds

FOUND = "map_id int, params map<string,double>, fold int, n_train long, n_synthetic long, n_test long, auc_roc double"

#: Rows of all fits that run side by side.
ROWS_AT_ONCE = 16_000_000


def sample_params(space: Mapping[str, Sequence[float]], n: int, seed: int = 42) -> list[dict[str, float]]:
    """``n`` maps; a name's value is the element at md5(seed:map:name) mod its
    number of values, by the first 8 hex digits."""
    drawn = []
    for j in range(n):
        at = {name: int(md5(f"{seed}:{j}:{name}".encode()).hexdigest()[:8], 16) for name in space}
        drawn.append({name: float(values[at[name] % len(values)]) for name, values in space.items()})
    return drawn


def balanced(
    train: DataFrame, features: Sequence[str], label: str, id_col: str = "id", k: int = rs.DEFAULT_K, seed: int = 42, medians: Mapping[str, float | None] | None = None
) -> tuple[DataFrame, int]:
    """Rows (label, features) without missing values, with synthetic rows of
    label 1 up to the count of the others, and how many these are.  Fewer than
    two rows of label 1 have no neighbour and get none.  ``medians``: of the train
    side, if known."""
    filled = le.fill_medians(train, le.fit_medians(train, features) if medians is None else medians)
    rows = filled.select(F.col(label).cast("double").alias(label), *features)
    if train.where(F.col(label) == 1).limit(2).count() < 2:
        return rows, 0
    vec = filled.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))
    made, n = rs.oversample_to_parity(vec, "label", 1, "id", "vec", k, seed)
    if not n:
        return rows, 0
    return rows.unionByName(made.select(F.lit(1.0).alias(label), *[F.col("vec")[i].alias(c) for i, c in enumerate(features)])), n


def _at_once(sizes: Sequence[int], threads: int) -> int:
    """How many of the fits run side by side.  A fit holds its rows in memory, binned,
    and a few copies of their predictions, and reads them for every level of every
    tree: fits that share the memory while each could fill the cluster read from disk."""
    return max(1, min(threads, ROWS_AT_ONCE // max([1, *sizes])))


def random_search(
    df: DataFrame, features: Sequence[str], space: Mapping[str, Sequence[float]], n_maps: int, label: str = "label", kind: str = "gbt",
    time_col: str = "t", id_col: str = "id", n_folds: int = 3, oversample: bool = True, seed: int = 42, threads: int = 4,
) -> DataFrame:
    """One row per (map, fold): AUC on the fold's later rows (NULL if they have
    one class) and the sizes of its sides."""
    spark = df.sparkSession
    own = dict.fromkeys([id_col, time_col, label, *features])
    folds = keep(time_series_folds(df.select(*own), n_folds, time_col=time_col, id_col=id_col), by=["fold", "role"])
    sides = []
    for k in range(n_folds):
        rows = folds.where(F.col("fold") == k)
        train, test = rows.where(F.col("role") == "train"), rows.where(F.col("role") == "test")
        medians = le.fit_medians(train, features)
        made, n_new = balanced(train, features, label, id_col, seed=seed, medians=medians) if oversample else (le.fill_medians(train, medians).select(F.col(label).cast("double").alias(label), *features), 0)
        fit_in = keep(le.assemble(made, features).select(label, "features"))
        score_in = keep(le.assemble(le.fill_medians(test, medians), features).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), "features"))
        size = score_in.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).first()
        sides.append((k, train.count(), n_new, size["n"], fit_in, score_in if 0 < (size["ones"] or 0) < size["n"] else None))
    maps = sample_params(space, n_maps, seed)

    def fit(at: tuple[int, int]) -> tuple:
        j, k = at
        fold, n_train, n_new, n_test, fit_in, score_in = sides[k]
        if score_in is None:
            return j, maps[j], fold, n_train, n_new, n_test, None
        params = {name: int(v) if float(v).is_integer() else v for name, v in maps[j].items()}
        pred = le.positive_probability(le.make_classifier(kind, label, **params).fit(fit_in).transform(score_in))
        auc = auc_roc(keep(pred.select("id", "y", "score")), validate=False).first()[0]  # read twice
        return j, maps[j], fold, n_train, n_new, n_test, auc

    with ThreadPoolExecutor(_at_once([n_train + n_new for _, n_train, n_new, *_ in sides], threads)) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(fit), [(j, k) for j in range(n_maps) for k in range(n_folds)]))
    return spark.createDataFrame(found, FOUND)


def best(found: DataFrame) -> dict[str, float]:
    """The map with the highest mean AUC; the smallest number of equal ones."""
    mean = found.groupBy("map_id").agg(F.avg("auc_roc").alias("auc"), F.first("params").alias("params"))
    return mean.orderBy(F.desc_nulls_last("auc"), "map_id").first()["params"]
