"""TL3: boosted trees as data, so that a fitted model can be continued.

MLlib's GBT cannot resume a fit.  ``Ensemble`` takes its trees out of the
fitted model: rows (tree, node, feature, threshold, left, right, value), one
table of at most rounds x 2^(depth + 1) rows.  The margin (log-odds) of a row is
the sum of its leaf values, as one JVM-side column.  ``extend`` appends rounds:
a tree is fitted to the residuals y - p by MLlib, its leaves get the Newton
step sum(y - p) / sum(p (1 - p)) times the learning rate, and the margin goes on
from there.  The source's medians stay the imputer.  Zero rounds leave the
model as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import number
from ..session import cut_lineage

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"

#: A leaf value is at most this times the learning rate, however pure the leaf.
_MOST = 4.0


def _nodes_of(root, tree: int, weight: float) -> list[tuple]:
    """Rows of an MLlib tree; leaf values times ``weight``."""
    rows: list[tuple] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append(())
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            rows[at] = (tree, at, split.featureIndex(), float(split.threshold()), left, right, None)
        else:
            rows[at] = (tree, at, None, None, None, None, float(node.prediction()) * weight)
        return at

    walk(root)
    return rows


def _column(rows: Sequence[tuple], features: Sequence[Column], leaf: bool) -> Column:
    """Of one tree: the value of a row's leaf, or the leaf's number."""
    by_node = {r[1]: r for r in rows}

    def at(node: int) -> Column:
        _, own, feature, threshold, left, right, value = by_node[node]
        if feature is None:
            return F.lit(own if leaf else value)
        return F.when(features[feature] <= F.lit(threshold), at(left)).otherwise(at(right))

    return at(0)


@dataclass(frozen=True)
class Ensemble:
    features: tuple[str, ...]
    medians: dict[str, float | None]
    rows: tuple[tuple, ...]

    @classmethod
    def of_gbt(cls, model, features: Sequence[str], medians: dict[str, float | None]) -> Ensemble:
        """MLlib's raw prediction is half the log-odds."""
        rows: list[tuple] = []
        for k, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
            rows += _nodes_of(tree._java_obj.rootNode(), k, 2.0 * weight)
        return cls(tuple(features), dict(medians), tuple(rows))

    @property
    def trees(self) -> int:
        return 1 + max((r[0] for r in self.rows), default=-1)

    def _inputs(self) -> list[Column]:
        filled = []
        for c in self.features:
            x = number(F.col(c).cast("double"))
            filled.append(F.coalesce(x, F.lit(self.medians[c])) if self.medians.get(c) is not None else x)
        return filled

    def margin(self) -> Column:
        """Log-odds of a row; missing values become the source's medians."""
        inputs, total = self._inputs(), F.lit(0.0)
        for k in range(self.trees):
            total = total + _column([r for r in self.rows if r[0] == k], inputs, leaf=False)
        return total

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return df.withColumn(out, 1.0 / (1.0 + F.exp(-self.margin())))

    def extend(self, df: DataFrame, label: str, rounds: int, step: float = 0.1, depth: int = 3, seed: int = 42) -> Ensemble:
        """The model with ``rounds`` more trees, fitted on ``df``."""
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import DecisionTreeRegressor

        grown = self
        y = F.col("__y")
        cur = df.select(F.col(label).cast("double").alias("__y"), *[c.alias(f"__x{i}") for i, c in enumerate(self._inputs())], self.margin().alias("__m"))
        cur = cut_lineage(VectorAssembler(inputCols=[f"__x{i}" for i in range(len(self.features))], outputCol="__v", handleInvalid="keep").transform(cur))
        inputs = [F.col(f"__x{i}") for i in range(len(self.features))]
        for _ in range(rounds):
            p = 1.0 / (1.0 + F.exp(-F.col("__m")))
            cur = cur.withColumn("__r", y - p)
            tree = DecisionTreeRegressor(featuresCol="__v", labelCol="__r", maxDepth=depth, seed=seed).fit(cur)
            rows = _nodes_of(tree._java_obj.rootNode(), grown.trees, 1.0)
            leaf = _column(rows, inputs, leaf=True)
            sums = cur.groupBy(leaf.alias("leaf")).agg(F.sum("__r").alias("g"), F.sum(p * (1 - p)).alias("h")).collect()  # a row for each leaf
            value = {s["leaf"]: step * max(-_MOST, min(_MOST, s["g"] / s["h"] if s["h"] else 0.0)) for s in sums}
            rows = [r if r[2] is not None else (*r[:6], value.get(r[1], 0.0)) for r in rows]
            grown = replace(grown, rows=(*grown.rows, *rows))
            cur = cut_lineage(cur.withColumn("__m", F.col("__m") + _column(rows, inputs, leaf=False)).drop("__r"))
        return grown

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(list(self.rows), NODES).coalesce(1).write.mode("error").parquet(f"{path}/nodes")
        inputs = [(i, c, self.medians.get(c)) for i, c in enumerate(self.features)]
        spark.createDataFrame(inputs, "position int, feature string, median double").coalesce(1).write.mode("error").parquet(f"{path}/inputs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        inputs = spark.read.parquet(f"{path}/inputs").orderBy("position").collect()
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        return cls(tuple(r["feature"] for r in inputs), {r["feature"]: r["median"] for r in inputs}, tuple(tuple(r) for r in rows))


def log_loss(df: DataFrame, label: str, margin: Column) -> float:
    """Mean log(1 + exp(-+margin))."""
    signed = F.when(F.col(label) == 1, -margin).otherwise(margin)
    return df.agg(F.avg(F.greatest(signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed))))).first()[0]
