"""ML14 / PS5: the scorecard as one versioned artifact.

A ``Scorecard`` is all that scoring, deciding and monitoring need: bin edges
and special values, the WoE table, points, base points, cut-offs, and the
histogram of the reference scores.  ``save`` writes it as small tables into one
folder that must not exist yet; ``publish`` registers that folder as the next
version of a name and promotes it; ``champion`` loads the version an alias
points at.  A reloaded card scores alike.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import points_decision
from . import registry as rg
from . import woe as wo


@dataclass(frozen=True)
class Scorecard:
    model: wo.WoeModel
    base_points: float
    points: DataFrame
    approve: float
    decline: float
    reference: rg.PsiReference

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return wo.score(df, self.model, self.base_points, self.points, self.model.features(), out)

    def decide(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with its score and the decision by the cut-offs."""
        return self.score(df, out).withColumn("decision", points_decision(out, self.approve, self.decline))


def save(spark: SparkSession, card: Scorecard, path: str) -> None:
    m, ref = card.model, card.reference
    facts = {
        "numeric": m.numeric, "categorical": m.categorical, "edges": m.edges, "specials": {k: list(v) for k, v in m.specials.items()}, "target": m.target,
        "base_points": card.base_points, "approve": card.approve, "decline": card.decline, "value": ref.value, "score_edges": ref.edges,
    }
    m.table.write.mode("error").parquet(f"{path}/woe")
    card.points.write.mode("error").parquet(f"{path}/points")
    ref.counts.write.mode("error").parquet(f"{path}/reference")
    # last, so that a folder with facts is whole; doubles go through repr and come back as they are
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("error").text(f"{path}/facts")


def load(spark: SparkSession, path: str) -> Scorecard:
    facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
    model = wo.WoeModel(facts["numeric"], facts["categorical"], facts["edges"], facts["specials"], spark.read.parquet(f"{path}/woe"), facts["target"])
    reference = rg.PsiReference.known(facts["value"], facts["score_edges"], spark.read.parquet(f"{path}/reference"))
    return Scorecard(model, facts["base_points"], spark.read.parquet(f"{path}/points"), facts["approve"], facts["decline"], reference)


def publish(spark: SparkSession, root: str, name: str, card: Scorecard, metrics: dict[str, float], at=None, alias: str = "champion") -> str:
    """Saves the card into the registry's folder, registers it with its metrics
    and promotes it; returns the version."""
    path = f"{root}/models/{name}-{uuid.uuid4().hex}"
    save(spark, card, path)
    version = rg.register_version(spark, root, name, metrics, path)
    rg.promote(spark, root, name, version, alias, at)
    return version


def champion(spark: SparkSession, root: str, name: str, alias: str = "champion") -> tuple[str, Scorecard]:
    """The version the alias points at, and its card."""
    found = rg.champion(rg.promotions(spark, root), name, alias).first()
    if found is None:
        raise ValueError(f"no version of {name!r} has been promoted to {alias!r}")
    row = rg.versions(spark, root).where((F.col("name") == name) & (F.col("version") == found["version"])).first()
    return found["version"], load(spark, row["model_path"])
