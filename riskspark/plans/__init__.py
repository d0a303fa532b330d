"""Query catalogue: role bindings + operators, with DuckDB oracles."""

from . import audit_plans, credit_plans, data_plans, features_plans, graph_plans, metrics_plans, model_plans, resample_plans, sampling_plans, split_plans, streaming_plans, uplift_plans  # noqa: F401
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
