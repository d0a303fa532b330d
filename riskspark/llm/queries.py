"""Imports every operator module so that its query is registered."""

from __future__ import annotations

from . import bpe, conversations, decontamination, exactdedup, fingerprints, language, licenses, lm, phrases, quality, sharding, simhash, substrings  # noqa: F401
from .catalog import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
