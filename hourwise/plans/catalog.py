"""Imports every query module so the registry is complete."""
from __future__ import annotations

from . import q_core, q_eval, q_models, q_rules, q_streams, q_timeseries  # noqa: F401
from .registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
