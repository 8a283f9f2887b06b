"""Registered queries and, where SQL can express them, the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from fundloom.catalog.registry import ORACLES, QUERIES

_MODULES = [
    "sources", "scalars", "joins", "dedup", "coverage", "accuracy", "profile", "timeseries",
    "documents", "features", "models", "portfolio", "scoring", "jobs", "incremental",
]
for _name in _MODULES:
    import_module(f"fundloom.catalog.{_name}")

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
