"""Every query of the core by name, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import evaluating, extracting, merging, resolving

_PARTS = (merging, evaluating, resolving, extracting)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for p in _PARTS for k, f in p.QUERIES.items()}
SQL: dict[str, str] = {k: s for p in _PARTS for k, s in p.SQL.items()}
