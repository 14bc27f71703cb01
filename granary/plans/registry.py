"""Named queries: the Spark side and, where SQL can say it, an independent SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, run, sql)
        return run

    return register


def fx(expr: str, digits: int = 4) -> str:
    """SQL text of :func:`granary.functions.numeric.fixed`."""
    return f"(round(({expr}) + 1e-9, {digits}) + 0.0)"
