"""Query registry: name -> (Spark builder, optional oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    covers: tuple[str, ...]
    bench: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, covers: tuple[str, ...] = (), bench: bool = False):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(covers), bench)
        return fn
    return deco
