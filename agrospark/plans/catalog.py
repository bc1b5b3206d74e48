"""Import every query module so the registry is complete."""

from __future__ import annotations

from . import (climate_queries, evolution_queries, io_queries, layer_queries, search_queries,  # noqa: F401
               model_queries, planner_queries, population_queries, soil_geo_queries, stream_queries, text_price_queries)
from .registry import REGISTRY


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


def bench_queries():
    return {name: q.build for name, q in REGISTRY.items() if q.bench}

FLAGSHIP = "previous_months_climate"
