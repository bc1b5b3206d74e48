"""Structured Streaming operators."""

from .rollups import (daily_rollup, monthly_rollup, latest_per_day, land_as_stream_source,
                      run_append, run_update)

__all__ = [n for n in dir() if not n.startswith("_")]
