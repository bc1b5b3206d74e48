"""Numeric column expressions (P7, P8, P10, P12, P22-P25) and reproducible draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: ColumnOrName, scale: int = 2) -> Column:
    """banker's rounding (pandas ``round``); Spark ``round`` is half-up."""
    return F.bround(_c(c), scale)


def sentinel_to_null(c: ColumnOrName, sentinel: float = -999.0) -> Column:
    """P10: the climate service's missing-value sentinel becomes NULL."""
    return F.nullif(_c(c), F.lit(sentinel))


def non_finite_to_null(c: ColumnOrName) -> Column:
    """NaN and +/-inf become NULL (Spark's avg propagates NaN)."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def ms_to_kmh(c: ColumnOrName) -> Column:
    """Metres per second to kilometres per hour."""
    return _c(c) * F.lit(3.6)


def m2_to_ha(c: ColumnOrName) -> Column:
    """Square metres to hectares."""
    return _c(c) / F.lit(10000.0)


def scale_linear(part: ColumnOrName, whole: ColumnOrName, amount: ColumnOrName) -> Column:
    """Amount for ``part`` hectares given ``amount`` for ``whole`` hectares."""
    return _c(part) / _c(whole) * _c(amount)


def bits_to_int(bits: ColumnOrName) -> Column:
    """Big-endian bit array to BIGINT."""
    return F.aggregate(_c(bits), F.lit(0).cast("bigint"),
                       lambda acc, b: acc * 2 + b.cast("bigint"))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Benefit / cost."""
    return _c(num) / _c(den)


def bit_objective(x: ColumnOrName, n_bits: int = 30) -> Column:
    """P25: (x / (2^n - 1))^2 on the decoded integer."""
    return F.pow(_c(x) / F.lit(float(2 ** n_bits - 1)), F.lit(2.0))


def inverse(x: ColumnOrName) -> Column:
    """P25: 1 / x (tour objective)."""
    return F.lit(1.0) / _c(x)


def uniform(*keys: ColumnOrName, seed: int | str = 0) -> Column:
    """Deterministic U[0,1) draw from the md5 of ``seed|k1|k2|...``.

    A retried task recomputes exactly the same draw (``rand()`` would not be
    reproducible across a lost executor), and DuckDB computes the same value
    as ``('0x'||substr(md5(k),1,8))::BIGINT / 4294967296.0``.
    """
    parts = [F.lit(str(seed))] + [_c(k).cast("string") for k in keys]
    h = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform_sql(keys_sql: str, seed: int | str = 0) -> str:
    """DuckDB / Spark-SQL text of :func:`uniform` for oracle queries.

    ``keys_sql`` is a comma-separated list of SQL expressions.
    """
    return (f"(('0x' || substr(md5(concat_ws('|', '{seed}', {keys_sql})), 1, 8))"
            f"::BIGINT / 4294967296.0)")


def uniform_int(lo: int | Column, hi: int | Column, *keys: ColumnOrName,
                seed: int | str = 0) -> Column:
    """Deterministic integer in [lo, hi] inclusive."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (lo_c + F.floor(uniform(*keys, seed=seed) * (hi_c - lo_c + 1))).cast("int")
