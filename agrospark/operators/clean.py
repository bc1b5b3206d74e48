"""Cleaning, filtering and profiling operators.

All are ``DataFrame -> DataFrame`` and chain with ``df.transform``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import non_finite_to_null
from ..functions.text import INVALID_TOKENS, invalid_to_null


def select_last(df: DataFrame, last: list[str]) -> DataFrame:
    """Keep every column, moving the target columns to the end."""
    first = [c for c in df.columns if c not in last]
    return df.select(*[F.col(f"`{c}`") for c in first + last])


def rename_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename only the keys that exist (missing keys are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` per column (ANSI ``cast`` would raise on bad text)."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()
                           if c in df.columns})


def null_invalid_tokens(df: DataFrame, tokens=None) -> DataFrame:
    """P11 on every string column."""
    toks = INVALID_TOKENS if tokens is None else tokens
    return df.withColumns({n: invalid_to_null(F.col(f"`{n}`"), toks)
                           for n, t in df.dtypes if t == "string"})


def null_non_finite(df: DataFrame) -> DataFrame:
    """P12 on every floating column."""
    return df.withColumns({n: non_finite_to_null(F.col(f"`{n}`"))
                           for n, t in df.dtypes if t in ("double", "float")})


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with any NULL (after P11/P12)."""
    return df.na.drop("any", subset=subset)


def clean_for_training(df: DataFrame) -> DataFrame:
    """P11 + P12 + F4, the sequence used before a table is written."""
    return df.transform(null_invalid_tokens).transform(null_non_finite).transform(drop_incomplete)


def dense_columns(df: DataFrame, min_share: float = 0.15) -> list[str]:
    """F5 decision: columns whose non-null count >= ``min_share`` of rows.

    One aggregation pass (partial aggregates, a single row reaches the
    driver); the schema of the result depends on data, so it is decided once.
    """
    aggs = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    n = row["n"]
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] >= min_share * n]


def drop_sparse_columns(df: DataFrame, min_share: float = 0.15,
                        keep: list[str] | None = None) -> DataFrame:
    """keep a column only if it is non-null in >= ``min_share`` of rows."""
    keep = keep or []
    dense = set(dense_columns(df, min_share))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in dense or c in keep])


def head_by(df: DataFrame, n: int, order: list[str], partition: list[str] | None = None) -> DataFrame:
    """first ``n`` rows in an explicit order (per partition when given)."""
    if not partition:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def tail_by(df: DataFrame, n: int, order: list[str], partition: list[str]) -> DataFrame:
    """last ``n`` rows per partition in an explicit order."""
    w = Window.partitionBy(*partition).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def null_counts(df: DataFrame) -> DataFrame:
    """One row, the NULL count of every column (``count_if(c IS NULL)``)."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def summary_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count / mean / std / min / max of numeric columns, long format.

    One aggregation pass; the result has one row per (column, statistic).
    """
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`")
        aggs += [F.count(x).cast("double").alias(f"{c}\x00count"), F.avg(x).alias(f"{c}\x00mean"),
                 F.stddev_samp(x).alias(f"{c}\x00std"), F.min(x).cast("double").alias(f"{c}\x00min"),
                 F.max(x).cast("double").alias(f"{c}\x00max")]
    wide = df.agg(*aggs)
    pairs = []
    for c in cols:
        for s in ("count", "mean", "std", "min", "max"):
            pairs.append(F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"),
                                  F.col(f"`{c}\x00{s}`").alias("value")))
    return wide.select(F.explode(F.array(*pairs)).alias("s")).select("s.*")


def first_seen_codes(df: DataFrame, label: str, order: list[str], code: str = "code") -> DataFrame:
    """A10: labels numbered 0.. in order of first appearance.

    ``groupBy(label).min(order)`` (partial aggregation; a hot label collapses
    map-side) then ``row_number`` over the distinct labels only.
    """
    firsts = df.groupBy(label).agg(F.min(F.struct(*order)).alias("_first"))
    w = Window.orderBy("_first")
    return firsts.select(label, (F.row_number().over(w) - 1).cast("int").alias(code))


def sort_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """O1: multi-key ascending sort (range-partitioned by Spark)."""
    return df.orderBy(*keys)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
