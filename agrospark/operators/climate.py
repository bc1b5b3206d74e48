"""Climate series operators: monthly roll-up (A1), preceding-months window
join (J3/W3), lag feature (W1), supervised windows (W2), positional split
(W5) and prediction overlay (W10).

Window operators run on the *rolled-up* series (one row per site and
period): a window partition then holds at most one row per period of that
site, a bound set by the calendar, not by the volume of raw readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import pad_front
from ..functions.dates import month_start, planting_bound
from ..functions.numeric import half_even, ms_to_kmh, sentinel_to_null


def daily_readings(df: DataFrame, value_cols: list[str], sentinel: float = -999.0,
                   wind_col: str | None = None) -> DataFrame:
    """P10 + P7: sentinel to NULL on every reading; add wind in km/h."""
    out = df.withColumns({c: sentinel_to_null(c, sentinel) for c in value_cols})
    if wind_col:
        out = out.withColumn(wind_col.replace("_m_s", "_km_h"), ms_to_kmh(wind_col))
    return out


def monthly_rollup(df: DataFrame, site: str, date: str, mean_cols: list[str],
                   sum_cols: list[str], scale: int = 2, count_col: str | None = "n_days",
                   unit_means: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """A1: per (site, month): mean of ``mean_cols``, sum of ``sum_cols``.

    NULLs are skipped; a month whose sum column is all NULL gives 0.0 (pandas
    ``sum`` semantics), a mean over only NULLs stays NULL.  Values are rounded
    half-even.  Partial aggregation runs map-side, so a hot site or month is
    collapsed before the shuffle.  ``unit_means`` adds converted means
    (``name -> (column, factor)``, e.g. km/h from m/s): the mean of a scaled
    value is the scaled mean, converted once per group.
    """
    aggs = [half_even(F.avg(c), scale).alias(c) for c in mean_cols]
    for name, (src, factor) in (unit_means or {}).items():
        aggs.append(half_even(F.avg(src) * F.lit(factor), scale).alias(name))
    aggs += [half_even(F.coalesce(F.sum(c), F.lit(0.0)), scale).alias(c) for c in sum_cols]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(F.col(site), month_start(date).alias(date)).agg(*aggs)


def previous_months(monthly: DataFrame, requests: DataFrame, site: str, date: str,
                    year: str, value_cols: list[str], n: int = 14) -> DataFrame:
    """Attach, per request row, the last ``n`` monthly values with
    ``date <= 31 Dec (year - 1)``, oldest first, front-padded with NULL when
    fewer exist, ``[]`` when none.

    Plan: (1) per site, a rolling window of the ``n`` latest months ending at
    each month (window partition = one site's months, calendar-bounded);
    (2) the *distinct* (site, year) keys of the requests are matched to the
    month interval ``date <= bound < next_date`` with ``site`` as equi key;
    (3) the requests are equi-joined to that small keyed table on
    (site, year), so a hot site in the requests is handled by AQE's
    size-checked broadcast or skew split, never by a range join.
    """
    w_site = Window.partitionBy(site).orderBy(date)
    frame = w_site.rowsBetween(-(n - 1), 0)
    win = (monthly
           .select(site, date, *value_cols)
           .withColumn("_next", F.lead(date).over(w_site))
           .withColumn("_w", F.collect_list(F.struct(*value_cols)).over(frame))
           .select(site, date, "_next", "_w"))
    keys = requests.select(site, year).distinct().withColumn("_bound", planting_bound(year))
    matched = (keys.alias("k")
               .join(win.alias("m"),
                     (F.col(f"k.{site}") == F.col(f"m.{site}"))
                     & (F.col(f"m.{date}") <= F.col("k._bound"))
                     & (F.col("m._next").isNull() | (F.col("m._next") > F.col("k._bound"))),
                     "left")
               .select(F.col(f"k.{site}").alias(site), F.col(f"k.{year}").alias(year),
                       F.coalesce(F.col("m._w"), F.array()).alias("_w")))
    def field(name):
        return lambda s: s[name].cast("double")
    arrays = {c: pad_front(F.transform("_w", field(c)), n) for c in value_cols}
    keyed = matched.select(site, year, *[v.alias(c) for c, v in arrays.items()])
    return requests.join(keyed, [site, year], "left")


def lag_feature(df: DataFrame, site: str, order: str, col: str, name: str | None = None,
                drop_null: bool = True) -> DataFrame:
    """Value of the previous period of the same site."""
    w = Window.partitionBy(site).orderBy(order)
    out = df.withColumn(name or f"{col}_lag1", F.lag(col).over(w))
    return out.na.drop(subset=[name or f"{col}_lag1"]) if drop_null else out


def sliding_samples(df: DataFrame, site: str, order: str, col: str, n: int = 14,
                    inputs: str = "inputs", target: str = "target") -> DataFrame:
    """``n`` consecutive values as inputs and the next value as target.

    ``collect_list(struct)`` keeps NULL readings in place (a bare
    ``collect_list`` would drop them and silently shift the window).
    """
    w = Window.partitionBy(site).orderBy(order)
    prev = w.rowsBetween(-n, -1)
    out = (df.withColumn("_w", F.collect_list(F.struct(F.col(col).alias("v"))).over(prev))
             .withColumn(inputs, F.transform("_w", lambda s: s["v"]))
             .withColumn(target, F.col(col))
             .filter(F.size("_w") == n)
             .drop("_w"))
    return out


def positional_split(df: DataFrame, site: str, order: str, train_share: float = 0.8,
                     flag: str = "is_train") -> DataFrame:
    """First ``floor(share * n)`` rows of each site are training rows."""
    w = Window.partitionBy(site).orderBy(order)
    wall = Window.partitionBy(site)
    return (df.withColumn("_rn", F.row_number().over(w))
              .withColumn("_n", F.count(F.lit(1)).over(wall))
              .withColumn(flag, F.col("_rn") <= F.floor(F.lit(train_share) * F.col("_n")))
              .drop("_rn", "_n"))


def prediction_overlay(actual: DataFrame, predicted: DataFrame, keys: list[str],
                       pred_col: str = "prediction") -> DataFrame:
    """Actual series with predictions on the rows that have one, NULL elsewhere."""
    return actual.join(predicted.select(*keys, pred_col), keys, "left")
