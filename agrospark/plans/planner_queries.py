"""The planner end to end: train, forecast, score every crop of every field, search
the split of each field's hectares (J8, M10, M11, G2, G13)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..operators import features as FE
from ..session import cut_lineage
from . import tables as T
from .climate_queries import CLIM4, SOIL5, _training_sql, yield_training_table
from .evolution_queries import GENERATIONS, allocation_totals, located_fields
from .model_queries import FEATURES, forecast_tables, wide_forecast, yield_model
from .registry import register
from .soil_geo_queries import POINTS_IN_DEPARTMENTS_SQL, soil_means_by_department
from .text_price_queries import board_prices

YEAR, FIRST = 2025, 4
MONTHS = [f"{v}_{j}" for v in CLIM4 for j in range(1, 15)]


def planner_crops(training):
    """(cultivo_nombre, cultivo_code, crop_pos) of the crops that the model knows."""
    return training.select("cultivo_nombre", "cultivo_code").distinct().withColumn("crop_pos", F.col("cultivo_code"))


def planner_fields(spark, d):
    return located_fields(spark, d).select(F.col("point_id").alias("instance_id"), "departamento_nombre", "area_ha")


def last_months(monthly, n: int = 14):
    """The last ``n`` observed months of each department, oldest first, in the columns of a forecast."""
    w = Window.partitionBy("departamento_nombre").orderBy(F.desc("fecha"))
    some = monthly.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return some.groupBy("departamento_nombre").agg(
        *[F.max(F.when(F.col("_rn") == n + 1 - j, F.col(v))).alias(f"{v}_{j}") for v in CLIM4 for j in range(1, n + 1)])


def _soil(spark, d):
    return soil_means_by_department(spark, d).select("departamento_nombre", *SOIL5)


_ROWS_SQL = f"""
SELECT f.point_id AS instance_id, f.departamento_nombre, CAST(10 + f.point_id % 91 AS DOUBLE) AS area_ha,
       c.cultivo_code AS crop_pos, c.cultivo_nombre, c.cultivo_code,
       CASE WHEN c.cultivo_code < {FIRST} THEN {YEAR} ELSE {YEAR + 1} END AS anio,
       CAST(10 + f.point_id % 91 AS DOUBLE) AS superficie_sembrada_ha,
       {', '.join(f's.{c}' for c in SOIL5)}, {', '.join(f'm.{c}' for c in MONTHS)}
FROM field_located f CROSS JOIN (SELECT DISTINCT cultivo_nombre, cultivo_code FROM tt_rows) c
     LEFT JOIN soil_means s ON s.departamento_nombre = f.departamento_nombre
     LEFT JOIN last_months m ON m.departamento_nombre = f.departamento_nombre"""


def _rows_sql() -> str:
    """The training query's CTEs, its rows as ``tt_rows``, then the planner's rows.  Fields
    and soil sites are located by the same CTEs, so theirs get names of their own."""
    head, body = _training_sql().split("\nSELECT b.cultivo_nombre, k.cultivo_code", 1)
    located = (POINTS_IN_DEPARTMENTS_SQL.replace("located AS", "field_located AS").replace(" points p", " field_points p")
               .replace("pip_cands", "field_cands").replace("pip_first", "field_first"))
    months = ", ".join(f"max(CASE WHEN rn = {15 - j} THEN {v} END) AS {v}_{j}" for v in CLIM4 for j in range(1, 15))
    return f"""{head},
tt_rows AS (SELECT b.cultivo_nombre, k.cultivo_code{body}),
{T.SQL_POINTS.replace('points AS', 'field_points AS').strip()},
{located.strip()},
last_months AS (
  SELECT departamento_nombre, {months}
  FROM (SELECT *, row_number() OVER (PARTITION BY departamento_nombre ORDER BY fecha DESC) AS rn FROM climate_monthly)
  WHERE rn <= 14 GROUP BY 1)
{_ROWS_SQL}"""


@register("planner_feature_rows", covers=("J8", "P18"), sql=_rows_sql())
def planner_feature_rows(spark, d):
    """One feature row a field and crop; the last observed months stand for the forecast."""
    return FE.planner_rows(planner_fields(spark, d), planner_crops(yield_training_table(spark, d)), _soil(spark, d),
                           last_months(T.climate_monthly(spark, d)), YEAR, FIRST)


def planner_scores(spark, d):
    """(instance_id, departamento_nombre, area_ha, crop_pos, cultivo_nombre, anio, tons,
    price): every crop of every field, scored on the forecast climate."""
    training, model = yield_model(spark, d)
    forecast = cut_lineage(wide_forecast(forecast_tables(spark, d)))
    rows = FE.planner_rows(planner_fields(spark, d), planner_crops(training), _soil(spark, d), forecast, YEAR, FIRST)
    scored = B.score(rows, model, FEATURES, "tons")
    prices = board_prices(spark, d).select(F.col("crop_key"), F.col("price").cast("double").alias("price"))
    key = F.lower(F.replace("cultivo_nombre", F.lit(" "), F.lit("")))
    out = scored.withColumn("crop_key", key).join(prices, "crop_key", "left")
    return out.select("instance_id", "departamento_nombre", "area_ha", "crop_pos", "cultivo_nombre", "anio", "tons", "price")


@register("planner_crop_revenue", covers=("J8", "M10", "M11", "G2", "J5"), sql=None)
def planner_crop_revenue(spark, d):
    """Tons and revenue of a whole field under each crop."""
    s = planner_scores(spark, d)
    return s.withColumn("revenue", F.bround(F.col("tons") * F.col("price"), 2)).withColumn("tons", F.bround("tons", 3))


@register("planner_allocation", covers=("G2", "G13", "J8", "M11"), sql=None)
def planner_allocation(spark, d, generations: int = GENERATIONS):
    """The search over each field's hectares with the model's tons as objective."""
    s = cut_lineage(planner_scores(spark, d))
    n = s.select("crop_pos").distinct().count()
    fields = s.groupBy("instance_id").agg(
        F.first("area_ha").alias("area_ha"), F.array_sort(F.collect_list(F.struct("crop_pos", "tons", "price"))).alias("_c"))
    fields = fields.select("instance_id", "area_ha", F.col("_c.tons").alias("tons_full"), F.col("_c.price").alias("prices"))
    return allocation_totals(fields, generations, n)
