"""Agronomic roles derived from the driver tables.

Each role has a Spark builder and the equivalent SQL (DuckDB dialect) so
the oracle can recompute it on the same parquet views.  Derivations are
key arithmetic only; every role reads whole tables.

Broadcast policy: only ``nation``/``region`` (25 / 5 rows by definition of
the schema) are broadcast explicitly; every other join is left to AQE,
which broadcasts a side only when its runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the
sort-merge join (with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table


def R(expr: str, scale: int = 2) -> str:
    """SQL twin of ``bround(x, scale)``: Spark rounds the shortest decimal
    text of the double half-even, so the oracle goes through VARCHAR too."""
    return (f"CAST(round_even(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR)"
            f"::DECIMAL(38,18), {scale}) AS DOUBLE)")


def _t(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    df = read_table(spark, d, name)
    return df.select(*cols) if cols else df


def nation_names(spark: SparkSession, d: str) -> DataFrame:
    # 25 rows by schema definition: broadcast is size-safe.
    return F.broadcast(_t(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey"))


# --------------------------------------------------------------------------
# Daily climate readings: one per order, site = customer's nation.  Values
# are dyadic fractions (k / 2^m), so sums are exact in any order and both
# engines see the same doubles before rounding.
def climate_daily(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
           "o_orderdate", "o_orderpriority")
    c = _t(spark, d, "customer", "c_custkey", "c_nationkey")
    n = nation_names(spark, d)
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("n_name").alias("departamento_nombre"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(-999.0))
         .otherwise(F.floor(F.col("o_totalprice") / 100) / 64.0).alias("temperatura_media_C"),
        (F.col("o_custkey") % 100).cast("double").alias("humedad_relativa_pct"),
        ((F.col("o_orderkey") % 13).cast("double") / 2.0).alias("velocidad_viento_m_s"),
        F.when(F.col("o_orderstatus") == "F", F.floor(F.col("o_totalprice") / 1000) / 128.0)
         .alias("precipitacion_mm_dia"))


SQL_CLIMATE_DAILY = """
climate_daily AS (
  SELECT n.n_name AS departamento_nombre, CAST(o.o_orderdate AS DATE) AS fecha,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN CAST(-999.0 AS DOUBLE)
              ELSE floor(o.o_totalprice / 100) / 64.0 END AS temperatura_media_C,
         CAST(o.o_custkey % 100 AS DOUBLE) AS humedad_relativa_pct,
         CAST(o.o_orderkey % 13 AS DOUBLE) / 2.0 AS velocidad_viento_m_s,
         CASE WHEN o.o_orderstatus = 'F' THEN floor(o.o_totalprice / 1000) / 128.0 END
           AS precipitacion_mm_dia
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

CLIMATE_MEANS = ["temperatura_media_C", "humedad_relativa_pct", "velocidad_viento_m_s"]
CLIMATE_VARS = CLIMATE_MEANS + ["velocidad_viento_km_h", "precipitacion_mm_mes"]

SQL_CLIMATE_MONTHLY = f"""
climate_clean AS (
  SELECT departamento_nombre, fecha,
         NULLIF(temperatura_media_C, -999.0) AS temperatura_media_C,
         NULLIF(humedad_relativa_pct, -999.0) AS humedad_relativa_pct,
         NULLIF(velocidad_viento_m_s, -999.0) AS velocidad_viento_m_s,
         NULLIF(precipitacion_mm_dia, -999.0) AS precipitacion_mm_dia
  FROM climate_daily),
climate_monthly AS (
  SELECT departamento_nombre, CAST(date_trunc('month', fecha) AS DATE) AS fecha,
         {R('avg(temperatura_media_C)')} AS temperatura_media_C,
         {R('avg(humedad_relativa_pct)')} AS humedad_relativa_pct,
         {R('avg(velocidad_viento_m_s)')} AS velocidad_viento_m_s,
         {R('avg(velocidad_viento_m_s) * 3.6')} AS velocidad_viento_km_h,
         {R('coalesce(sum(precipitacion_mm_dia), 0.0)')} AS precipitacion_mm_mes,
         count(*) AS n_days
  FROM climate_clean GROUP BY 1, 2)"""


def climate_monthly(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.climate import daily_readings, monthly_rollup
    daily = daily_readings(climate_daily(spark, d),
                           ["temperatura_media_C", "humedad_relativa_pct",
                            "velocidad_viento_m_s", "precipitacion_mm_dia"])
    return (monthly_rollup(daily, "departamento_nombre", "fecha", CLIMATE_MEANS,
                           ["precipitacion_mm_dia"],
                           unit_means={"velocidad_viento_km_h": ("velocidad_viento_m_s", 3.6)})
            .withColumnRenamed("precipitacion_mm_dia", "precipitacion_mm_mes"))


# --------------------------------------------------------------------------
# Crop history: lineitem aggregated by crop (part type), year and the
# supplier's nation.  Money-like sums are DECIMAL so both engines are exact.
def crop_history(spark: SparkSession, d: str, min_year: int | None = None) -> DataFrame:
    """``min_year`` (F1) is applied as a bound on the raw ship date so the
    parquet scan can skip row groups (``year(x) >= y`` is not pushable)."""
    li = _t(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_shipdate")
    if min_year is not None:
        li = li.filter(F.col("l_shipdate") >= F.lit(f"{min_year}-01-01 00:00:00").cast("timestamp_ntz"))
    p = _t(spark, d, "part", "p_partkey", "p_type")
    s = _t(spark, d, "supplier", "s_suppkey", "s_nationkey")
    n = nation_names(spark, d)
    j = (li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
           .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    return (j.groupBy(F.lower(F.trim("p_type")).alias("cultivo_nombre"),
                      F.year("l_shipdate").alias("anio"),
                      F.col("n_name").alias("departamento_nombre"))
             .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
                  .alias("superficie_sembrada_ha"),
                  F.sum((F.col("l_quantity") * (1 - F.col("l_discount"))).cast("decimal(18,4)"))
                  .cast("double").alias("superficie_cosechada_ha"),
                  (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
                   / 1000.0).alias("produccion_tn")))


SQL_CROP_HISTORY = """
crop_history AS (
  SELECT lower(trim(p.p_type)) AS cultivo_nombre, CAST(year(li.l_shipdate) AS INTEGER) AS anio,
         n.n_name AS departamento_nombre,
         CAST(sum(CAST(li.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS superficie_sembrada_ha,
         CAST(sum(CAST(li.l_quantity * (1 - li.l_discount) AS DECIMAL(18,4))) AS DOUBLE)
           AS superficie_cosechada_ha,
         CAST(sum(CAST(li.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000.0 AS produccion_tn
  FROM lineitem li JOIN part p ON li.l_partkey = p.p_partkey
                   JOIN supplier s ON li.l_suppkey = s.s_suppkey
                   JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3)"""


# --------------------------------------------------------------------------
# Soil: supplier = soil site, lineitem = soil layer of its supplier.
def soil_sites(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier", "s_suppkey", "s_nationkey")
    return s.select(
        F.col("s_suppkey").alias("profile_identifier"),
        (F.lit(-55.0) + (F.col("s_suppkey") % 53).cast("double") * 0.5).alias("latitude"),
        (F.lit(-75.0) + (F.col("s_suppkey") % 41).cast("double") * 0.5).alias("longitude"),
        F.when(F.col("s_nationkey") % 5 == 0, F.lit("URY")).otherwise(F.lit("ARG"))
         .alias("country_code"),
        F.col("s_nationkey").alias("nationkey"))


SQL_SOIL_SITES = """
soil_sites AS (
  SELECT s_suppkey AS profile_identifier,
         -55.0 + CAST(s_suppkey % 53 AS DOUBLE) * 0.5 AS latitude,
         -75.0 + CAST(s_suppkey % 41 AS DOUBLE) * 0.5 AS longitude,
         CASE WHEN s_nationkey % 5 = 0 THEN 'URY' ELSE 'ARG' END AS country_code,
         s_nationkey AS nationkey
  FROM supplier)"""

SOIL_COLUMNS = ["bulk_density", "ca_co3", "organic_carbon", "ph", "clay", "silt", "sand"]


def soil_layers(spark: SparkSession, d: str) -> DataFrame:
    """Layer measurements as dyadic fractions (exact sums in any order)."""
    li = _t(spark, d, "lineitem", "l_suppkey", "l_quantity", "l_discount", "l_tax",
            "l_returnflag")
    disc = F.round(F.col("l_discount") * 100).cast("int")
    tax = F.round(F.col("l_tax") * 100).cast("int")
    return li.select(
        F.col("l_suppkey").alias("profile_identifier"),
        F.when(F.col("l_returnflag") == "R", F.lit(1.0) + tax / 32.0).alias("bulk_density"),
        F.when(F.col("l_quantity") > 45, F.col("l_quantity") / 4.0).alias("ca_co3"),
        (disc / 16.0).alias("organic_carbon"),
        (F.lit(5.0) + tax / 8.0).alias("ph"),
        F.col("l_quantity").alias("clay"),
        (F.lit(50.0) - F.col("l_quantity")).alias("silt"),
        ((disc + tax) / 4.0).alias("sand"))


SQL_SOIL_LAYERS = """
soil_layers AS (
  SELECT l_suppkey AS profile_identifier,
         CASE WHEN l_returnflag = 'R' THEN 1.0 + CAST(round(l_tax * 100) AS INTEGER) / 32.0 END
           AS bulk_density,
         CASE WHEN l_quantity > 45 THEN l_quantity / 4.0 END AS ca_co3,
         CAST(round(l_discount * 100) AS INTEGER) / 16.0 AS organic_carbon,
         5.0 + CAST(round(l_tax * 100) AS INTEGER) / 8.0 AS ph,
         l_quantity AS clay,
         50.0 - l_quantity AS silt,
         (CAST(round(l_discount * 100) AS INTEGER) + CAST(round(l_tax * 100) AS INTEGER)) / 4.0
           AS sand
  FROM lineitem)"""


# --------------------------------------------------------------------------
# Department polygons: one ring per nation on a 5 x 5 degree grid; even
# nations are boxes, odd nations concave "L" shapes; nations 0 and 1 also
# overlap (first in nation order wins).  Integer vertices keep the boundary
# test exact.
def department_polygons(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, d, "region", "r_regionkey", "r_name")
    x0 = (F.lit(-75) + (F.col("n_nationkey") % 5) * 4).cast("double")
    y0 = (F.lit(-55) + F.floor(F.col("n_nationkey") / 5) * 5).cast("double")
    grow = F.when(F.col("n_nationkey") == 0, F.lit(2.0)).otherwise(F.lit(0.0))

    def v(dx, dy):
        return F.struct((x0 + dx).alias("lon"), (y0 + dy).alias("lat"))
    box = F.array(v(0, 0), v(F.lit(4.0) + grow, F.lit(0)), v(F.lit(4.0) + grow, F.lit(5)), v(0, 5))
    ell = F.array(v(0, 0), v(4, 0), v(4, 2), v(2, 2), v(2, 5), v(0, 5))
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").alias("poly_order"), F.col("n_name").alias("nam"),
                     F.col("r_name").alias("fna"),
                     F.when(F.col("n_nationkey") % 2 == 0, box).otherwise(ell).alias("ring")))


SQL_POLYGONS = """
poly_base AS (
  SELECT n.n_nationkey AS poly_order, n.n_name AS nam, r.r_name AS fna,
         CAST(-75 + (n.n_nationkey % 5) * 4 AS DOUBLE) AS x0,
         CAST(-55 + floor(n.n_nationkey / 5) * 5 AS DOUBLE) AS y0,
         CASE WHEN n.n_nationkey = 0 THEN 2.0 ELSE 0.0 END AS grow
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
polygon_edges AS (
  SELECT poly_order, nam, fna, v.i, v.ax, v.ay, v.bx, v.by FROM (
    SELECT poly_order, nam, fna, unnest(CASE WHEN poly_order % 2 = 0 THEN [
        {'i': 1, 'ax': x0, 'ay': y0, 'bx': x0 + 4.0 + grow, 'by': y0},
        {'i': 2, 'ax': x0 + 4.0 + grow, 'ay': y0, 'bx': x0 + 4.0 + grow, 'by': y0 + 5},
        {'i': 3, 'ax': x0 + 4.0 + grow, 'ay': y0 + 5, 'bx': x0, 'by': y0 + 5},
        {'i': 4, 'ax': x0, 'ay': y0 + 5, 'bx': x0, 'by': y0}]
      ELSE [
        {'i': 1, 'ax': x0, 'ay': y0, 'bx': x0 + 4, 'by': y0},
        {'i': 2, 'ax': x0 + 4, 'ay': y0, 'bx': x0 + 4, 'by': y0 + 2},
        {'i': 3, 'ax': x0 + 4, 'ay': y0 + 2, 'bx': x0 + 2, 'by': y0 + 2},
        {'i': 4, 'ax': x0 + 2, 'ay': y0 + 2, 'bx': x0 + 2, 'by': y0 + 5},
        {'i': 5, 'ax': x0 + 2, 'ay': y0 + 5, 'bx': x0, 'by': y0 + 5},
        {'i': 6, 'ax': x0, 'ay': y0 + 5, 'bx': x0, 'by': y0}] END) AS v
    FROM poly_base) t)"""


# --------------------------------------------------------------------------
# Field points: one per customer on a half-degree grid.
def customer_points(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer", "c_custkey", "c_nationkey")
    return c.select(
        F.col("c_custkey").alias("point_id"),
        (F.lit(-76.0) + (F.col("c_custkey") % 47).cast("double") * 0.5).alias("lon"),
        (F.lit(-56.0) + (F.col("c_custkey") % 59).cast("double") * 0.5).alias("lat"))


SQL_POINTS = """
points AS (
  SELECT c_custkey AS point_id,
         -76.0 + CAST(c_custkey % 47 AS DOUBLE) * 0.5 AS lon,
         -56.0 + CAST(c_custkey % 59 AS DOUBLE) * 0.5 AS lat
  FROM customer)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body
