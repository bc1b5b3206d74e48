"""Soil, geography and training-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as CL
from ..operators import climate as C
from ..operators import features as FE
from ..operators import geo as G
from . import tables as T
from .registry import register
from .tables import R, with_ctes

POINTS_IN_DEPARTMENTS_SQL = """
pip_cands AS (
  SELECT p.point_id, p.lon, p.lat, e.poly_order, e.nam, e.fna,
         bool_or(((e.bx - e.ax) * (p.lat - e.ay) - (e.by - e.ay) * (p.lon - e.ax)) = 0
                 AND p.lon >= least(e.ax, e.bx) AND p.lon <= greatest(e.ax, e.bx)
                 AND p.lat >= least(e.ay, e.by) AND p.lat <= greatest(e.ay, e.by)) AS on_edge,
         sum(CASE WHEN (e.ay > p.lat) <> (e.by > p.lat)
                   AND p.lon < (e.bx - e.ax) * (p.lat - e.ay) / (e.by - e.ay) + e.ax
                  THEN 1 ELSE 0 END) AS n_cross
  FROM points p, polygon_edges e
  GROUP BY ALL),
pip_first AS (
  SELECT point_id, arg_min(nam, poly_order) AS nam, arg_min(fna, poly_order) AS fna
  FROM pip_cands WHERE NOT on_edge AND n_cross % 2 = 1 GROUP BY point_id),
located AS (
  SELECT p.point_id, p.lon, p.lat,
         coalesce(f.nam, 'No determinado') AS departamento_nombre,
         coalesce(f.fna, 'No determinada') AS provincia_nombre
  FROM points p LEFT JOIN pip_first f ON p.point_id = f.point_id)"""


@register("points_in_departments", covers=("J4", "W8"), bench=True, sql=with_ctes(
    T.SQL_POLYGONS, T.SQL_POINTS, POINTS_IN_DEPARTMENTS_SQL, body="SELECT * FROM located"))
def points_in_departments(spark, d):
    pts = T.customer_points(spark, d)
    return G.locate_points(pts, T.department_polygons(spark, d), cell=1.0)


SOIL_KEEP = ["organic_carbon", "ph", "clay", "silt", "sand", "bulk_density"]

SQL_SOIL_MEANS = """
soil_joined AS (
  SELECT s.profile_identifier, s.latitude, s.longitude, l.* EXCLUDE (profile_identifier)
  FROM soil_sites s JOIN soil_layers l ON s.profile_identifier = l.profile_identifier
  WHERE s.country_code = 'ARG'),
points AS (
  SELECT DISTINCT profile_identifier AS point_id, longitude AS lon, latitude AS lat
  FROM soil_sites WHERE country_code = 'ARG'),""" + POINTS_IN_DEPARTMENTS_SQL + f""",
soil_means AS (
  SELECT g.departamento_nombre, count(*) AS n_rows,
         {', '.join(R(f'avg({c})') + f' AS {c}' for c in SOIL_KEEP)},
         {R('avg(j.longitude)', 4)} AS centroid_lon, {R('avg(j.latitude)', 4)} AS centroid_lat
  FROM soil_joined j JOIN located g ON j.profile_identifier = g.point_id
  GROUP BY 1)"""


@register("soil_means_by_department", covers=("J1", "F2", "F5", "A2", "J4"), bench=True,
          sql=with_ctes(T.SQL_SOIL_SITES, T.SQL_SOIL_LAYERS, T.SQL_POLYGONS, SQL_SOIL_MEANS,
                        body="SELECT * FROM soil_means"))
def soil_means_by_department(spark, d):
    """J1 + F2 + F5 + J4 + A2 with the layers pre-aggregated per profile.

    The layer table (largest input) is collapsed to one row per profile
    before any join, so a profile holding a third of all layers costs one
    map-side partial aggregate, not a skewed join partition.  F5 (drop
    columns non-null in < 15 % of joined rows) is one small aggregation.
    """
    sites = T.soil_sites(spark, d).filter(F.col("country_code") == "ARG")
    layers = T.soil_layers(spark, d)
    cols = [c for c in layers.columns if c != "profile_identifier"]
    part = G.partial_sums(layers, ["profile_identifier"], cols)
    joined = part.join(sites.select("profile_identifier", "latitude", "longitude"),
                       "profile_identifier")
    tot = joined.agg(F.sum("_rows").alias("n"),
                     *[F.sum(f"_n_{c}").alias(c) for c in cols]).first()
    dense = [c for c in cols if (tot[c] or 0) >= 0.15 * (tot["n"] or 0)]
    located = G.locate_points(
        joined.withColumnRenamed("longitude", "lon").withColumnRenamed("latitude", "lat"),
        T.department_polygons(spark, d))
    aggs = [F.sum("_rows").alias("n_rows")]
    aggs += [F.bround(F.sum(f"_s_{c}") / F.sum(f"_n_{c}"), 2).alias(c) for c in dense]
    aggs += [F.bround(F.sum(F.col("lon") * F.col("_rows")) / F.sum("_rows"), 4)
             .alias("centroid_lon"),
             F.bround(F.sum(F.col("lat") * F.col("_rows")) / F.sum("_rows"), 4)
             .alias("centroid_lat")]
    return located.groupBy("departamento_nombre").agg(*aggs)
