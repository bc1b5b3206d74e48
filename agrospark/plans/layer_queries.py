"""Points located in a polygon layer read from GeoJSON.

The layer has one feature a nation: even nations are MultiPolygons (a box with a saw-toothed
northern coast and a hole, and an island within the hole), odd ones Polygons of the same box.
Nation 1 overlaps nation 0.  All coordinates are dyadic, so edge tests are exact.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.polygons import locate_in_layer
from ..session import read_table, scratch_path
from ..sources.readers import read_polygon_layer
from .registry import register
from .tables import with_ctes

SQL_LAYER = """
layer_base AS (
  SELECT n.n_nationkey AS poly_order, n.n_name AS nam, r.r_name AS fna,
         -75.0::DOUBLE + (n.n_nationkey % 5) * 4 - CASE WHEN n.n_nationkey = 1 THEN 1 ELSE 0 END AS x0,
         -55.0::DOUBLE + (n.n_nationkey // 5) * 5 AS y0
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
layer_rings AS (
  SELECT poly_order, nam, fna, unnest([
    {'part': 0, 'pts': list_concat([[x0, y0], [x0 + 4, y0], [x0 + 4, y0 + 5]],
       [[x0 + 4 - k / 32.0::DOUBLE, y0 + 5 - (k % 2) / 8.0::DOUBLE] for k in range(1, 128)], [[x0, y0 + 5]])},
    {'part': 0, 'pts': [[x0 + 1, y0 + 1], [x0 + 1, y0 + 3], [x0 + 3, y0 + 3], [x0 + 3, y0 + 1]]},
    {'part': 1, 'pts': [[x0 + 1.5, y0 + 1.5], [x0 + 2.5, y0 + 1.5], [x0 + 2, y0 + 2.5]]}]) AS g
  FROM layer_base),
layer_edges AS (
  SELECT poly_order, nam, fna, g.part AS part, g.pts[i][1] AS ax, g.pts[i][2] AS ay,
         g.pts[i % len(g.pts) + 1][1] AS bx, g.pts[i % len(g.pts) + 1][2] AS by
  FROM (SELECT *, unnest(range(1, len(g.pts) + 1)) AS i FROM layer_rings WHERE poly_order % 2 = 0 OR g.part = 0)),
layer_points AS (
  SELECT o_orderkey AS point_id, -76.0::DOUBLE + (o_orderkey % 353) / 16.0::DOUBLE AS lon,
         -56.0::DOUBLE + (o_orderkey * 7 % 481) / 16.0::DOUBLE AS lat FROM orders),
layer_parts AS (
  SELECT p.point_id, e.poly_order, e.nam, e.fna, e.part,
         bool_or((e.bx - e.ax) * (p.lat - e.ay) = (e.by - e.ay) * (p.lon - e.ax)
                 AND p.lon BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx)
                 AND p.lat BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by)) AS on_edge,
         count(*) FILTER ((e.ay > p.lat) <> (e.by > p.lat)
                          AND p.lon < (e.bx - e.ax) * (p.lat - e.ay) / (e.by - e.ay) + e.ax) AS n_cross
  FROM layer_points p JOIN layer_base b ON p.lon BETWEEN b.x0 AND b.x0 + 4 AND p.lat BETWEEN b.y0 AND b.y0 + 5
  JOIN layer_edges e ON e.poly_order = b.poly_order GROUP BY ALL),
layer_first AS (
  SELECT point_id, arg_min(nam, poly_order) AS nam, arg_min(fna, poly_order) AS fna
  FROM layer_parts WHERE NOT on_edge AND n_cross % 2 = 1 GROUP BY 1)"""


def _vertex(x, y):
    return F.array(x.cast("double"), y.cast("double"))


def _features(spark, d):
    """The layer as GeoJSON feature texts."""
    n, r = read_table(spark, d, "nation"), read_table(spark, d, "region")
    k = F.col("n_nationkey")
    x = F.lit(-75.0) + (k % 5) * 4 - F.when(k == 1, 1).otherwise(0)
    y = F.lit(-55.0) + F.floor(k / 5) * 5
    coast = F.transform(F.sequence(F.lit(1), F.lit(127)), lambda i: _vertex(x + 4 - i / F.lit(32.0), y + 5 - (i % 2) / F.lit(8.0)))
    outer = F.concat(F.array(_vertex(x, y), _vertex(x + 4, y), _vertex(x + 4, y + 5)), coast,
                     F.array(_vertex(x, y + 5), _vertex(x, y)))
    hole = F.array(*[_vertex(x + a, y + b) for a, b in ((1, 1), (1, 3), (3, 3), (3, 1), (1, 1))])
    island = F.array(*[_vertex(x + a, y + b) for a, b in ((1.5, 1.5), (2.5, 1.5), (2.0, 2.5), (1.5, 1.5))])
    box = F.array(outer, hole)
    several = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(box, F.array(island)).alias("coordinates")))
    single = F.to_json(F.struct(F.lit("Polygon").alias("type"), box.alias("coordinates")))
    props = F.to_json(F.struct(k.alias("poly_order"), F.col("n_name").alias("nam"), F.col("r_name").alias("fna")))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.concat(
        F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'),
        F.when(k % 2 == 0, several).otherwise(single), F.lit("}")).alias("value"))


@register("points_in_polygon_layer", covers=("S9", "J4"), sql=with_ctes(SQL_LAYER, body="""
SELECT p.point_id, p.lon, p.lat, coalesce(f.nam, 'No determinado') AS departamento_nombre,
       coalesce(f.fna, 'No determinada') AS provincia_nombre
FROM layer_points p LEFT JOIN layer_first f USING (point_id)"""))
def points_in_polygon_layer(spark, d):
    """The layer is written as GeoJSON lines, read back and cut into a cell tree; one point an order."""
    path = scratch_path(spark, "layer")
    _features(spark, d).write.text(path)
    layer = read_polygon_layer(spark, path, ("poly_order", "nam", "fna")).withColumn("poly_order", F.col("poly_order").cast("long"))
    key = F.col("o_orderkey")
    points = read_table(spark, d, "orders").select(key.alias("point_id"), (F.lit(-76.0) + (key % 353) / F.lit(16.0)).alias("lon"),
                                                   (F.lit(-56.0) + (key * 7 % 481) / F.lit(16.0)).alias("lat"))
    return locate_in_layer(points, layer, most_edges=16)
