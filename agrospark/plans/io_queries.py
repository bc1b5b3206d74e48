"""Source/sink and small-expression queries: CSV round trip, historic crop
cleaning, field geometry, array text widening, distance matrix, day
snapshots, calendar expressions, head/top-k, random instances."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as TX
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import geo as G
from ..operators import knapsack as K
from ..session import cut_lineage, read_table, scratch_path
from ..sources import readers as RD
from ..sources import sinks as SK
from . import tables as T
from .registry import register
from .tables import R, with_ctes

ORDERS_CSV_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
                     "o_totalprice DOUBLE, o_orderdate DATE, o_orderpriority STRING")


@register("orders_csv_roundtrip", covers=("S1", "S3", "S11"), sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""")
def orders_csv_roundtrip(spark, d):
    """Write orders as 10 CSV files (stage output), read every ``*.csv`` back
    with an explicit schema."""
    path = scratch_path(spark, "orders-csv")
    src = read_table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    SK.write_table(src.repartition(10), path, "csv")
    back = RD.read_csv(spark, f"{path}/*.csv", ORDERS_CSV_SCHEMA, with_file_name=True)
    return back.drop("source_file")


HIST_RENAME = {"cultivo": "cultivo_nombre", "sup_sembrada": "superficie_sembrada_ha",
               "sup_cosechada": "superficie_cosechada_ha", "produccion": "produccion_tn",
               "rendimiento": "rendimiento_kgxha"}


@register("historic_crop_union", covers=("P2", "P5", "P6", "P11", "U1"), sql=with_ctes(
    T.SQL_CROP_HISTORY, body=f"""
SELECT cultivo_nombre, anio, departamento_nombre, superficie_sembrada_ha, produccion_tn,
       'current' AS source FROM crop_history
UNION ALL
SELECT cultivo_nombre, TRY_CAST(split_part(ciclo, '/', 1) AS INTEGER) AS anio, departamento_nombre,
       TRY_CAST(CASE WHEN sup IN ('SD', 'sin datos', '', ' ', 'null', 'NULL', 'NaN', 'nan', 'None')
                     THEN NULL ELSE sup END AS DOUBLE) AS superficie_sembrada_ha,
       produccion_tn, 'historic' AS source
FROM (SELECT cultivo_nombre, departamento_nombre, produccion_tn,
             CASE WHEN anio % 3 = 0 THEN CAST(anio AS VARCHAR)
                  ELSE CAST(anio AS VARCHAR) || '/' || CAST(anio + 1 AS VARCHAR) END AS ciclo,
             CASE WHEN anio % 4 = 0 THEN 'SD' ELSE CAST(superficie_sembrada_ha AS VARCHAR) END AS sup
      FROM crop_history)"""))
def historic_crop_union(spark, d):
    cur = T.crop_history(spark, d)
    hist = cur.select(
        F.col("cultivo_nombre").alias("cultivo"), "departamento_nombre",
        F.col("produccion_tn").alias("produccion"),
        F.when(F.col("anio") % 3 == 0, F.col("anio").cast("string"))
         .otherwise(F.concat_ws("/", F.col("anio").cast("string"), (F.col("anio") + 1).cast("string")))
         .alias("ciclo"),
        F.when(F.col("anio") % 4 == 0, F.lit("SD"))
         .otherwise(F.col("superficie_sembrada_ha").cast("string")).alias("sup_sembrada"))
    hist = (CL.rename_present(hist, HIST_RENAME)
              .transform(CL.null_invalid_tokens)
              .withColumn("anio", TX.season_start_year("ciclo"))
              .transform(lambda x: CL.cast_columns(x, {"superficie_sembrada_ha": "double"}))
              .withColumn("source", F.lit("historic")))
    cur = cur.withColumn("source", F.lit("current"))
    cols = ["cultivo_nombre", "anio", "departamento_nombre", "superficie_sembrada_ha",
            "produccion_tn", "source"]
    return CL.union_files([cur.select(*cols), hist.select(*cols)])


def _field_text(pts):
    """Quadrilateral fields around each customer point as coordinate text;
    odd keys use tuple brackets, some are invalid on purpose."""
    k = F.col("point_id")
    d = (F.lit(1) + k % 5).cast("double") / 64.0
    lat = F.when(k % 17 == 0, F.lit(91.0)).otherwise(F.col("lat"))
    lon = F.col("lon")

    def pair(a, b):
        return F.concat(F.lit("["), a.cast("string"), F.lit(", "), b.cast("string"), F.lit("]"))
    four = F.concat_ws(", ", pair(lat, lon), pair(lat, lon + d), pair(lat + d, lon + d),
                       pair(lat + d, lon))
    two = F.concat_ws(", ", pair(lat, lon), pair(lat, lon + d))
    txt = F.concat(F.lit("["), F.when(k % 19 == 0, two).otherwise(four), F.lit("]"))
    txt = F.when(k % 2 == 1, F.translate(txt, "[]", "()")).otherwise(txt)
    return pts.select("point_id", txt.alias("coords_text"))


SQL_FIELDS = """
f_base AS (
  SELECT point_id, lon, CASE WHEN point_id % 17 = 0 THEN 91.0 ELSE lat END AS lat,
         CAST(1 + point_id % 5 AS DOUBLE) / 64.0 AS d, point_id % 19 = 0 AS two
  FROM points),
f_pts AS (
  SELECT point_id, CASE WHEN two THEN [[lat, lon], [lat, lon + d]]
                        ELSE [[lat, lon], [lat, lon + d], [lat + d, lon + d], [lat + d, lon]] END AS c
  FROM f_base),
f_v AS (SELECT point_id, len(c) AS n, unnest(c) AS p, unnest(range(len(c))) AS k, c FROM f_pts),
f_terms AS (
  SELECT v.point_id, v.n, v.p[1] AS lat, v.p[2] AS lon,
         v.p[2] * v.c[((v.k + 1) % v.n) + 1][1] - v.c[((v.k + 1) % v.n) + 1][2] * v.p[1] AS t
  FROM f_v v)"""


@register("field_geometry", covers=("S6", "P16", "A3", "A4", "P7", "P17"), sql=with_ctes(
    T.SQL_POINTS, SQL_FIELDS, body=f"""
SELECT point_id,
       n >= 3 AND bool_and(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) AS is_valid,
       {R('avg(lat)', 6)} AS centro_lat, {R('avg(lon)', 6)} AS centro_lon,
       {R('CASE WHEN n < 3 THEN 0.0 ELSE abs(sum(t)) / 2.0 * 111320.0 * 111320.0 * cos(radians(avg(lat))) END', 0)} AS area_m2
FROM f_terms GROUP BY point_id, n"""))
def field_geometry(spark, d):
    f = G.field_geometry(_field_text(T.customer_points(spark, d)), "coords_text")
    return f.select("point_id", "is_valid", F.bround("centro.lat", 6).alias("centro_lat"),
                    F.bround("centro.lon", 6).alias("centro_lon"),
                    F.bround("area_m2", 0).alias("area_m2"))


@register("embedding_text_widening", covers=("R1", "R2", "R3"), sql="""
SELECT vec_id, label, """ + ", ".join(
    f"{R(f'CAST(CAST(embedding[{i}] AS VARCHAR) AS DOUBLE)', 6)} AS embedding_{i}" for i in range(1, 65))
    + " FROM embeddings")
def embedding_text_widening(spark, d):
    e = read_table(spark, d, "embeddings").select(
        "vec_id", "label", F.to_json("embedding").alias("embedding"))
    parsed = FE.parse_array_text(e)          # R1 detects the column, R2 parses it
    wide = FE.widen_arrays(parsed, ["embedding"])
    return wide.select("vec_id", "label", *[F.bround(f"embedding_{i}", 6).alias(f"embedding_{i}")
                                            for i in range(1, 65)])


@register("nation_distance_edges", covers=("S10",), sql=with_ctes(T.SQL_POINTS, body=f"""
, cen AS (SELECT c.c_nationkey AS k, avg(p.lon) AS x, avg(p.lat) AS y
          FROM customer c JOIN points p ON p.point_id = c.c_custkey GROUP BY 1)
SELECT CAST(a.k AS INTEGER) AS src, CAST(b.k AS INTEGER) AS dst,
       {R('sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) * 111.32', 4)} AS km
FROM cen a, cen b"""))
def nation_distance_edges(spark, d):
    """A distance matrix file between nation centroids (a label, the row's number and a
    column per destination), written and read back by Spark, turned into edges."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    pts = T.customer_points(spark, d)
    cen = (c.join(pts, c.c_custkey == pts.point_id).groupBy("c_nationkey")
            .agg(F.avg("lon").alias("x"), F.avg("lat").alias("y")))
    sites = cut_lineage(cen.select(F.col("c_nationkey").alias("k"), "x", "y"), "sites")
    # the matrix row of a site needs all sites: they travel as one row, as long as a matrix row
    row = sites.agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("all"))
    km = F.transform("all", lambda o: (F.sqrt((F.col("x") - o.x) ** 2 + (F.col("y") - o.y) ** 2) * 111.32).cast("string"))
    path = scratch_path(spark, "matrix")
    (sites.join(row, F.lit(True)).select(F.concat_ws(";", F.concat(F.lit("nation "), F.col("k")),
                                                     F.array_position("all", F.struct("k", "x", "y")) - 1, F.array_join(km, ";")))
          .write.text(path))
    wide = spark.read.option("sep", ";").csv(path).withColumnsRenamed({"_c0": "label", "_c1": "row_idx"})
    e = RD.distance_edges(wide, "label")
    keys = row.select(F.posexplode("all.k").alias("dst", "key"))
    return (e.join(keys, "dst").select("src", F.col("key").alias("dst"), "km")
             .join(keys.select(F.col("dst").alias("src"), F.col("key").alias("from")), "src")
             .select(F.col("from").alias("src"), F.col("dst").cast("int").alias("dst"), F.bround("km", 4).alias("km")))


@register("price_snapshot_day", covers=("S12", "F9"), sql=f"""
SELECT CAST(ts AS DATE) AS fecha, event_type AS cultivo_nombre,
       {R('avg(value)', 2)} AS precio_x_tonelada
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1, 2""")
def price_snapshot_day(spark, d):
    """Daily price snapshots written with dynamic partition overwrite (other
    days' history kept), then the requested day read back (partition pruned)."""
    ev = read_table(spark, d, "events").select("ts", "event_type", "value")
    snap = (ev.groupBy(F.col("ts").cast("date").alias("fecha"),
                       F.col("event_type").alias("cultivo_nombre"))
              .agg(F.bround(F.avg("value"), 2).alias("precio_x_tonelada")))
    path = scratch_path(spark, "prices")
    SK.write_snapshot(snap, path, "fecha")
    back = spark.read.parquet(path)
    return back.filter(F.col("fecha") == F.lit("2024-01-15").cast("date")).select(
        F.col("fecha").cast("date").alias("fecha"), "cultivo_nombre", "precio_x_tonelada")


SEASON_CROPS = ["economy", "large", "medium", "promo"]


@register("season_calendar", covers=("P18", "P19", "P20", "F3", "P9"), sql=with_ctes(
    T.SQL_CROP_HISTORY, body=f"""
SELECT cultivo_nombre, anio, departamento_nombre,
       CASE WHEN cultivo_nombre IN ({', '.join(f"'{c}'" for c in SEASON_CROPS)}) THEN 2025 ELSE 2026 END
         AS season_year,
       make_date(anio - 1, 12, 31) AS climate_bound,
       CAST(make_date(anio - 1, 12, 31) + INTERVAL 1 MONTH AS DATE) AS first_forecast_month,
       CAST(make_date(anio, 1, 1) - INTERVAL (365 * 14) DAY AS DATE) AS lookback_start,
       CAST(month(make_date(anio - 1, 12, 31)) AS INTEGER) AS bound_month
FROM crop_history"""))
def season_calendar(spark, d):
    c = T.crop_history(spark, d)
    bound = D.planting_bound("anio")
    return c.select(
        "cultivo_nombre", "anio", "departamento_nombre",
        F.when(F.col("cultivo_nombre").isin(*SEASON_CROPS), F.lit(2025)).otherwise(F.lit(2026))
         .alias("season_year"),
        bound.alias("climate_bound"), D.next_month(bound).alias("first_forecast_month"),
        D.lookback_start(F.make_date("anio", F.lit(1), F.lit(1)), 14).alias("lookback_start"),
        F.month(bound).alias("bound_month"))


@register("first_orders_per_customer", covers=("F6", "O1"), sql="""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn <= 3""")
def first_orders_per_customer(spark, d):
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey",
                                             F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return CL.head_by(o, 3, ["o_orderdate", "o_orderkey"], ["o_custkey"])


@register("top_orders_by_price", covers=("O3", "F6"), sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_orders_by_price(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@register("random_knapsack_instances", covers=("G18",), sql="""
WITH k AS (
  SELECT o_orderkey AS instance_id,
         CAST(1 + floor((('0x' || substr(md5(concat_ws('|', '0', CAST(o_orderkey AS VARCHAR), 'n')), 1, 8))::BIGINT / 4294967296.0) * 20) AS INTEGER) AS n_items,
         CAST(1 + floor((('0x' || substr(md5(concat_ws('|', '0', CAST(o_orderkey AS VARCHAR), 'cap')), 1, 8))::BIGINT / 4294967296.0) * 10000) AS INTEGER) AS capacity
  FROM orders),
it AS (
  SELECT instance_id, capacity, pos,
         CAST(1 + floor((('0x' || substr(md5(concat_ws('|', '0', CAST(instance_id AS VARCHAR), CAST(pos AS VARCHAR), 'm')), 1, 8))::BIGINT / 4294967296.0) * capacity) AS INTEGER) AS measure,
         CAST(1 + floor((('0x' || substr(md5(concat_ws('|', '0', CAST(instance_id AS VARCHAR), CAST(pos AS VARCHAR), 'p')), 1, 8))::BIGINT / 4294967296.0) * 200) AS INTEGER) AS value
  FROM k, range(0, n_items) t(pos))
SELECT instance_id, capacity, count(*) AS n_items, sum(measure) AS total_measure,
       sum(value) AS total_value
FROM it GROUP BY 1, 2""")
def random_knapsack_instances(spark, d):
    keys = read_table(spark, d, "orders").select("o_orderkey")
    it = K.random_instances(keys, "o_orderkey")
    return it.groupBy("instance_id", "capacity").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("measure").alias("total_measure"),
        F.sum("value").alias("total_value"))


@register("customer_latin1_semicolon_csv", covers=("S2", "S4", "P6"), sql="""
SELECT c_custkey, concat('Año ', c_name, ' é') AS c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal
FROM customer""")
def customer_latin1_semicolon_csv(spark, d):
    """Land customers as a ``;``-separated, quoted, Latin-1 file with ragged
    empty trailing header cells and ``s/i`` for missing values, then read it
    back: unnamed columns dropped, ``s/i`` -> NULL, text cast with try_cast."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    out = c.select("c_custkey", F.concat(F.lit("Año "), "c_name", F.lit(" é")).alias("c_name"), "c_nationkey",
                   F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal"))
                    .alias("c_acctbal"),
                   F.lit(None).cast("string").alias(""), F.lit(None).cast("string").alias(" "))
    path = scratch_path(spark, "semicolon-csv")
    (out.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
        .option("nullValue", "s/i").option("quoteAll", True).csv(path))
    back = RD.read_semicolon_csv(spark, path, encoding="ISO-8859-1")
    return CL.cast_columns(back, {"c_custkey": "bigint", "c_nationkey": "int",
                                  "c_acctbal": "double"})


@register("field_centroid_text", covers=("S8", "A3"), sql=with_ctes(T.SQL_POINTS, body=f"""
SELECT c.c_nationkey AS nationkey, {R('avg(p.lon)', 6)} AS lon, {R('avg(p.lat)', 6)} AS lat
FROM customer c JOIN points p ON p.point_id = c.c_custkey GROUP BY 1"""))
def field_centroid_text(spark, d):
    """Department centroids stored as ``"(lon, lat)"`` text (the reference's
    CSV cell) and parsed back into a (lon, lat) struct."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    pts = T.customer_points(spark, d)
    cen = (c.join(pts, c.c_custkey == pts.point_id).groupBy(F.col("c_nationkey").alias("nationkey"))
            .agg(F.bround(F.avg("lon"), 6).alias("x"), F.bround(F.avg("lat"), 6).alias("y")))
    txt = cen.select("nationkey", F.format_string("(%s, %s)", F.col("x").cast("string"),
                                                  F.col("y").cast("string")).alias("coords"))
    parsed = RD.parse_pairs(txt, "coords", "c")
    return parsed.select("nationkey", F.col("c.lon").alias("lon"), F.col("c.lat").alias("lat"))


@register("field_records_json", covers=("S16", "J4", "A4"), sql=None)
def field_records_json(spark, d):
    """One JSON document per customer field (nested centro, department,
    area in m2 and hectares, request date)."""
    pts = T.customer_points(spark, d)
    geo = G.field_geometry(_field_text(pts), "coords_text").filter("is_valid")
    loc = G.locate_points(geo.join(pts, "point_id"), T.department_polygons(spark, d))
    rec = loc.withColumn("coords", F.col("coords_text")).withColumn(
        "fecha", F.lit("2025-08-12").cast("date"))
    return SK.field_records_json(rec)
