"""Column expressions and small operators on hand-made edge rows."""

from pyspark.sql import functions as F

from agrospark.functions import arrays as A
from agrospark.functions import text as TX
from agrospark.operators import climate as C
from agrospark.operators import geo as G


def test_mojibake_order_and_non_strings(spark):
    df = spark.createDataFrame([("maÃ­z Ã±andÃº", 3, "caÃ³n Ã")], "a string, b int, c string")
    r = TX.repair_mojibake_all(df).first()
    assert r.a == "maíz ñandú" and r.b == 3 and r.c == "caón í"


def test_half_even_vs_half_up(spark):
    r = spark.range(1).select(F.bround(F.lit(0.125), 2).alias("e"),
                              F.round(F.lit(0.125), 2).alias("u")).first()
    assert (r.e, r.u) == (0.12, 0.13)


def test_prices(spark):
    df = spark.createDataFrame([
        (["x", "s/c", "100"], ["1", "2", "3"]), (["x", "50", "s/c"], ["1", "2", "3"]),
        (["x", "s/c", "s/c"], ["1", "2", "3"]), (["x", "s/c", "s/c"], ["1", "s/c", "3"]),
        (["x", "s/c", "s/c"], ["1", "s/c", "s/c"])], "ars array<string>, usd array<string>")
    got = [r[0] for r in df.select(TX.first_quoted_price("ars", "usd")).collect()]
    assert got == [100, 50, 2 * 1359, 3 * 1359, 0]
    t = spark.createDataFrame([("$ 785.715,00",)], "t string")
    assert t.select(TX.price_text_to_number("t")).first()[0] == 785715


def test_pad_front_and_list_text(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([],), ([float(i) for i in range(20)],)],
                               "a array<double>")
    got = [r[0] for r in df.select(A.pad_front("a", 4)).collect()]
    assert got == [[None, None, 1.0, 2.0], [], [16.0, 17.0, 18.0, 19.0]]
    t = spark.createDataFrame([("[1.0, nan, 2]",)], "t string")
    assert t.select(TX.parse_list_text("t")).first()[0] == [1.0, None, 2.0]


def test_point_in_polygon_edges(spark):
    # concave L ring; overlapping box later in order; boundary point; outside point
    ell = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 5), (0, 5)]
    box = [(0, 0), (10, 0), (10, 10), (0, 10)]
    polys = spark.createDataFrame(
        [(0, "L", "P1", [{"lon": float(x), "lat": float(y)} for x, y in ell]),
         (1, "B", "P2", [{"lon": float(x), "lat": float(y)} for x, y in box])],
        "poly_order int, nam string, fna string, ring array<struct<lon:double,lat:double>>")
    pts = spark.createDataFrame(
        [(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 4.0, 1.0), (4, 20.0, 20.0), (5, 0.0, 0.0)],
        "point_id int, lon double, lat double")
    got = {r.point_id: (r.departamento_nombre, r.provincia_nombre)
           for r in G.locate_points(pts, polys, cell=3.0).collect()}
    assert got == {1: ("L", "P1"), 2: ("B", "P2"), 3: ("B", "P2"),
                   4: ("No determinado", "No determinada"), 5: ("No determinado", "No determinada")}


def test_area_and_centroid(spark):
    ring = [{"lon": 0.0, "lat": 0.0}, {"lon": 1.0, "lat": 0.0}, {"lon": 1.0, "lat": 1.0},
            {"lon": 0.0, "lat": 1.0}]
    df = spark.createDataFrame([(ring,), (ring[:2],)], "r array<struct<lon:double,lat:double>>")
    rows = df.select(A.ring_area_m2("r").alias("a"), A.ring_centroid("r").alias("c")).collect()
    import math
    assert abs(rows[0].a - 111320.0 ** 2 * math.cos(math.radians(0.5))) < 1e-3
    assert rows[1].a == 0.0 and rows[0].c.lon == 0.5


def test_monthly_rollup_nulls(spark):
    df = spark.createDataFrame(
        [("s", "2020-01-01", None, None), ("s", "2020-01-02", None, None),
         ("s", "2020-02-01", 1.0, 2.0), ("s", "2020-02-02", 2.0, -999.0)],
        "site string, fecha string, t double, rain double")
    df = df.withColumn("fecha", F.to_date("fecha"))
    out = C.monthly_rollup(C.daily_readings(df, ["t", "rain"]), "site", "fecha", ["t"], ["rain"])
    got = {str(r.fecha): (r.t, r.rain) for r in out.collect()}
    assert got == {"2020-01-01": (None, 0.0), "2020-02-01": (1.5, 2.0)}


def test_previous_months_window(spark):
    months = spark.createDataFrame(
        [("s", f"{2000 + (m - 1) // 12}-{(m - 1) % 12 + 1:02d}-01", float(m)) for m in range(1, 21)],
        "site string, fecha string, v double").withColumn("fecha", F.to_date("fecha"))
    req = spark.createDataFrame([("s", 2001), ("s", 2002), ("s", 2000), ("t", 2002)],
                                "site string, anio int")
    got = {(r.site, r.anio): r.v for r in
           C.previous_months(months, req, "site", "fecha", "anio", ["v"], n=14).collect()}
    assert got[("s", 2001)] == [None, None] + [float(m) for m in range(1, 13)]
    assert got[("s", 2002)] == [float(m) for m in range(7, 21)]
    assert got[("s", 2000)] == [] and got[("t", 2002)] == []


def test_tours_keep_fractional_coordinates(spark):
    from agrospark.operators import tours
    pts = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 0.9, 0.0), (1, 2, 0.4, 0.0)],
                                "instance_id long, idx int, x double, y double")
    got = {r["origin"]: r for r in tours.nearest_neighbour_tours(pts).collect()}
    assert abs(got[0]["total"] - 1.8) < 1e-12 and list(got[0]["tour"]) == [0, 2, 1, 0]


def test_bit_objective_follows_the_gene_count(spark):
    from agrospark.operators import evolution
    df = spark.sql("SELECT array(transform(sequence(1, 40), x -> 1), transform(sequence(1, 40), x -> 0)) AS pop")
    assert list(evolution.bits_objective(df).first()["obj"]) == [1.0, 0.0]


def test_greedy_takes_items_without_a_measure_first(spark):
    from agrospark.operators import knapsack
    items = spark.createDataFrame([(1, 0, 5, 10), (1, 1, 0, 3), (1, 2, 6, 50)],
                                  "instance_id long, pos int, measure long, value long")
    cap = spark.createDataFrame([(1, 6)], "instance_id long, capacity long")
    r = knapsack.greedy(items, cap).first()
    assert (r["greedy_value"], r["greedy_items"]) == (53, "2,3")
