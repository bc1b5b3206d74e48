"""Polygon layers: GeoJSON in, holes and parts, edges, split cells against brute force."""

import json
import math
import random

import pytest

from agrospark.operators.polygons import cell_tree, locate_in_layer
from agrospark.session import scratch_path
from agrospark.sources.readers import read_polygon_layer


def _feature(order, nam, kind, coordinates):
    return json.dumps({"type": "Feature", "properties": {"poly_order": order, "nam": nam, "fna": "P"},
                       "geometry": {"type": kind, "coordinates": coordinates}})


def _layer(spark, features, collection=False):
    path = scratch_path(spark, "geojson")
    rows = [json.dumps({"type": "FeatureCollection", "features": [json.loads(f) for f in features]}, indent=1)] if collection else features
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    return read_polygon_layer(spark, path, ("poly_order", "nam", "fna"), collection).selectExpr(
        "CAST(poly_order AS LONG) poly_order", "nam", "fna", "parts")


BOX = [[0, 0], [8, 0], [8, 8], [0, 8], [0, 0]]
HOLE = [[2, 2], [2, 6], [6, 6], [6, 2], [2, 2]]
ISLAND = [[3, 3], [5, 3], [5, 5], [3, 5], [3, 3]]


@pytest.mark.parametrize("collection", [False, True])
def test_holes_parts_edges_and_defaults(spark, collection):
    layer = _layer(spark, [_feature(2, "b", "MultiPolygon", [[BOX, HOLE], [ISLAND]]), _feature(1, "a", "Polygon", [[[7, 7], [9, 7], [9, 9], [7, 9]]]),
                           _feature(3, "none", "Point", [1, 1]), _feature(4, "thin", "Polygon", [[[1, 1], [2, 2]]]), _feature(5, "empty", "MultiPolygon", [])], collection)
    want = {(1.0, 1.0): "b", (2.5, 2.5): None, (4.0, 4.0): "b", (3.0, 4.0): None, (2.0, 4.0): None, (0.0, 4.0): None, (8.0, 7.5): "a",
            (7.5, 7.5): "a", (7.0, 7.5): "b", (8.5, 8.5): "a", (20.0, 1.0): None, (6.0, 7.0): "b", (-1.0, 0.0): None,
            (None, 1.0): None, (float("nan"), 1.0): None, (1.0, float("inf")): None}
    pts = spark.createDataFrame([(x, y, "kept") for x, y in want] + [(1.0, 1.0, "kept")], "lon double, lat double, departamento_nombre string")
    for most, depth in ((64, 10), (4, 2)):
        got = [(r["lon"], r["lat"], r["departamento_nombre"]) for r in locate_in_layer(pts, layer, cell=4.0, most_edges=most, depth=depth).collect()]
        assert sorted(map(str, got)) == sorted(str((x, y, want[x, y] or "No determinado")) for x, y in [*want, (1.0, 1.0)])


def test_split_cells_agree_with_brute_force(spark):
    rnd = random.Random(5)
    rings = []
    for n in range(6):                                       # stars of many corners that overlap
        cx, cy, corners = rnd.uniform(-3, 3), rnd.uniform(-3, 3), 12 * (n + 1)
        rings.append([[cx + math.cos(2 * math.pi * i / corners) * r, cy + math.sin(2 * math.pi * i / corners) * r]
                      for i, r in enumerate(rnd.uniform(1.5, 3) for _ in range(corners))])
    layer = _layer(spark, [_feature(n, f"d{n}", "Polygon", [r]) for n, r in enumerate(rings)])
    splits, leaves = cell_tree(layer, ("nam", "fna"), cell=1.0, most_edges=24)
    assert splits.count() > 5 and leaves.selectExpr("max(level) m").first()["m"] >= 1
    pts = [(rnd.uniform(-7, 7), rnd.uniform(-7, 7)) for _ in range(3000)] + [tuple(r[0]) for r in rings]

    def within(ring, x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return False
            odd ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
        return odd
    want = [next((f"d{n}" for n, r in enumerate(rings) if within(r, x, y)), "No determinado") for x, y in pts]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "i int, lon double, lat double")
    got = [r["departamento_nombre"] for r in locate_in_layer(df, layer, most_edges=24).orderBy("i").collect()]
    assert got == want and len(set(want)) > 5


def test_empty_layer_empty_points_and_a_cell_that_is_no_power_of_two(spark):
    layer = _layer(spark, [_feature(1, "a", "Polygon", [BOX])])
    pts = spark.createDataFrame([(1.0, 1.0)], "lon double, lat double")
    assert locate_in_layer(pts, layer.limit(0)).first()["provincia_nombre"] == "No determinada"
    assert locate_in_layer(pts.limit(0), layer).count() == 0
    with pytest.raises(ValueError):
        locate_in_layer(pts, layer, cell=0.3)
