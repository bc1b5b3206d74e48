"""Spatial operators: point-in-polygon join (J4), group means with centroid
(A2), point-set centroid (A3), field area (A4), coordinate validation (P16).

J4 plan: polygons are cut into grid cells by bounding box; each cell keeps
the (small) array of candidate polygons in polygon order; points equi-join
on their cell and keep the first candidate that strictly contains them.  No
nested-loop join, no per-point shuffle afterwards, and a point with no
candidate keeps its row with the default labels (left join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import point_in_ring, ring_area_m2, ring_centroid, ring_is_valid
from ..functions.text import NO_DEPARTMENT, NO_PROVINCE


def polygon_cells(polygons: DataFrame, ring: str = "ring", cell: float = 1.0,
                  order: str = "poly_order", labels: tuple[str, ...] = ("nam", "fna")
                  ) -> DataFrame:
    """Grid cells covered by each polygon's bounding box -> candidate arrays."""
    xs = F.transform(ring, lambda p: p.lon)
    ys = F.transform(ring, lambda p: p.lat)
    b = polygons.select(order, *labels, ring,
                        F.floor(F.array_min(xs) / cell).alias("_x0"),
                        F.floor(F.array_max(xs) / cell).alias("_x1"),
                        F.floor(F.array_min(ys) / cell).alias("_y0"),
                        F.floor(F.array_max(ys) / cell).alias("_y1"))
    cells = (b.withColumn("_cx", F.explode(F.sequence("_x0", "_x1")))
              .withColumn("_cy", F.explode(F.sequence("_y0", "_y1"))))
    return (cells.groupBy("_cx", "_cy")
                 .agg(F.array_sort(F.collect_list(F.struct(order, *labels, ring))).alias("_cands")))


def locate_points(points: DataFrame, polygons: DataFrame, lon: str = "lon", lat: str = "lat",
                  cell: float = 1.0, order: str = "poly_order",
                  labels: tuple[str, str] = ("nam", "fna"),
                  out: tuple[str, str] = ("departamento_nombre", "provincia_nombre"),
                  ring: str = "ring", few_polygons: bool = False) -> DataFrame:
    """First polygon (in ``order``) strictly containing each point.

    Boundary points are outside; a point in no polygon gets the default
    labels.  Every input row is kept exactly once.  ``few_polygons``: the layer is small
    by its schema, so its cells are broadcast and the points stay in their tasks.
    """
    cells = polygon_cells(polygons, ring, cell, order, labels)
    cells = F.broadcast(cells) if few_polygons else cells
    p = points.withColumn("_cx", F.floor(F.col(lon) / cell)).withColumn(
        "_cy", F.floor(F.col(lat) / cell))
    j = p.join(cells, ["_cx", "_cy"], "left")
    hits = F.filter(F.coalesce(F.col("_cands"), F.array_sort(F.array().cast(
        cells.schema["_cands"].dataType))), lambda c: point_in_ring(c[ring], F.col(lon), F.col(lat)))
    first = F.try_element_at(hits, F.lit(1))
    return (j.withColumn("_hit", first)
             .withColumn(out[0], F.coalesce(F.col("_hit")[labels[0]], F.lit(NO_DEPARTMENT)))
             .withColumn(out[1], F.coalesce(F.col("_hit")[labels[1]], F.lit(NO_PROVINCE)))
             .drop("_cx", "_cy", "_cands", "_hit"))


def partial_sums(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Decomposable pre-aggregate for means: per key, sum and non-null count.

    Used to collapse a large, possibly skewed table on its join key *before*
    the join (a hot key becomes one row).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        aggs += [F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    return df.groupBy(*keys).agg(*aggs)


def combine_means(partials: DataFrame, keys: list[str], cols: list[str], scale: int = 2
                  ) -> DataFrame:
    """Finish :func:`partial_sums`: mean = sum(sums) / sum(counts), half-even."""
    aggs = [F.sum("_rows").alias("n_rows")]
    for c in cols:
        aggs.append(F.bround(F.sum(f"_s_{c}") / F.sum(f"_n_{c}"), scale).alias(c))
    return partials.groupBy(*keys).agg(*aggs)


def group_means_with_centroid(df: DataFrame, key: str, cols: list[str], lon: str, lat: str,
                              scale: int = 2, coord_scale: int = 4) -> DataFrame:
    """A2: per group, the mean of every numeric column and the centroid."""
    aggs = [F.bround(F.avg(c), scale).alias(c) for c in cols]
    aggs.append(F.struct(F.bround(F.avg(lon), coord_scale).alias("lon"),
                         F.bround(F.avg(lat), coord_scale).alias("lat")).alias("coords"))
    return df.groupBy(key).agg(*aggs)


def field_geometry(df: DataFrame, coords: str = "coords_text", scale: int = 2) -> DataFrame:
    """S6 + P16 + A3 + A4 + P7: parse a field's vertex list ([lat, lon]
    pairs), validate it, and add centroid, area in m2 and hectares."""
    from ..functions.arrays import coords_to_ring
    from ..functions.text import parse_coordinate_list
    parsed = parse_coordinate_list(coords)
    ring = coords_to_ring(parsed, lat_first=True)
    return (df.withColumn("_c", parsed)
              .withColumn("is_valid", ring_is_valid("_c"))
              .withColumn("_ring", ring)
              .withColumn("centro", ring_centroid("_ring"))
              .withColumn("area_m2", ring_area_m2("_ring"))
              .withColumn("area_ha", F.col("area_m2") / 10000.0)
              .drop("_c", "_ring"))


def centroid_of(ring: Column, closed: bool = False) -> Column:
    """A3 re-export for callers that work on ring columns."""
    return ring_centroid(ring, closed)
