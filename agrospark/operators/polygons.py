"""Polygon layers with several parts and holes (S9, J4): a cell tree over their edges.

A layer row holds ``parts``: one entry a polygon of a MultiPolygon, each a list of rings,
the first the outer one, the others holes.  A point is in a part when it is on none of its
edges and a ray to the east crosses its rings an odd number of times, and in the layer row
when it is in one of its parts.

Cells start as squares of one size.  A cell keeps of a part only what its points can tell
apart: the edges that touch the cell or that the rays of some of its points cross, and
the number of edges that the rays of all its points cross (``base``).  A part whose edges miss
the cell is wholly around it (kept without edges) or away from it (dropped).  Cells whose
parts still hold more than ``most_edges`` edges split in four, until none is left or cells
are 2^-``depth`` of the first size; the deepest cells keep all their edges, so that depth
costs time and never results.  A point finds its leaf by one equi-join on its first cell,
which names the cells that were split, and meets the candidates by another on the leaf.
"""

from __future__ import annotations

from functools import reduce
from math import frexp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NO_DEPARTMENT, NO_PROVINCE
from ..session import cut_lineage


def _edges(rings: Column) -> Column:
    """All edges of a part's rings; rings may repeat their first vertex at the end."""
    def of_ring(r):
        return F.zip_with(r, F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(1))), F.slice(r, 1, 1)),
                          lambda a, b: F.struct(a.lon.alias("ax"), a.lat.alias("ay"), b.lon.alias("bx"), b.lat.alias("by")))
    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 3), of_ring))


def _crossed(e: Column, x: Column, y: Column) -> Column:
    """Does the ray from (x, y) to the east cross the edge?"""
    meets = x < (e.bx - e.ax) * (y - e.ay) / F.nullif(e.by - e.ay, F.lit(0.0)) + e.ax
    return ((e.ay > y) != (e.by > y)) & F.coalesce(meets, F.lit(False))


def _on(e: Column, x: Column, y: Column) -> Column:
    cross = (e.bx - e.ax) * (y - e.ay) - (e.by - e.ay) * (x - e.ax)
    return ((cross == 0) & x.between(F.least(e.ax, e.bx), F.greatest(e.ax, e.bx))
            & y.between(F.least(e.ay, e.by), F.greatest(e.ay, e.by)))


def _crossings(edges: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(edges, lambda e: _crossed(e, x, y)))


def _settle(cells: DataFrame, size: float) -> DataFrame:
    """Keep of each (cell, part) what the cell's points can tell apart; drop parts away from it."""
    x0, y0 = F.col("cx") * F.lit(size), F.col("cy") * F.lit(size)
    x1, y1 = x0 + F.lit(size), y0 + F.lit(size)

    def right(e):                             # east of every point of the cell (x0 <= x < x1, y0 <= y < y1)
        return F.least(e.ax, e.bx) >= x1

    def always(e):                            # crossed by the ray of every point
        return right(e) & (F.least(e.ay, e.by) <= y0) & (F.greatest(e.ay, e.by) >= y1)

    def touches(e):
        return (~right(e) & (F.greatest(e.ax, e.bx) >= x0)
                & (F.least(e.ay, e.by) < y1) & (F.greatest(e.ay, e.by) >= y0))

    def some(e):                              # crossed by the rays of some points
        return (right(e) & ~always(e) & (e.ay != e.by)
                & (F.least(e.ay, e.by) < y1) & (F.greatest(e.ay, e.by) > y0))
    kept = (cells.withColumn("base", F.col("base") + F.size(F.filter("edges", always)))
            .withColumn("edges", F.filter("edges", lambda e: touches(e) | some(e))))
    touched = F.exists("edges", touches)
    whole = F.col("base") + _crossings(F.col("edges"), x0, y0)        # one answer for all points if nothing touches
    return (kept.withColumn("_touched", touched)
            .withColumn("base", F.when(F.col("_touched"), F.col("base")).otherwise(whole))
            .withColumn("edges", F.when(F.col("_touched"), F.col("edges")).otherwise(F.slice("edges", 1, 0)))
            .where(F.col("_touched") | (F.col("base") % 2 == 1)).drop("_touched"))


def cell_tree(layer: DataFrame, labels: tuple[str, ...], order: str = "poly_order", cell: float = 1.0,
              most_edges: int = 64, depth: int = 10) -> tuple[DataFrame, DataFrame]:
    """(splits, leaves) of a layer.

    ``splits``: (rx, ry, split), the split cells below each first cell, as (level, cx, cy).
    ``leaves``: (level, cx, cy, candidates), candidates in the order of ``order``.
    ``cell`` must be a power of two, so that a coordinate's cell is exact at every level.
    """
    if frexp(cell)[0] != 0.5:
        raise ValueError("cell must be a power of two")
    parts = (layer.select(order, *labels, F.explode("parts").alias("_rings"))
             .select(order, *labels, _edges(F.col("_rings")).alias("edges")).where(F.size("edges") > 0))

    def reach(low, a, b):
        return F.floor(low(F.transform("edges", lambda e: F.least(e[a], e[b]) if low is F.array_min else F.greatest(e[a], e[b]))) / cell)
    cols = F.sequence(reach(F.array_min, "ax", "bx"), reach(F.array_max, "ax", "bx"))
    rows = F.sequence(reach(F.array_min, "ay", "by"), reach(F.array_max, "ay", "by"))
    first = (parts.withColumn("cx", F.explode(cols)).withColumn("cy", F.explode(rows)).withColumn("base", F.lit(0)))
    level, size = 0, cell
    now = cut_lineage(_settle(first, size), "cells")
    leaves, splits = [], []
    while True:
        load = now.groupBy("cx", "cy").agg(F.sum(F.size("edges")).alias("_load"))
        dense = load.where(F.col("_load") > most_edges).select("cx", "cy")
        if level == depth or dense.isEmpty():
            leaves.append(now.withColumn("level", F.lit(level)))
            break
        splits.append(dense.withColumn("level", F.lit(level)))
        leaves.append(now.join(dense, ["cx", "cy"], "left_anti").withColumn("level", F.lit(level)))
        quarter = F.explode(F.array(*[F.struct((F.col("cx") * 2 + i).alias("x"), (F.col("cy") * 2 + j).alias("y"))
                                      for i in (0, 1) for j in (0, 1)]))
        below = (now.join(dense, ["cx", "cy"], "left_semi").withColumn("_q", quarter)
                 .withColumns({"cx": F.col("_q.x"), "cy": F.col("_q.y")}).drop("_q"))
        level, size = level + 1, size / 2
        now = cut_lineage(_settle(below, size), "cells")
    found = reduce(DataFrame.unionByName, leaves)
    ready = found.groupBy("level", "cx", "cy").agg(
        F.array_sort(F.collect_list(F.struct(order, *labels, "base", "edges"))).alias("candidates"))
    if not splits:
        none = found.select(F.col("cx").alias("rx"), F.col("cy").alias("ry"),
                            F.array(F.struct("level", "cx", "cy")).alias("split")).limit(0)
        return none, ready
    up = [s.select(F.shiftright("cx", n).alias("rx"), F.shiftright("cy", n).alias("ry"), F.struct("level", "cx", "cy").alias("s"))
          for n, s in enumerate(splits)]
    return reduce(DataFrame.unionByName, up).groupBy("rx", "ry").agg(F.collect_list("s").alias("split")), ready


def locate_in_layer(points: DataFrame, layer: DataFrame, lon: str = "lon", lat: str = "lat", order: str = "poly_order",
                    labels: tuple[str, str] = ("nam", "fna"), out: tuple[str, str] = ("departamento_nombre", "provincia_nombre"),
                    cell: float = 1.0, most_edges: int = 64, depth: int = 10) -> DataFrame:
    """J4 over a polygon layer: the first row (in ``order``) that strictly contains each point.

    Points on an edge, that of a hole included, are outside; so are points with a null or
    non-finite coordinate.  Points in no row get the default labels.  Every point row is kept
    once, with its columns; a column named like an output is replaced.  Rings of fewer than
    three vertices and empty or null parts count for nothing.
    """
    splits, leaves = cell_tree(layer, labels, order, cell, most_edges, depth)
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    usable = (F.abs(x) < 1e9) & (F.abs(y) < 1e9)          # false for NaN, which Spark orders last

    def at(v, level):
        return F.floor(v * F.pow(F.lit(2.0), level) / F.lit(cell))
    keep = [F.col(f"`{c}`") for c in points.columns if c not in out]
    p = points.select(*keep, F.struct(F.when(usable, at(x, F.lit(0))).alias("rx"), F.when(usable, at(y, F.lit(0))).alias("ry")).alias("_root"))
    p = p.join(splits.select(F.struct("rx", "ry").alias("_root"), F.col("split").alias("_split")), "_root", "left")
    down = F.aggregate(F.sequence(F.lit(0), F.lit(depth - 1)), F.lit(0), lambda reached, n: F.when(
        (reached == n) & F.array_contains(F.col("_split"), F.struct(n.alias("level"), at(x, n).alias("cx"), at(y, n).alias("cy"))),
        reached + 1).otherwise(reached))
    p = p.withColumn("_level", F.when(F.col("_split").isNull(), F.lit(0)).otherwise(down) if depth else F.lit(0))
    p = p.withColumn("_leaf", F.struct(F.col("_level").alias("level"), F.when(usable, at(x, F.col("_level"))).alias("cx"),
                                       F.when(usable, at(y, F.col("_level"))).alias("cy")))
    j = p.join(leaves.select(F.struct("level", "cx", "cy").alias("_leaf"), F.col("candidates").alias("_candidates")), "_leaf", "left")
    inside = F.filter("_candidates", lambda c: ~F.exists(c["edges"], lambda e: _on(e, x, y))
                      & ((c["base"] + _crossings(c["edges"], x, y)) % 2 == 1))
    return (j.withColumn("_hit", F.when(usable, F.try_element_at(inside, F.lit(1))))
            .select(*keep, F.coalesce(F.col("_hit")[labels[0]], F.lit(NO_DEPARTMENT)).alias(out[0]),
                    F.coalesce(F.col("_hit")[labels[1]], F.lit(NO_PROVINCE)).alias(out[1])))
