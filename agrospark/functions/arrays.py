"""Array and geometry column expressions (W3, P16, P17, A3, A4, J4 predicate).

Rings are ``ARRAY<STRUCT<lon DOUBLE, lat DOUBLE>>``; everything is a native
higher-order function, evaluated inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c, ColumnOrName

# Fixed value: metres per degree used by the field-area formula.
METRES_PER_DEGREE = 111320.0


def pad_front(arr: ColumnOrName, n: int) -> Column:
    """Keep the last ``n`` elements; front-pad with NULL when shorter.

    An empty input stays empty (no earlier data at all).
    """
    a = _c(arr)
    size = F.size(a)
    last = F.when(size > n, F.slice(a, size - (n - 1), n)).otherwise(a)
    pad = F.array_repeat(F.lit(None).cast("double"), F.greatest(F.lit(n) - F.size(last), F.lit(0)))
    return F.when(size == 0, a).otherwise(F.concat(pad, last))


def pair(lon: ColumnOrName, lat: ColumnOrName) -> Column:
    """Zip two columns into a (lon, lat) struct."""
    return F.struct(_c(lon).cast("double").alias("lon"), _c(lat).cast("double").alias("lat"))


def coords_to_ring(coords: ColumnOrName, lat_first: bool = False) -> Column:
    """ARRAY<ARRAY<DOUBLE>> -> ring of named (lon, lat) structs."""
    i_lon, i_lat = (2, 1) if lat_first else (1, 2)
    return F.transform(_c(coords), lambda p: F.struct(
        F.try_element_at(p, F.lit(i_lon)).alias("lon"),
        F.try_element_at(p, F.lit(i_lat)).alias("lat")))


def ring_is_valid(coords: ColumnOrName) -> Column:
    """>= 3 vertices, each a pair, lat in [-90,90], lon in [-180,180].

    ``coords`` is the parsed ``ARRAY<ARRAY<DOUBLE>>`` with [lat, lon] pairs.
    """
    c = _c(coords)
    ok_pair = F.forall(c, lambda p: (F.size(p) == 2)
                       & F.try_element_at(p, F.lit(1)).between(-90, 90)
                       & F.try_element_at(p, F.lit(2)).between(-180, 180))
    return F.coalesce(c.isNotNull() & (F.size(c) >= 3) & ok_pair, F.lit(False))


def ring_centroid(ring: ColumnOrName, closed: bool = False) -> Column:
    """A3: arithmetic mean of the vertices.

    ``closed=True`` reproduces the variant that appends the first vertex
    before averaging when the ring has more than 2 vertices and is open.
    """
    r = _c(ring)
    if closed:
        first = F.element_at(r, 1)
        last = F.element_at(r, -1)
        r = F.when((F.size(r) > 2) & ((first.lon != last.lon) | (first.lat != last.lat)),
                   F.concat(r, F.array(first))).otherwise(r)
    n = F.size(r).cast("double")
    sx = F.aggregate(r, F.lit(0.0), lambda a, p: a + p.lon)
    sy = F.aggregate(r, F.lit(0.0), lambda a, p: a + p.lat)
    return F.struct((sx / n).alias("lon"), (sy / n).alias("lat"))


def ring_area_m2(ring: ColumnOrName) -> Column:
    """A4: shoelace area x 111320^2 x cos(mean latitude); < 3 vertices -> 0."""
    r = _c(ring)
    n = F.size(r)
    nxt = F.concat(F.slice(r, 2, F.greatest(n - 1, F.lit(1))), F.slice(r, 1, 1))
    terms = F.zip_with(r, nxt, lambda p, q: p.lon * q.lat - q.lon * p.lat)
    twice = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    mean_lat = F.aggregate(r, F.lit(0.0), lambda a, p: a + p.lat) / n
    area = F.abs(twice) / 2.0 * F.lit(METRES_PER_DEGREE) * F.lit(METRES_PER_DEGREE) \
        * F.cos(F.radians(mean_lat))
    return F.when(n < 3, F.lit(0.0)).otherwise(area)


def point_in_ring(ring: ColumnOrName, lon: ColumnOrName, lat: ColumnOrName) -> Column:
    """J4 predicate: strict containment (points on the boundary are outside).

    Even-odd ray casting over the edges, after an exact on-segment test.
    """
    r = _c(ring)
    x, y = _c(lon), _c(lat)
    n = F.size(r)
    nxt = F.concat(F.slice(r, 2, F.greatest(n - 1, F.lit(1))), F.slice(r, 1, 1))
    edges = F.arrays_zip(r.alias("a"), nxt.alias("b"))

    def on_edge(e):
        a, b = e["a"], e["b"]
        cross = (b.lon - a.lon) * (y - a.lat) - (b.lat - a.lat) * (x - a.lon)
        return ((cross == 0)
                & (x >= F.least(a.lon, b.lon)) & (x <= F.greatest(a.lon, b.lon))
                & (y >= F.least(a.lat, b.lat)) & (y <= F.greatest(a.lat, b.lat)))

    def crosses(e):
        a, b = e["a"], e["b"]
        straddles = (a.lat > y) != (b.lat > y)
        return F.when(straddles, x < (b.lon - a.lon) * (y - a.lat) / (b.lat - a.lat) + a.lon
                      ).otherwise(F.lit(False))

    n_cross = F.aggregate(edges, F.lit(0), lambda acc, e: acc + F.when(crosses(e), 1).otherwise(0))
    return (n >= 3) & ~F.exists(edges, on_edge) & (n_cross % 2 == 1)
