"""Geometry as column expressions: projection, distances, grid cells, rings, tiles and angles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH = 6378137.0
FEET = 3.28084


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(EARTH)


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(F.pi() / 4 + F.radians(lat) / 2)) * F.lit(EARTH)


def inverse_x(x: Column) -> Column:
    return F.degrees(x / F.lit(EARTH))


def inverse_y(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / F.lit(EARTH))) * 2 - F.pi() / 2)


def valid_lonlat(lon: Column, lat: Column) -> Column:
    """False for nulls, NaN and out-of-range values alike."""
    return F.coalesce(lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0) & ~F.isnan(lon) & ~F.isnan(lat), F.lit(False))


def planar(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance in projected metres; it grows as 1 / cos(latitude) and doesn't wrap at the antimeridian."""
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = 6371008.8) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), a))) * (2 * radius)


def cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("long")


def in_range(v: Column, lo: Column, hi: Column) -> Column:
    """Within [lo, hi], or outside (hi, lo) where the range wraps."""
    return F.when(lo <= hi, (v >= lo) & (v <= hi)).otherwise((v >= lo) | (v <= hi))


def ranges_overlap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Whether a plain range [lo1, hi1] meets [lo2, hi2], which may wrap."""
    return F.when(lo2 <= hi2, (lo1 <= hi2) & (hi1 >= lo2)).otherwise((hi1 >= lo2) | (lo1 <= hi2))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment; a segment without length is a point."""
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / size))).otherwise(F.lit(0.0))
    return planar(px, py, ax + t * dx, ay + t * dy)


def edges(ring: Column) -> Column:
    """array<struct<a, b>> of consecutive points (struct<x, y>) of a ring or line."""
    return F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def within_edges(every: Column, x: Column, y: Column) -> Column:
    """Strictly inside by the edges that meet the point's parallel: an odd number of crossings, and on no edge."""
    cross = lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])
    on = F.exists(every, lambda e: (cross(e) == 0) & x.between(F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"])) & y.between(F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"])))
    crossed = F.size(F.filter(every, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])))
    return ~on & (crossed % 2 == 1)


def inside(rings: Column, x: Column, y: Column) -> Column:
    """Strictly inside: an odd number of crossings over all rings (holes count), and on no edge."""
    return within_edges(F.flatten(F.transform(rings, edges)), x, y)


def segments_meet(px: Column, py: Column, qx: Column, qy: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether two segments have a point in common, ends and collinear overlaps included."""
    side = lambda x1, y1, x2, y2, x, y: F.signum((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1))
    boxes = (F.greatest(px, qx) >= F.least(ax, bx)) & (F.least(px, qx) <= F.greatest(ax, bx)) & (F.greatest(py, qy) >= F.least(ay, by)) & (F.least(py, qy) <= F.greatest(ay, by))
    return boxes & (side(px, py, qx, qy, ax, ay) * side(px, py, qx, qy, bx, by) <= 0) & (side(ax, ay, bx, by, px, py) * side(ax, ay, bx, by, qx, qy) <= 0)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))


def is_closed(points: Column) -> Column:
    """At least four points, the first and last at the same place."""
    return (F.size(points) >= 4) & (F.element_at(points, 1) == F.element_at(points, -1))


def angle_difference(a: Column, b: Column) -> Column:
    """Between two bearings, in [0, 180]."""
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, F.lit(360.0) - d)


def elevation_ft(metres: Column) -> Column:
    return metres * F.lit(FEET)


def band_floor(least: Column, width: float) -> Column:
    return F.floor(least / F.lit(float(width))) * F.lit(float(width))


def band_id(v: Column, lo: Column, width: float) -> Column:
    """1-based number of the interval (lo + (k - 1) width, lo + k width] that holds v; the least value itself has band 0."""
    return F.ceil((v - lo) / F.lit(float(width))).cast("int")


def tile_name(lat: Column, lon: Column, scheme: str) -> Column:
    """`usgs`: by the north and west edge, US only; `copernicus`: by the south-west corner; `cell`: ten-degree cells by that corner."""
    ns, ew = F.when(lat >= 0, "N").otherwise("S"), F.when(lon >= 0, "E").otherwise("W")
    if scheme == "usgs":
        return F.format_string("n%02dw%03d", lat + 1, -lon)
    if scheme == "copernicus":
        return F.format_string("%s%02d_00_%s%03d_00", ns, F.abs(lat), ew, F.abs(lon))
    return F.format_string("%s%02d%s%03d", ns, F.abs(lat), ew, F.abs(lon))


def rough_region(lon: Column, lat: Column) -> Column:
    """A continent by rough boxes, the first that fits."""
    return (
        F.when((lat > 7) & lon.between(-170, -50), "North America")
        .when((lat <= 7) & (lon <= -34), "South America")
        .when(lat.between(-35, 37) & lon.between(-20, 52), "Africa")
        .when(lat.between(35, 72) & lon.between(-25, 45), "Europe")
        .when((lon > 45) | (lon < -170), "Asia/Oceania")
        .otherwise("Other")
    )


def uniform_latitude(u: Column) -> Column:
    """A latitude that is uniform over the sphere from u uniform in [0, 1)."""
    return F.degrees(F.asin(u * 2 - 1))


def decimal_year(day: Column) -> Column:
    return F.year(day) + (F.dayofyear(day) - 1) / F.lit(365.25)


def icao_class(code: Column) -> Column:
    """0 to 6 are the letters A to G; anything else is null."""
    return F.when(code.between(0, 6), F.get(F.array(*(F.lit(c) for c in "ABCDEFG")), code.cast("int")))
