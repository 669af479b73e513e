"""Spatial joins as equi-joins on grid cells with an exact residual test.

Points are rows (id, x, y) in one planar unit. Catalyst has no spatial index, but a cell key turns distance, containment and
nearest-neighbour search into hash or sort-merge joins that shuffle on the cell and that adaptive execution can split.
No side is broadcast by hint, except regions, whose number the 32 bits of a mask bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def project(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """df with Web Mercator x and y, null where the position isn't valid; rows stay."""
    ok = geo.valid_lonlat(F.col(lon), F.col(lat))
    return df.withColumn("x", F.when(ok, geo.mercator_x(F.col(lon)))).withColumn("y", F.when(ok, geo.mercator_y(F.col(lat))))


def around(v: str, size: float, reach: int = 1) -> Column:
    """The cells from `reach` below to `reach` above that of v."""
    at = geo.cell(F.col(v), size)
    return F.sequence(at - reach, at + reach)


def within_distance(points: DataFrame, targets: DataFrame, radius: float, cols: list[str]) -> DataFrame:
    """Pairs (point_id, *cols of targets, dist) no further apart than radius.

    Cells are as wide as the radius, so a pair is in the same or neighbouring cells; points are repeated over 3 x 3 cells,
    targets, the larger side, stay as they are.
    """
    left = points.select(F.col("id").alias("point_id"), F.col("x").alias("__px"), F.col("y").alias("__py")).where("__px is not null and __py is not null")
    left = left.select("*", F.explode(around("__px", radius)).alias("__cx")).select("*", F.explode(around("__py", radius)).alias("__cy"))
    right = targets.where("x is not null and y is not null").select(*cols, F.col("x").alias("__tx"), F.col("y").alias("__ty"), geo.cell(F.col("x"), radius).alias("__cx"), geo.cell(F.col("y"), radius).alias("__cy"))
    dist = geo.planar(F.col("__px"), F.col("__py"), F.col("__tx"), F.col("__ty"))
    # sides are estimated from the files' bytes, far below what rows take in memory: either is too large to broadcast
    return left.join(right.hint("merge"), ["__cx", "__cy"]).withColumn("dist", dist).where(F.col("dist") <= radius).select("point_id", *cols, "dist")


def nearest(points: DataFrame, sites: DataFrame, cols: list[str], cell: float, extent: float, k: int = 1, tie: str = "id") -> DataFrame:
    """The k nearest sites of every point: (point_id, rank, *cols, dist), ties to the smaller `tie`.

    A pyramid of grids with cells doubling twice a level, up to one that spans the extent. A point searches on the lowest level on which
    its own cell holds k sites: they are within the cell's diagonal, so all nearer ones are at most two cells away. Dense
    areas use small cells and empty ones large cells, in one pass and without a loop of jobs.
    """
    levels = [cell * 4**n for n in range(max(1, math.ceil(math.log(max(1.0, extent / cell), 4)) + 1))]
    keyed = lambda df, x, y: df.select("*", F.explode(F.array(*(F.struct(F.lit(n).alias("level"), geo.cell(F.col(x), s).alias("cx"), geo.cell(F.col(y), s).alias("cy")) for n, s in enumerate(levels)))).alias("__k")).select("*", "__k.*").drop("__k")
    right = keyed(sites.where("x is not null and y is not null").select(*dict.fromkeys([*cols, tie]), F.col("x").alias("__tx"), F.col("y").alias("__ty")), "__tx", "__ty")
    left = points.where("x is not null and y is not null").select(F.col("id").alias("point_id"), F.col("x").alias("__px"), F.col("y").alias("__py"))
    full = right.groupBy("level", "cx", "cy").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    top = len(levels)  # nothing qualifies where the extent has fewer than k sites: then every site is a candidate
    chosen = keyed(left, "__px", "__py").join(full, ["level", "cx", "cy"], "left").groupBy("point_id", "__px", "__py").agg(F.coalesce(F.min(F.when(F.col("n").isNotNull(), F.col("level"))), F.lit(top)).alias("level"))
    size = F.element_at(F.array(*(F.lit(float(s)) for s in [*levels, levels[-1] * 4])), F.col("level") + 1)
    near = lambda v: F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda d: F.floor(F.col(v) / size).cast("long") + d))
    spread = chosen.select("*", near("__px").alias("cx")).select("*", near("__py").alias("cy"))
    whole = right.where(F.col("level") == top - 1).withColumn("level", F.lit(top)).withColumn("cx", geo.cell(F.col("__tx"), levels[-1] * 4)).withColumn("cy", geo.cell(F.col("__ty"), levels[-1] * 4))
    met = spread.join(right.unionByName(whole), ["level", "cx", "cy"]).withColumn("dist", geo.planar(F.col("__px"), F.col("__py"), F.col("__tx"), F.col("__ty")))
    order = Window.partitionBy("point_id").orderBy("dist", tie)
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("point_id", "rank", *cols, "dist")


def lines_within(points: DataFrame, lines: DataFrame, radius: float, cols: list[str]) -> DataFrame:
    """(point_id, *cols, dist) for lines (column points: array<struct<x, y>>) no further than radius; cells are four radii wide.

    Segments are joined, not lines, so a line of any length meets only the points along it.
    """
    size = radius * 4
    parts = lines.select(*cols, F.explode(geo.edges(F.col("points"))).alias("s")).select(*cols, F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))
    span = lambda a, b: F.explode(F.sequence(geo.cell(F.least(a, b) - radius, size), geo.cell(F.greatest(a, b) + radius, size)))
    parts = parts.select("*", span("ax", "bx").alias("__cx")).select("*", span("ay", "by").alias("__cy"))
    left = points.where("x is not null and y is not null").select(F.col("id").alias("point_id"), F.col("x").alias("__px"), F.col("y").alias("__py"), geo.cell(F.col("x"), size).alias("__cx"), geo.cell(F.col("y"), size).alias("__cy"))
    dist = geo.segment_distance(F.col("__px"), F.col("__py"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return left.join(parts, ["__cx", "__cy"]).withColumn("dist", dist).where(F.col("dist") <= radius).groupBy("point_id", *cols).agg(F.min("dist").alias("dist"))


def areas_within(points: DataFrame, areas: DataFrame, radius: float, cols: list[str]) -> DataFrame:
    """(point_id, *cols, dist) for areas (column points: a closed ring) no further than radius; 0 for a point inside."""
    near = lines_within(points, areas, radius, cols)
    held = containing(points, areas.select(*cols, F.array("points").alias("rings")), radius * 4, cols).withColumn("dist", F.lit(0.0))
    return near.unionByName(held).groupBy("point_id", *cols).agg(F.min("dist").alias("dist"))


def containing(points: DataFrame, areas: DataFrame, size: float, cols: list[str]) -> DataFrame:
    """(point_id, *cols) for areas (column rings: array<array<struct<x, y>>>, boundary excluded) that hold the point.

    Areas are listed in the cells of their bounding box; the box and then the rings are the residual test.
    """
    every = F.flatten("rings")
    xs, ys = F.transform(every, lambda p: p["x"]), F.transform(every, lambda p: p["y"])
    boxed = areas.where(F.size(every) > 0).select(*cols, "rings", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    span = lambda a, b: F.explode(F.sequence(geo.cell(F.col(a), size), geo.cell(F.col(b), size)))
    boxed = boxed.select("*", span("x0", "x1").alias("__cx")).select("*", span("y0", "y1").alias("__cy"))
    left = points.where("x is not null and y is not null").select(F.col("id").alias("point_id"), F.col("x").alias("__px"), F.col("y").alias("__py"), geo.cell(F.col("x"), size).alias("__cx"), geo.cell(F.col("y"), size).alias("__cy"))
    box = F.col("__px").between(F.col("x0"), F.col("x1")) & F.col("__py").between(F.col("y0"), F.col("y1"))
    return left.join(boxed, ["__cx", "__cy"]).where(box).where(geo.inside(F.col("rings"), F.col("__px"), F.col("__py"))).select("point_id", *cols)


def few(regions: DataFrame) -> DataFrame:
    """The regions themselves; raises where a mask can't hold them: over 32 rows, or a bit that isn't in 0 to 31. Reads 33 bits at most."""
    bits = [r["bit"] for r in regions.select("bit").limit(33).collect()]
    if len(bits) > 32:
        raise ValueError("a mask holds at most 32 regions")
    if any(b is None or not 0 <= b <= 31 for b in bits):
        raise ValueError(f"bits of regions must be 0 to 31: {bits}")
    return regions


BAND, WIDE_BAND, PLAIN_EDGES, FEW_EDGES = 0.25, 180.0, 1000, 1_000_000


def region_edges(regions: DataFrame) -> DataFrame:
    """(bit, part, ax, ay, bx, by): the edges of the regions' outlines, in degrees, by ring. A region without rings is its box; where that
    wraps the antimeridian, it has two parts without an edge along it."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x0, x1, y0, y1 = (F.col(c) for c in ("min_lon", "max_lon", "min_lat", "max_lat"))
    half = lambda edge, at: F.array(point(F.lit(at), y0), point(edge, y0), point(edge, y1), point(F.lit(at), y1))
    box = F.when(x0 <= x1, F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0)))).otherwise(F.array(half(x0, 180.0), half(x1, -180.0)))
    rings = F.coalesce("rings", box) if "rings" in regions.columns else box
    rows = few(regions).select("bit", F.posexplode(rings).alias("part", "ring")).select("bit", "part", F.explode(geo.edges(F.col("ring"))).alias("e"))
    return rows.select("bit", "part", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))


def banded_edges(regions: DataFrame, size: float = BAND) -> DataFrame:
    """(band, bit, edges): the edges that each band of latitude meets. A test along a parallel needs no others."""
    rows = region_edges(regions)
    if rows.count() > FEW_EDGES:
        raise ValueError(f"outlines of more than {FEW_EDGES} edges")  # 32 MB; what allows the broadcast
    band = F.explode(F.sequence(geo.cell(F.least("ay", "by"), size), geo.cell(F.greatest("ay", "by"), size))).alias("band")
    spans = rows.select("bit", "ax", "ay", "bx", "by", band)
    return spans.groupBy("band", "bit").agg(F.collect_list(F.struct(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("a"), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")).alias("b"))).alias("edges"))


def region_mask(points: DataFrame, regions: DataFrame) -> DataFrame:
    """(id, mask): bit k is set where region k's box (min_lon > max_lon wraps; optional rings decide within it) holds the point.

    At most 32 regions fit into a mask, which is what bounds the broadcast; more, or other bits than 0 to 31, are an error.
    All points are classified in one pass; a point is tested against the edges of its band of latitude, not against whole outlines.
    """
    boxes = F.broadcast(few(regions).select("bit", "min_lon", "max_lon", "min_lat", "max_lat", (F.col("rings").isNotNull() if "rings" in regions.columns else F.lit(False)).alias("shaped")))
    hit = geo.in_range(F.col("lon"), F.col("min_lon"), F.col("max_lon")) & F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
    met = points.select("id", "lon", "lat").join(boxes, hit)
    if "rings" in regions.columns:
        bands = F.broadcast(banded_edges(regions.where("rings is not null")))
        met = met.withColumn("band", geo.cell(F.col("lat"), BAND)).join(bands, ["band", "bit"], "left")
        met = met.where(~F.col("shaped") | F.coalesce(geo.within_edges(F.col("edges"), F.col("lon"), F.col("lat")), F.lit(False)))
    return met.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("mask"))


def shape_mask(shapes: DataFrame, regions: DataFrame) -> DataFrame:
    """(id, mask) of the shapes (id, points: array<struct<x, y>> in degrees) that meet a region: a vertex lies in it, an edge meets its
    outline, or the shape is a ring around it. Edges are joined with outlines by bands of latitude."""
    vertices = shapes.select("id", F.explode("points").alias("p")).select("id", F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
    bit = F.expr("shiftleft(1L, cast(bit as int))")
    parts = shapes.select("id", F.explode(geo.edges(F.col("points"))).alias("e")).select("id", F.col("e.a.x").alias("px"), F.col("e.a.y").alias("py"), F.col("e.b.x").alias("qx"), F.col("e.b.y").alias("qy"))
    # plain outlines need no fine bands, which long edges would be repeated over
    size = WIDE_BAND if region_edges(regions).count() <= PLAIN_EDGES else BAND
    parts = parts.select("*", F.explode(F.sequence(geo.cell(F.least("py", "qy"), size), geo.cell(F.greatest("py", "qy"), size))).alias("band"))
    outline = F.broadcast(banded_edges(regions, size))
    touch = lambda e: geo.segments_meet(F.col("px"), F.col("py"), F.col("qx"), F.col("qy"), e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])
    crossed = parts.join(outline, "band").where(F.exists("edges", touch)).groupBy("id").agg(F.bit_or(bit).alias("mask"))
    # a ring around a part of a region holds every point of its outline: one of each is enough where no edges meet
    spots = F.broadcast(region_edges(regions).groupBy("bit", "part").agg(F.min(F.struct("ax", "ay")).alias("p")))
    rings = shapes.where(geo.is_closed(F.col("points"))).select("id", "points", F.array_min(F.transform("points", lambda p: p["x"])).alias("x0"), F.array_max(F.transform("points", lambda p: p["x"])).alias("x1"), F.array_min(F.transform("points", lambda p: p["y"])).alias("y0"), F.array_max(F.transform("points", lambda p: p["y"])).alias("y1"))
    around = rings.join(spots, F.col("p.ax").between(F.col("x0"), F.col("x1")) & F.col("p.ay").between(F.col("y0"), F.col("y1"))).where(geo.inside(F.array("points"), F.col("p.ax"), F.col("p.ay")))
    every = region_mask(vertices, regions).unionByName(crossed).unionByName(around.groupBy("id").agg(F.bit_or(bit).alias("mask")))
    return every.groupBy("id").agg(F.bit_or("mask").alias("mask"))


def expand_mask(masked: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per set bit: masked's columns and the region's name."""
    bits = masked.select("*", F.explode(F.expr("filter(sequence(0, 31), b -> shiftright(mask, b) & 1 = 1)")).alias("bit"))
    return bits.join(F.broadcast(few(regions).select(F.col("bit").cast("int").alias("bit"), F.col("name").alias("region"))), "bit").drop("bit")


def raster_values(points: DataFrame, tiles: DataFrame, size: float, cols: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """(point_id, value): the first non-null cell under the point, in the order of tile_id.

    Tiles are (tile_id, x0, y0, dx, dy, w, h, cells): x0 and y0 the north-west corner, cells row by row southwards. Tiles
    are listed by the squares of `size` that they touch, the point's square is the join key, the cell is index arithmetic.
    """
    x1, y1 = F.col("x0") + F.col("dx") * F.col("w"), F.col("y0") - F.col("dy") * F.col("h")
    listed = tiles.select("*", F.explode(F.sequence(geo.cell(F.col("x0"), size), geo.cell(x1, size))).alias("__cx")).select("*", F.explode(F.sequence(geo.cell(y1, size), geo.cell(F.col("y0"), size))).alias("__cy"))
    px, py = (F.col(c) for c in cols)
    left = points.select(F.col("id").alias("point_id"), px.alias("__px"), py.alias("__py"), geo.cell(px, size).alias("__cx"), geo.cell(py, size).alias("__cy"))
    column, row = F.floor((F.col("__px") - F.col("x0")) / F.col("dx")).cast("int"), F.floor((F.col("y0") - F.col("__py")) / F.col("dy")).cast("int")
    met = left.join(listed, ["__cx", "__cy"]).withColumn("__c", column).withColumn("__r", row).where("__c >= 0 and __c < w and __r >= 0 and __r < h")
    met = met.select("point_id", "tile_id", F.get("cells", F.col("__r") * F.col("w") + F.col("__c")).alias("value")).where("value is not null and not isnan(value)")
    return met.groupBy("point_id").agg(F.min_by("value", "tile_id").alias("value"))


def exact_matches(nodes: DataFrame, vertices: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """(id, mask): nodes at exactly the place of extra vertices (x, y, mask), with the regions that want those vertices; without those
    that hold the node already (own: id, mask), if that is given.

    Vertices are merged per place before the join; both sides come from one projection, so equality of doubles is exact.
    """
    wanted = vertices.groupBy("x", "y").agg(F.bit_or("mask").alias("mask"))
    met = nodes.select("id", "x", "y").join(wanted, ["x", "y"]).select("id", "mask")
    if own is None:
        return met
    held = F.coalesce(F.col("held"), F.lit(0).cast("long"))
    return met.join(own.select("id", F.col("mask").alias("held")), "id", "left").select("id", F.col("mask").bitwiseAND(F.bitwise_not(held)).alias("mask")).where("mask <> 0")
