"""Raster tiles as rows: enumeration, bookkeeping, summaries and bands. A tile is (tile_id, x0, y0, dx, dy, w, h, cells)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def box_tiles(boxes: DataFrame, step: int = 1) -> DataFrame:
    """(…, lat, lon): south-west corners of the tiles of `step` degrees that cover each box; min_lon > max_lon wraps."""
    down = lambda c: (F.floor(F.col(c) / step) * step).cast("int")
    up = lambda c: (F.ceil(F.col(c) / step) * step).cast("int")
    upto = lambda a, b: F.when(a <= b - step, F.sequence(a, b - step, F.lit(step))).otherwise(F.expr("cast(array() as array<int>)"))
    lon0, lon1 = down("min_lon"), up("max_lon")
    lons = F.when(lon0 <= lon1, upto(lon0, lon1)).otherwise(F.concat(upto(lon0, F.lit(180)), upto(F.lit(-180), lon1)))
    return boxes.select("*", F.explode(upto(down("min_lat"), up("max_lat"))).alias("lat"), lons.alias("__lons")).select("*", F.explode("__lons").alias("lon")).drop("__lons")


def absent(tiles: DataFrame, loaded: DataFrame, key: str = "tile") -> DataFrame:
    return tiles.join(loaded.select(key), key, "left_anti")


def outside_box(tiles: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Without the one-degree tiles that lie wholly inside a box that is loaded from elsewhere."""
    w, s, e, n = box
    return tiles.where(~((F.col("lon") >= w) & (F.col("lon") + 1 <= e) & (F.col("lat") >= s) & (F.col("lat") + 1 <= n)))


def summary(tiles: DataFrame) -> DataFrame:
    """(lo, hi, n) over all cells that have a value."""
    seen = F.filter("cells", lambda v: v.isNotNull())
    return tiles.agg(F.min(F.array_min(seen)).alias("lo"), F.max(F.array_max(seen)).alias("hi"), F.sum(F.size(seen)).alias("n"))


def banded(tiles: DataFrame, width: float, bucket: float) -> DataFrame:
    """(band, bx, by, x, y): every cell's band over the common floor, and the bucket of its centre.

    Cells stay cells: without a geometry engine they aren't dissolved to polygons, which needs no topology either.
    """
    lo = geo.band_floor(summary(tiles).select("lo").scalar(), width)
    cells = tiles.select("x0", "y0", "dx", "dy", "w", F.posexplode("cells").alias("i", "v")).where("v is not null")
    x, y = F.col("x0") + (F.col("i") % F.col("w") + 0.5) * F.col("dx"), F.col("y0") - (F.floor(F.col("i") / F.col("w")) + 0.5) * F.col("dy")
    return cells.select(geo.band_id(F.col("v"), lo, width).alias("band"), x.alias("x"), y.alias("y")).withColumn("bx", geo.cell(F.col("x"), bucket)).withColumn("by", geo.cell(F.col("y"), bucket))


def band_counts(tiles: DataFrame, width: float, bucket: float) -> DataFrame:
    """(band, n_cells, n_buckets): per bucket first, then per band, as a union of parts would be built."""
    parts = banded(tiles, width, bucket).groupBy("band", "bx", "by").agg(F.count(F.lit(1)).alias("n"))
    return parts.groupBy("band").agg(F.sum("n").alias("n_cells"), F.count(F.lit(1)).alias("n_buckets"))


def rectangles(tiles: DataFrame) -> DataFrame:
    """(tile_id, row, col, value, ring): the rectangle of every cell that has a value."""
    cells = tiles.select("tile_id", "x0", "y0", "dx", "dy", "w", F.posexplode("cells").alias("i", "value")).where("value is not null")
    row, col = F.floor(F.col("i") / F.col("w")).cast("int"), (F.col("i") % F.col("w")).cast("int")
    x, y = F.col("x0") + col * F.col("dx"), F.col("y0") - row * F.col("dy")
    return cells.select("tile_id", row.alias("row"), col.alias("col"), "value", geo.box_ring(x, y - F.col("dy"), x + F.col("dx"), y).alias("ring"))


def band_rectangles(tiles: DataFrame, width: float) -> DataFrame:
    """(band, ring): cells of one row and band that lie side by side are one rectangle, so that a band is few of them."""
    lo = geo.band_floor(summary(tiles).select("lo").scalar(), width)
    cells = rectangles(tiles).withColumn("band", geo.band_id(F.col("value"), lo, width))
    order = Window.partitionBy("tile_id", "row").orderBy("col")  # a tile's row
    new = F.coalesce((F.lag("band").over(order) != F.col("band")) | (F.lag("col").over(order) + 1 != F.col("col")), F.lit(True))
    runs = cells.withColumn("__new", new.cast("int")).withColumn("__run", F.sum("__new").over(order))
    ends = runs.groupBy("tile_id", "row", "__run", "band").agg(F.min("ring").alias("a"), F.max("ring").alias("b"))
    return ends.select("band", geo.box_ring(F.col("a")[0]["x"], F.col("a")[0]["y"], F.col("b")[2]["x"], F.col("b")[2]["y"]).alias("ring"))


def sweep(boxes: DataFrame, loaded: DataFrame, skip: tuple[float, float, float, float] | None = None, skipping: str | None = None) -> DataFrame:
    """(name, tile, lat, lon): the one-degree tiles of all boxes that aren't loaded; in the box `skipping` without those inside `skip`."""
    wanted = box_tiles(boxes.select("name", "min_lon", "min_lat", "max_lon", "max_lat")).withColumn("tile", geo.tile_name(F.col("lat"), F.col("lon"), "copernicus"))
    if skip is not None:
        wanted = wanted.where(F.col("name") != skipping).unionByName(outside_box(wanted.where(F.col("name") == skipping), skip))
    return absent(wanted, loaded).select("name", "tile", "lat", "lon")
