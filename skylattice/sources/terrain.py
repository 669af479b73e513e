"""Elevation grids as tiles of at most `side` cells a side. Grids are text (a header of six lines, rows from north to south), since no
decoder for compressed rasters is at hand; a wanted tile without a file is skipped, as unmapped sea is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = "tile_id string, x0 double, y0 double, dx double, dy double, w int, h int, cells array<double>"


def parse_grid(text: str):
    """(columns, rows, west, south, cell size, values or None row by row)."""
    lines = text.split("\n")
    head = {k.lower(): float(v) for k, v in (x.split()[:2] for x in lines[:6])}
    missing = head.get("nodata_value")
    values = [None if float(v) == missing else float(v) for row in lines[6:] for v in row.split()]
    columns, rows = int(head["ncols"]), int(head["nrows"])
    if len(values) != columns * rows:
        raise ValueError("grid size")
    return columns, rows, head["xllcorner"], head["yllcorner"], head["cellsize"], values


def read_grids(spark: SparkSession, folder: str, side: int = 256) -> DataFrame:
    """TILE rows of all .asc files of a folder; tile_id is the file's name, row and column."""
    import pandas as pd

    names = [x.split(" ")[0] for x in TILE.split(", ")]

    def run(batches):
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["value"]):
                stem = path.rsplit("/", 1)[-1].removesuffix(".asc")
                w, h, west, south, size, values = parse_grid(text)
                for r in range(0, h, side):
                    out = []
                    for c in range(0, w, side):
                        tw, th = min(side, w - c), min(side, h - r)
                        cells = [v for k in range(r, r + th) for v in values[k * w + c : k * w + c + tw]]
                        out.append((f"{stem}/{r:05d}/{c:05d}", west + c * size, south + (h - r) * size, size, size, tw, th, cells))
                    yield pd.DataFrame(out, columns=names)

    files = spark.read.option("pathGlobFilter", "*.asc").text(folder, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return files.mapInPandas(run, TILE)


def load(spark: SparkSession, folder: str, wanted: DataFrame, loaded: DataFrame, side: int = 256) -> DataFrame:
    """Tiles of the wanted grid names (column tile) that aren't loaded yet."""
    todo = wanted.select("tile").distinct().join(loaded.select("tile"), "tile", "left_anti")
    grids = read_grids(spark, folder, side).withColumn("tile", F.substring_index("tile_id", "/", 1))
    return grids.join(todo, "tile", "left_semi").drop("tile")
