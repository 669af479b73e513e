"""Declination of the main magnetic field from spherical-harmonic coefficients.

Coefficients are a parameter: rows (n, m, g, h, g_rate, h_rate) in nanotesla and nanotesla a year, as in the published
coefficient files (`read_coefficients`). The field is the gradient of the potential in Schmidt semi-normalised functions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

A, B, MEAN = 6378.137, 6356.7523142, 6371.2


def read_coefficients(text: str) -> tuple[float, list[tuple[int, int, float, float, float, float]]]:
    """Epoch and rows of a coefficient file: a header line, a row per degree and order, a line of nines."""
    lines = [x.split() for x in text.splitlines() if x.strip()]
    rows = [(int(x[0]), int(x[1]), *map(float, x[2:6])) for x in lines[1:] if len(x) >= 6 and not x[0].startswith("999")]
    return float(lines[0][0]), rows


def schmidt(theta: np.ndarray, top: int) -> tuple[dict, dict]:
    """Schmidt semi-normalised Legendre functions of cos(theta) and their derivatives by theta, by degree and order."""
    c, s = np.cos(theta), np.sin(theta)
    p, d = {(0, 0): np.ones_like(c)}, {(0, 0): np.zeros_like(c)}
    for n in range(1, top + 1):
        k = np.sqrt((2 * n - 1) / (2 * n)) if n > 1 else 1.0
        p[n, n] = k * s * p[n - 1, n - 1]
        d[n, n] = k * (c * p[n - 1, n - 1] + s * d[n - 1, n - 1])
        for m in range(n):
            a, b = (2 * n - 1) / np.sqrt(n * n - m * m), np.sqrt(((n - 1) ** 2 - m * m) / (n * n - m * m))
            before, slope = p.get((n - 2, m), 0.0), d.get((n - 2, m), 0.0)
            p[n, m] = a * c * p[n - 1, m] - b * before
            d[n, m] = a * (c * d[n - 1, m] - s * p[n - 1, m]) - b * slope
    return p, d


def declination(lon, lat, altitude_km, years, rows) -> np.ndarray:
    """Degrees east of north at geodetic positions; years since the coefficients' epoch. At a pole, the limit along the meridian."""
    lon, lat, h = np.radians(np.asarray(lon, float)), np.radians(np.clip(np.asarray(lat, float), -89.9999999, 89.9999999)), np.asarray(altitude_km, float)
    curve = A * A / np.sqrt((A * np.cos(lat)) ** 2 + (B * np.sin(lat)) ** 2)
    px, pz = (curve + h) * np.cos(lat), (curve * (B / A) ** 2 + h) * np.sin(lat)
    r, geocentric = np.hypot(px, pz), np.arctan2(pz, px)
    p, d = schmidt(np.pi / 2 - geocentric, max(n for n, *_ in rows))
    radial, south, east = (np.zeros_like(r) for _ in range(3))
    for n, m, g, hh, gr, hr in rows:
        gt, ht = g + years * gr, hh + years * hr
        q = (MEAN / r) ** (n + 2)
        cos, sin = np.cos(m * lon), np.sin(m * lon)
        radial += q * (n + 1) * (gt * cos + ht * sin) * p[n, m]
        south -= q * (gt * cos + ht * sin) * d[n, m]
        east += q * m * (gt * sin - ht * cos) * p[n, m] / np.cos(geocentric)
    turn = lat - geocentric
    north = -south * np.cos(turn) - radial * np.sin(turn)
    return np.degrees(np.arctan2(east, north))


def column(lon: Column, lat: Column, years: float, rows: list, altitude_km: float = 0.0) -> Column:
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(declination(x, y, np.zeros(len(x)) + altitude_km, years, rows))

    return run(lon, lat)


def grid(spark, box: tuple[float, float, float, float], years: float, rows: list, step: float = 0.25, cell: int = 10):
    """Declination tiles of `cell` degrees, named by their south-west corner, row 0 in the north, sampled at cell centres."""
    from . import geo

    w, s, e, n = box
    side = int(round(cell / step))
    corners = [(la, lo) for la in range(int(np.floor(s / cell)) * cell, int(np.ceil(n / cell)) * cell, cell) for lo in range(int(np.floor(w / cell)) * cell, int(np.ceil(e / cell)) * cell, cell)]
    tiles = spark.createDataFrame(corners, "lat int, lon int").repartition(max(1, len(corners) // 8))

    @F.pandas_udf("array<double>")
    def fill(lat: pd.Series, lon: pd.Series) -> pd.Series:
        out = []
        for la, lo in zip(lat, lon):
            y, x = np.meshgrid(la + cell - step * (np.arange(side) + 0.5), lo + step * (np.arange(side) + 0.5), indexing="ij")
            out.append(declination(x.ravel(), y.ravel(), np.zeros(x.size), years, rows))
        return pd.Series(out)

    step_ = F.lit(float(step))
    return tiles.select(geo.tile_name(F.col("lat"), F.col("lon"), "cell").alias("tile_id"), F.col("lon").cast("double").alias("x0"), (F.col("lat") + cell).cast("double").alias("y0"), step_.alias("dx"), step_.alias("dy"), F.lit(side).alias("w"), F.lit(side).alias("h"), fill("lat", "lon").alias("cells"))
