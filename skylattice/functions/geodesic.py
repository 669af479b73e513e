"""The direct geodesic problem on WGS84 by Vincenty's series, vectorised."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

A, INVERSE_FLATTENING = 6378137.0, 298.257223563


def direct(lon, lat, bearing, distance):
    """Longitude and latitude in degrees after `distance` metres at an initial bearing in degrees."""
    f = 1 / INVERSE_FLATTENING
    b = A * (1 - f)
    lon, lat, bearing, s = (np.asarray(v, dtype=np.float64) for v in (lon, lat, bearing, distance))
    a1 = np.radians(bearing)
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat)))
    su, cu, sa1, ca1 = np.sin(u1), np.cos(u1), np.sin(a1), np.cos(a1)
    sigma1 = np.arctan2(np.tan(u1), ca1)
    sin_a = cu * sa1
    cos2_a = 1 - sin_a**2
    u2 = cos2_a * (A**2 - b**2) / b**2
    ka = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    kb = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    sigma = s / (b * ka)
    for _ in range(30):
        m = np.cos(2 * sigma1 + sigma)
        ss, cs = np.sin(sigma), np.cos(sigma)
        turn = kb * ss * (m + kb / 4 * (cs * (2 * m**2 - 1) - kb / 6 * m * (4 * ss**2 - 3) * (4 * m**2 - 3)))
        new = s / (b * ka) + turn
        if np.all(np.abs(new - sigma) < 1e-13):
            sigma = new
            break
        sigma = new
    m, ss, cs = np.cos(2 * sigma1 + sigma), np.sin(sigma), np.cos(sigma)
    lat2 = np.arctan2(su * cs + cu * ss * ca1, (1 - f) * np.sqrt(sin_a**2 + (su * ss - cu * cs * ca1) ** 2))
    lam = np.arctan2(ss * sa1, cu * cs - su * ss * ca1)
    c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
    dl = lam - (1 - c) * f * sin_a * (sigma + c * ss * (m + c * cs * (2 * m**2 - 1)))
    return (lon + np.degrees(dl) + 180) % 360 - 180, np.degrees(lat2)


def destination(lon: str, lat: str, bearing: str, distance: str) -> Column:
    """struct<lon, lat>; Arrow batches, since the series iterates."""
    @F.pandas_udf("lon double, lat double")
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        x, y = direct(a, b, c, d)
        return pd.DataFrame({"lon": x, "lat": y})

    return run(F.col(lon), F.col(lat), F.col(bearing), F.col(distance).cast("double"))
