"""The checks of a loaded database: structure, bounds, facts, places to look at; one result a check, and an exit status.

A database with registered regions is checked as such: bounds and facts of the whole world don't hold for it, the membership of
its rows in the regions does. Staleness is reported and doesn't fail.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo
from ..operators import delta, quality, sinks, spatial

# The tables' row bounds for the whole world, and the least number of areas of several parts.
BOUNDS = {"ways": (150_000_000, 700_000_000), "areas": (20_000_000, 500_000_000), "relations": (1_000_000, 50_000_000), "roads": (50_000, 2_000_000), "nodes": (20_000_000, 1_000_000_000)}
LEAST_MULTIPART = 10_000
PAIRS = {"way_tags": "ways", "area_tags": "areas", "road_tags": "roads", "relation_tags": "relations", "node_tags": "nodes"}
RESULT = "kind string, title string, pass boolean, detail string"


def orphan_counts(tables: dict[str, DataFrame], pairs: dict[str, str] = PAIRS) -> DataFrame:
    """(table, n): rows of each child table without a parent, also where there are none."""
    parts = [delta.orphans(tables[c], tables[p], "id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("table"), "n") for c, p in pairs.items() if c in tables and p in tables]
    return reduce(DataFrame.unionByName, parts)


def multipart_areas(polygons: DataFrame) -> DataFrame:
    """(n): areas of relations (negative ids) that have several outer rings."""
    return polygons.agg(F.count_if((F.col("id") < 0) & (F.size("polygons") > 1)).alias("n"))


def minor_airports(airports: DataFrame, n: int, seed: int) -> DataFrame:
    """n small airports with a four-character US code, the same for a seed."""
    small = airports.where((F.col("type") == "small_airport") & (F.col("country") == "US") & F.col("ident").rlike("^K[A-Z0-9]{3}$"))
    return quality.seeded_sample(small, n, seed, "ident")


def outside_regions(shapes: DataFrame, regions: DataFrame, n: int, seed: int) -> DataFrame:
    """(n, outside): of a seeded sample of shapes (id, points in degrees) those that meet no region. A sampling check."""
    some = quality.seeded_sample(shapes, n, seed)
    met = some.join(spatial.shape_mask(some, regions), "id", "left")
    return met.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("mask").isNull()).alias("outside"))


@dataclass
class Checks:
    """Checks of the database under a root folder. `facts` are (key, expected, tolerance, ident) rows, `measured` (key, value, ident) ones."""

    spark: SparkSession
    root: str
    facts: DataFrame | None = None
    measured: DataFrame | None = None
    bounds: dict | None = None
    least_multipart: int = LEAST_MULTIPART
    seed: int = 7

    def table(self, name: str) -> DataFrame:
        return schemas.read(self.spark, self.root, name)

    def regions(self) -> DataFrame | None:
        listed = self.table("installed_regions")
        if listed.isEmpty():
            return None
        from pyspark.sql import Window

        bit = F.row_number().over(Window.orderBy("name")) - 1  # a row a region
        return listed.select(bit.cast("int").alias("bit"), "name", "min_lon", "max_lon", "min_lat", "max_lat")

    def results(self) -> DataFrame:
        """RESULT rows. Counts only reach the driver."""
        rows = [("structure", f"no orphaned {r['table']}", r["n"] == 0, f"{r['n']} orphaned") for r in orphan_counts({n: self.table(n) for n in [*PAIRS, *PAIRS.values()]}).collect()]
        regions = self.regions()
        if regions is None:
            bounds = self.bounds or BOUNDS
            rows += [("structure", f"{r['table']} within bounds", r["ok"], f"{r['n']} rows") for r in quality.count_bounds({t: self.table(t) for t in bounds}, bounds).collect()]
            n = multipart_areas(self.table("multipolygons")).first()["n"]
            rows.append(("structure", "areas of several parts", n >= self.least_multipart, f"{n} areas"))
            if self.facts is not None and self.measured is not None:
                rows += [("fact", r["key"], r["ok"], "" if r["diff"] is None else f"off by {r['diff']}") for r in quality.golden(self.facts, self.measured).collect()]
        else:
            degrees = F.transform("points", lambda p: F.struct(geo.inverse_x(p["x"]).alias("x"), geo.inverse_y(p["y"]).alias("y"))).alias("points")
            for t in ("ways", "areas"):
                got = outside_regions(self.table(t).where("points is not null").select("id", degrees), regions, 2000, self.seed).first()
                rows.append(("region", f"{t} meet an installed region", got["outside"] == 0, f"{got['outside']} of {got['n']} don't"))
            n = self.table("coords").count()
            rows.append(("region", "coordinates are there", n > 0, f"{n} coordinates"))
        return self.spark.createDataFrame(rows, RESULT)

    def run(self, now, limits: dict[str, float] | None = None) -> tuple[int, str, str]:
        """(exit status, HTML report, JSON report): 0 if all checks pass; staleness is told and doesn't count."""
        found = self.results()
        stale = quality.staleness(self.table("external_data_state").select("name", "checked_at"), now, limits or {})
        told = stale.select(F.lit("staleness").alias("kind"), F.col("name").alias("title"), (~F.col("stale")).alias("pass"), F.format_string("%.1f hours", "hours").alias("detail"))
        every = found.unionByName(told)
        status = 0 if found.where("not pass").isEmpty() else 1
        return status, sinks.report_html(every, "Checks"), sinks.report_json(every)
