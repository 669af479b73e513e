"""A full import of a map extract in phases: coordinates and nodes, ways and areas, relations, roads and multipolygons.

Each phase writes its tables whole and then a row with its figures; the row is what makes it done. A run that is repeated goes on
with the first phase that isn't done, whose tables are overwritten. The entities are decoded once, into a table by kind.
Decoding, projection and joins are one plan a phase; what the phases exchange are written tables, which other executors can
read again if one is lost.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import spatial, tags, ways
from ..sources import osm

PHASES = ("entities", "nodes", "ways", "relations")
TABLES = {
    "entities": ("entities",),
    "nodes": ("coords", "nodes", "node_tags"),
    "ways": ("ways", "areas", "way_tags", "area_tags"),
    "relations": ("relations", "relation_tags", "roads", "road_tags", "multipolygons", "multipolygon_tags"),
}


class Import:
    """Tables under a root folder; `run` does the phases that aren't done and returns all tables."""

    def __init__(self, spark: SparkSession, extract: str, root: str):
        self.spark, self.extract, self.root = spark, extract, root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def statistics(self) -> DataFrame:
        """(phase, table, n, seconds) of what is done; no rows before the first phase."""
        schema = "phase string, table string, n long, seconds double"
        try:
            return self.spark.read.schema(schema).json(f"{self.root}/phases")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def done(self) -> list[str]:
        have = {r["phase"] for r in self.statistics().select("phase").distinct().collect()}
        return [p for p in PHASES if p in have]

    def run(self, until: str = PHASES[-1]) -> dict[str, DataFrame]:
        done = self.done()
        for phase in PHASES[: PHASES.index(until) + 1]:
            if phase not in done:
                self.phase(phase)
        return {t: self.table(t) for p in self.done() for t in TABLES[p]}

    def phase(self, phase: str) -> None:
        began, counts = time.time(), {}
        for name, df in getattr(self, f"_{phase}")():
            seen = Observation(f"{phase}.{name}")
            out = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
            (out.partitionBy("kind") if name == "entities" else out).parquet(f"{self.root}/{name}")
            counts[name] = seen.get["n"]
        took = time.time() - began
        rows = [json.dumps({"phase": phase, "table": t, "n": n, "seconds": took}) for t, n in counts.items()]
        self.spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/phases/phase_of={phase}")
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/staged")
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """What several tables of a phase are made from, written once; it goes when the phase is done."""
        df.write.mode("overwrite").parquet(f"{self.root}/staged/{name}")
        return self.table(f"staged/{name}")

    def kind(self, kind: str) -> DataFrame:
        return self.table("entities").where(F.col("kind") == kind)

    def _entities(self):
        yield "entities", osm.read_extract(self.spark, self.extract)

    def _nodes(self):
        nodes = spatial.project(self.kind("node").select("id", "tags", "lon", "lat")).where("x is not null")
        yield "coords", nodes.select("id", "lon", "lat", "x", "y")
        kept = nodes.where(tags.survives(F.col("tags"), node=True))
        yield "nodes", kept.select("id", tags.name(F.col("tags")).alias("name"), "lon", "lat", "x", "y")
        yield "node_tags", tags.tag_rows(nodes, node=True)

    def _ways(self):
        raw = self.kind("way").select("id", "tags", "refs")
        refs = raw.select(F.col("id").alias("way_id"), F.posexplode("refs").alias("pos", "node_id"))
        shaped = raw.select("id", "tags").join(ways.assemble(refs, self.table("coords")).withColumnRenamed("way_id", "id"), "id")
        kept = self.staged("ways", shaped.where(tags.survives(F.col("tags"))).select("id", "tags", "points", tags.is_area(F.col("closed"), F.col("tags")).alias("area")))
        for name, one, rows in (("ways", "way", kept.where("not area")), ("areas", "area", kept.where("area"))):
            yield name, rows.select("id", tags.name(F.col("tags")).alias("name"), "points")
            yield f"{one}_tags", tags.tag_rows(rows)
        # what relations look up: geometry doesn't depend on a way's tags being kept there, but only stored ways are found

    def _relations(self):
        raw = self.kind("relation").select("id", "tags", "members").where(tags.survives(F.col("tags")))
        shape = tags.is_multipolygon(F.col("tags"))
        known = ways.ways_and_areas(self.table("ways"), self.table("areas"))

        def parts(of):
            members = of.select(F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m"))
            return ways.relation_parts(members.select("rel_id", "pos", F.col("m.id").alias("way_id"), F.col("m.role").alias("role")), known)

        plain = raw.where(~shape)
        lines = self.staged("lines", plain.select("id", "tags").join(ways.collected_lines(parts(plain)).withColumnRenamed("rel_id", "id"), "id", "left"))
        roads = lines.where(tags.is_road(F.col("tags")) & F.col("lines").isNotNull())
        yield "relations", lines.select("id", tags.name(F.col("tags")).alias("name"), "lines")
        yield "relation_tags", tags.tag_rows(plain)
        yield "roads", roads.select("id", tags.name(F.col("tags")).alias("name"), "lines")
        yield "road_tags", tags.tag_rows(roads)
        # stored among the areas under the negative id, as ways and relations share one range of ids
        of = raw.where(shape)
        areas = ways.multipolygons(parts(of), of.select(F.col("id").alias("rel_id"), "tags"))
        yield "multipolygons", areas.select((-F.col("rel_id")).alias("id"), tags.name(F.col("tags")).alias("name"), "polygons")
        areas = of.select((-F.col("id")).alias("id"), "tags").join(self.table("multipolygons").select("id"), "id", "left_semi")
        yield "multipolygon_tags", tags.tag_rows(areas)
