"""Keeping the tables fresh from a change feed: one pure step (`apply_changes`), and a stream that runs it batch by batch.

Within a batch the last change of each entity counts, by (seq, ord). Coordinates are updated first, then ways are rebuilt
from the updated coordinates, then relations from the updated ways. A way without two known nodes leaves its old row as it is;
a relation whose members aren't known stays with no lines. Multipolygon relations become areas under their negative id, as in an
import, and a changed or deleted relation's old area goes. Moving a node doesn't rebuild ways that aren't in the feed unless
`cascade` is set. With regions, an upsert that meets none of them removes the entity.

A batch writes only what it changes: per table the rows and the ids that go, as one delta beside the last full base. Its state row,
with its last sequence, comes after all of them: a batch that is replayed overwrites the same delta with the same rows. Every
`compact` batches the tables are written whole as a new base, and what lies before it goes.

Sequences are applied without gaps: of the files that have come, the run that follows the last applied one; later files
wait in a table until the gap is filled.
"""

from __future__ import annotations

import signal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import delta, quality, spatial, tags, ways
from ..sources import osm

POINTS = "array<struct<x: double, y: double>>"
SCHEMAS = {
    "coords": "id long, lon double, lat double, x double, y double",
    "nodes": "id long, tags map<string, string>, lon double, lat double, x double, y double",
    "ways": f"id long, tags map<string, string>, refs array<long>, points {POINTS}",
    "areas": f"id long, tags map<string, string>, refs array<long>, points {POINTS}, polygons array<array<{POINTS}>>",
    "relations": f"id long, tags map<string, string>, lines array<{POINTS}>",
    "roads": f"id long, tags map<string, string>, lines array<{POINTS}>",
}

CHANGE = ("kind", "id", "seq", "ord", "op", "tags", "lon", "lat", "refs", "members")
FILES = "path string, modificationTime timestamp, length long, content binary"


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}


def _replace(base: DataFrame, touched: DataFrame, rows: DataFrame) -> DataFrame:
    """base without the touched ids, with rows."""
    return base.join(touched.select("id").distinct(), "id", "left_anti").select(*base.columns).unionByName(rows.select(*base.columns))


def _inside(regions: DataFrame | None, rows: DataFrame, lines) -> DataFrame:
    """rows of which a line (a column of lines) meets a region; all rows without regions."""
    if regions is None:
        return rows
    degrees = F.transform(F.col("line"), lambda p: F.struct(geo.inverse_x(p["x"]).alias("x"), geo.inverse_y(p["y"]).alias("y")))
    shapes = rows.select("id", F.explode(lines).alias("line")).select("id", degrees.alias("points"))
    return rows.join(spatial.shape_mask(shapes, regions).select("id"), "id", "left_semi")


def changed_rows(tables: dict[str, DataFrame], changes: DataFrame, regions: DataFrame | None = None, cascade: bool = False) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per table (ids that are touched, rows that stand for them afterwards) of the changes (seq, ord, op, kind, id, tags, lon, lat, refs, members)."""
    last = delta.last_changes(changes.select(*CHANGE), ["kind", "id"])
    out: dict[str, tuple[DataFrame, DataFrame]] = {}

    moved = spatial.project(last.where("kind = 'node'"))
    there = moved.where("op <> 'delete' and x is not null")
    out["coords"] = moved, there
    kept = there.where(tags.survives(F.col("tags"), node=True))
    if regions is not None:
        kept = kept.join(spatial.region_mask(kept.select("id", "lon", "lat"), regions).select("id"), "id", "left_semi")
    out["nodes"] = moved, kept
    coords = _replace(tables["coords"], moved, there)

    changed = last.where("kind = 'way'").select("id", "op", "tags", "refs")
    if cascade:
        users = tables["ways"].select("id", "tags", "refs").unionByName(tables["areas"].where("id > 0").select("id", "tags", "refs")).select("id", "tags", "refs", F.explode("refs").alias("node_id"))
        hit = users.join(there.select(F.col("id").alias("node_id")), "node_id", "left_semi").select("id", "tags", "refs")
        hit = hit.groupBy("id").agg(F.first(F.struct("tags", "refs")).alias("w")).select("id", F.lit("modify").alias("op"), "w.tags", "w.refs")
        changed = changed.unionByName(hit.join(changed.select("id"), "id", "left_anti"))
    built = changed.where("op <> 'delete'").select("id", "tags", "refs")
    refs = built.select(F.col("id").alias("way_id"), F.posexplode("refs").alias("pos", "node_id"))
    shaped = built.join(ways.assemble(refs, coords).withColumnRenamed("way_id", "id"), "id")
    gone = changed.where("op = 'delete'").select("id").unionByName(shaped.select("id"))
    stored = _inside(regions, shaped.where(tags.survives(F.col("tags"))), F.array("points")).withColumn("polygons", F.lit(None).cast(f"array<array<{POINTS}>>"))
    area = tags.is_area(F.col("closed"), F.col("tags"))
    out["ways"] = gone, stored.where(~area)
    known = ways.ways_and_areas(_replace(tables["ways"], *out["ways"]), _replace(tables["areas"], gone, stored.where(area)).where("id > 0"))

    rel = last.where("kind = 'relation'").select("id", "op", "tags", "members")
    live = rel.where("op <> 'delete'").where(tags.survives(F.col("tags")))
    members = live.select(F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m")).select("rel_id", "pos", F.col("m.id").alias("way_id"), F.col("m.role").alias("role"))
    parts = ways.relation_parts(members, known)
    shape = tags.is_multipolygon(F.col("tags"))
    lined = live.where(~shape).select("id", "tags").join(ways.collected_lines(parts).withColumnRenamed("rel_id", "id"), "id", "left")
    placed = lined if regions is None else _inside(regions, lined.where("lines is not null"), F.col("lines")).unionByName(lined.where("lines is null"))
    out["relations"] = rel, placed
    out["roads"] = rel, placed.where(tags.is_road(F.col("tags")) & F.col("lines").isNotNull())
    whole = live.where(shape).select("id", "tags").join(ways.multipolygons(parts).withColumnRenamed("rel_id", "id"), "id")
    whole = _inside(regions, whole, F.flatten("polygons")).select((-F.col("id")).alias("id"), "tags", F.lit(None).cast("array<long>").alias("refs"), F.lit(None).cast(POINTS).alias("points"), "polygons")
    out["areas"] = gone.unionByName(rel.select((-F.col("id")).alias("id"))), stored.where(area).select("id", "tags", "refs", "points", "polygons").unionByName(whole)
    return out


def apply_changes(tables: dict[str, DataFrame], changes: DataFrame, regions: DataFrame | None = None, cascade: bool = False) -> dict[str, DataFrame]:
    """The tables after the changes."""
    return {n: _replace(tables[n], *of) for n, of in changed_rows(tables, changes, regions, cascade).items()}


def run_of(sequence: int, waiting: list[int]) -> list[int]:
    """Of the sequences that wait those that can be applied after `sequence` without a gap; before the first one, from the least on."""
    left = sorted({s for s in waiting if s > sequence})
    start = sequence + 1 if sequence >= 0 or not left else left[0]
    out = []
    for s in left:
        if s != start + len(out):
            break
        out.append(s)
    return out


def feed_folder(root: str, granularity: str) -> str:
    """The folder of one of a mirror's feeds, which come by the minute, the hour and the day."""
    if granularity not in ("minute", "hour", "day"):
        raise ValueError(f"no such feed: {granularity}")
    return f"{root.rstrip('/')}/{granularity}"


class Replica:
    """Tables under a root folder of any file system that Spark writes to. `regions="installed"` takes those that are registered there."""

    def __init__(self, spark: SparkSession, root: str, regions: DataFrame | str | None = None, cascade: bool = False, compact: int = 64):
        self.spark, self.root, self.cascade, self.compact = spark, root.rstrip("/"), cascade, compact
        self.regions = self._read("installed_regions") if isinstance(regions, str) else regions

    def _read(self, name: str, schema: str | None = None) -> DataFrame | None:
        """A table under the root, None where there is none."""
        try:
            return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(f"{self.root}/{name}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def _last(self) -> tuple[int, int, int]:
        states = self._read("state", "version long, base long, sequence long")
        row = None if states is None else states.orderBy(F.desc("version")).first()
        return (row["version"], row["base"], row["sequence"]) if row else (0, 0, -1)

    def state(self) -> tuple[int, int]:
        """(version, sequence) of the last batch that was written in full; (0, -1) before the first."""
        version, _, sequence = self._last()
        return version, sequence

    def tables(self) -> dict[str, DataFrame]:
        """The last base with the deltas since then; of an id the last delta counts."""
        version, base, _ = self._last()
        out = {}
        for n, schema in SCHEMAS.items():
            whole = self.spark.read.schema(schema).parquet(f"{self.root}/{n}/base={base}") if base else self.spark.createDataFrame([], schema)
            since = [f"{self.root}/{n}/delta={v}" for v in range(base + 1, version + 1)]
            if since:
                names = whole.columns
                rows = self.spark.read.schema(f"{schema}, gone boolean, at long").parquet(*since)
                last = rows.groupBy("id").agg(F.max_by(F.struct("gone", *names), "at").alias("r")).select("r.*")
                whole = whole.join(last.select("id"), "id", "left_anti").select(*names).unionByName(last.where("not gone").select(*names))
            out[n] = whole
        return out

    def seed(self, tables: dict[str, DataFrame], sequence: int) -> None:
        """A full load as version 1."""
        self._base(tables, 1)
        self._commit(1, 1, sequence)

    def _base(self, tables: dict[str, DataFrame], version: int) -> None:
        for n, schema in SCHEMAS.items():
            whole = self.spark.createDataFrame([], schema).unionByName(tables[n], allowMissingColumns=True)
            # ids in order, so that readers skip row groups by their least and greatest id
            whole.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{self.root}/{n}/base={version}")

    def _commit(self, version: int, base: int, sequence: int) -> None:
        row = self.spark.createDataFrame([(version, base, sequence)], "version long, base long, sequence long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state/batch={version}")

    def _expire(self, before: int) -> None:
        """Deletes what the base of version `before` replaces."""
        jvm = self.spark.sparkContext._jvm
        for n in SCHEMAS:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
            fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for at in fs.listStatus(folder):
                kind, _, version = at.getPath().getName().partition("=")
                if kind in ("base", "delta") and int(version) < before + (kind == "delta"):
                    fs.delete(at.getPath(), True)

    def apply(self, changes: DataFrame, present: list[int] | None = None) -> list[int]:
        """One batch: the run of sequences that follows the last one; returns those that it holds back behind a gap.

        Sequences that are in already are skipped, so that a replay changes nothing. `present` names the sequences that have come, where
        some may have no changes."""
        version, base, sequence = self._last()
        if present is None:
            present = [r["seq"] for r in changes.where(F.col("seq") > sequence).select("seq").distinct().collect()]  # one a file
        run = run_of(sequence, present)
        if run:
            # files are parsed and collapsed once a batch; every table below reads what is left many times
            last = delta.last_changes(changes.where(F.col("seq").between(run[0], run[-1])).select(*CHANGE), ["kind", "id"]).select(*CHANGE)
            last.write.mode("overwrite").parquet(f"{self.root}/last")
            last = self.spark.read.schema(last.schema).parquet(f"{self.root}/last")
            touched = changed_rows(self.tables(), last, self.regions, self.cascade)
            for n, schema in SCHEMAS.items():
                ids, rows = touched[n]
                names = self.spark.createDataFrame([], schema).columns
                held = rows.select(*names, F.lit(False).alias("gone"))
                ids = ids.select("id").distinct().join(held.select("id"), "id", "left_anti").withColumn("gone", F.lit(True))
                held.unionByName(ids, allowMissingColumns=True).withColumn("at", F.lit(version + 1).cast("long")).write.mode("overwrite").parquet(f"{self.root}/{n}/delta={version + 1}")
            version += 1
            self._commit(version, base, run[-1])
            if version - base >= self.compact:
                self._base(self.tables(), version)
                self._commit(version, version, run[-1])
                self._expire(version)
        return [s for s in present if s > (run[-1] if run else sequence)]

    def apply_files(self, files: DataFrame) -> None:
        """One batch of change files (path, content) together with those that wait; what lies behind a gap waits on."""
        seq = osm.sequence(F.col("path"))
        waiting = self._read("waiting", "seq long, path string, content binary")
        come = files.select(seq.alias("seq"), "path", "content", F.lit(1).alias("new")).where("seq is not null")
        if waiting is not None:
            come = come.unionByName(waiting.withColumn("new", F.lit(0)))
        come = come.where(F.col("seq") > self.state()[1])
        # of a sequence that came twice one file counts; contents aren't sorted for that, and lie in small row groups, as each is read whole
        come = come.join(F.broadcast(come.groupBy("seq").agg(F.min(F.struct("new", "path")).alias("one")).select("seq", "one.*")), ["seq", "new", "path"])
        come.drop("new").write.mode("overwrite").option("parquet.block.size", 8 << 20).parquet(f"{self.root}/arrived")  # a stream's rows are read more than once
        come = self.spark.read.schema("seq long, path string, content binary").parquet(f"{self.root}/arrived")
        left = self.apply(osm.changes(come), [r["seq"] for r in come.select("seq").collect()])
        come.where(F.col("seq").isin(left) if left else F.lit(False)).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/waiting")

    def follow(self, feed: str, checkpoint: str, **trigger):
        """Starts a stream over a mirrored feed folder (AAA/BBB/CCC.osc[.gz]); by default it takes what is there and ends.

        Files are applied in the order of their sequence; `stop()` on what is returned ends it between batches.
        """
        files = self.spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.osc*").load(feed)
        return files.writeStream.foreachBatch(lambda df, _: self.apply_files(df)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def run(self, feed: str, checkpoint: str, every: str = "60 seconds") -> None:
        """Follows a feed until the process is told to end; the batch at work is finished or, if cut off, replayed by the next run."""
        query = self.follow(feed, checkpoint, processingTime=every)
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, lambda *_: query.stop())
        query.awaitTermination()

    def refresh(self, remote: DataFrame, loads: dict, now, max_days: dict[str, int] | None = None, slack_s: int = 300) -> list[str]:
        """Runs the loads (name: function) that are due by their remote times (name, modified) or their age; returns their names.

        What was loaded is remembered with the remote time, or, for those that go by age, with the time of the load."""
        state = self._read("sources", "name string, value long")
        state = self.spark.createDataFrame([], "name string, value long") if state is None else state
        due = [r["name"] for r in quality.refresh_due(state, remote, now, slack_s, max_days).where("due").collect() if r["name"] in loads]
        for name in due:
            loads[name]()
        aged = list(max_days or {})
        done = remote.where(F.col("name").isin(due)).select("name", F.when(F.col("name").isin(aged), F.unix_timestamp(now)).otherwise(F.col("modified")).cast("long").alias("value"))
        rows = state.where(~F.col("name").isin(due)).unionByName(done).collect()  # a row a source
        self.spark.createDataFrame(rows, "name string, value long").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/sources")
        return sorted(due)


def counters(changes: DataFrame) -> DataFrame:
    return delta.change_counts(changes)
