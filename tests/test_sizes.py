"""What keeps a query within a machine's memory when its tables grow."""

from pyspark.sql import functions as F

from skylattice.operators import spatial, ways
from skylattice.plans import file_queries, fixtures
from skylattice.sources import osm
from skylattice.streaming import replication


def test_radius_joins_broadcast_no_side(spark, tmp_path):
    for name in ("points", "targets"):
        spark.range(50).select("id", F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y")).write.parquet(str(tmp_path / name))
    near = spatial.within_distance(spark.read.parquet(str(tmp_path / "points")), spark.read.parquet(str(tmp_path / "targets")), 1.0, ["id"])
    assert near.count() == 148
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()


def test_lines_are_written_by_executors(spark, monkeypatch):
    """The driver sees no row: neither collect nor an iterator."""
    from pyspark.sql.classic.dataframe import DataFrame

    rows = spark.range(0, 1000, 1, 7).select(F.concat(F.lit("é"), F.col("id").cast("string")))
    for call in ("collect", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, call, lambda *a, **k: 1 / 0)
    path = file_queries.lines(spark, rows, ["a", "b"], "x.csv", "iso-8859-1")
    monkeypatch.undo()
    with open(path.removeprefix("file:"), "rb") as f:
        assert f.read().decode("iso-8859-1").split("\n") == ["a", "b", *(f"é{i}" for i in range(1000)), ""]


def test_blobs_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "BLOCK", 10)
    none = lambda kind: F.lit(None).cast(kind)
    rows = spark.range(300).select(F.lit("node").alias("kind"), "id", none("array<struct<k: string, v: string>>").alias("tags"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"), none("array<long>").alias("refs"), none("array<struct<id: long, role: string, type: int>>").alias("members"))
    path = f"{fixtures.folder(spark)}/a.osm.pbf"
    starts = fixtures.write_extract(spark, path, rows)
    held = [at for at, kind, _ in osm.blob_offsets(spark, path) if kind == "OSMData"]
    assert len(held) == 30 and [held.index(starts[n]) for n in range(6)] == [0, 5, 10, 15, 20, 25]
    assert sorted(r["id"] for r in osm.read_extract(spark, path).collect()) == list(range(300))
    assert {r["id"] % 6 for r in osm.read_extract(spark, path, starts[3]).collect()} == {3, 4, 5}


def test_change_files_are_bounded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(file_queries, "EVENTS", 3)
    rows = spark.range(100).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.lit("click").alias("event_type"))
    root = file_queries.change_files(spark, lambda name: rows)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.osc*").load(root)
    got = osm.changes(files).where("kind = 'node'").groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.max("ord").alias("last"), F.element_at(F.max_by("tags", "ord"), "name").alias("name")).collect()
    assert {r["seq"]: (r["n"], r["name"]) for r in got} == {k + 1: (min(3, 100 - 3 * k), f"n{min(99, 3 * k + 2)} & co") for k in range(34)}
    assert files.count() == 35


def test_a_batch_parses_its_files_once(spark, monkeypatch, tmp_path):
    """What the tables are made from is the collapsed table, not the files."""
    seen, real = [], replication.changed_rows
    monkeypatch.setattr(replication, "changed_rows", lambda tables, changes, *a: seen.append(changes) or real(tables, changes, *a))
    path = fixtures.write_file(spark, f"{tmp_path}/in/000/000/001.osc", b'<osmChange><create><node id="1" lon="1" lat="2"><tag k="name" v="a"/></node></create></osmChange>')
    files = spark.read.format("binaryFile").load(path)
    replica = replication.Replica(spark, f"{tmp_path}/db")
    replica.apply_files(files.unionByName(files))
    assert "MapInPandas" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["id"], r["tags"]) for r in replica.tables()["nodes"].collect()] == [(1, {"name": "a"})]


def test_blobs_are_bounded_by_what_entities_hold(spark, monkeypatch):
    """Few relations of many members are many blobs, in the order of their ids; an entity above the bound has a blob of its own."""
    monkeypatch.setattr(fixtures, "VALUES", 50)
    none = lambda kind: F.lit(None).cast(kind)
    members = F.transform(F.sequence(F.lit(1), F.when(F.col("id") == 7, 90).otherwise(20)), lambda k: F.struct(k.cast("long").alias("id"), F.lit("outer").alias("role"), F.lit(1).alias("type")))
    rows = spark.range(60).select(F.lit("relation").alias("kind"), "id", none("array<struct<k: string, v: string>>").alias("tags"), none("double").alias("lon"), none("double").alias("lat"), none("array<long>").alias("refs"), members.alias("members"))
    path = f"{fixtures.folder(spark)}/a.osm.pbf"
    starts = fixtures.write_extract(spark, path, rows)
    held = [at for at, kind, _ in osm.blob_offsets(spark, path) if kind == "OSMData"]
    assert len(held) == 31 and [held.index(starts[n]) for n in range(6)] == [0, 5, 11, 16, 21, 26]
    assert sorted((r["id"], len(r["members"])) for r in osm.read_extract(spark, path).collect()) == [(i, 90 if i == 7 else 20) for i in range(60)]


def test_polygons_come_one_relation_at_a_time(spark, tmp_path):
    """Each of r outer rings around r holes has all of them: no table of all relations of a batch is made from objects."""
    square = lambda at, wide: [{"x": float(x), "y": float(y)} for x, y in ((at, at), (at + wide, at), (at + wide, at + wide), (at, at + wide), (at, at))]
    rows = [(rel, k, "inner" if k % 2 else "outer", square(500 + k, 1) if k % 2 else square(k, 1000)) for rel in range(5) for k in range(60)]
    parts = spark.createDataFrame(rows, "rel_id long, pos int, role string, points array<struct<x: double, y: double>>")
    of = spark.createDataFrame([(rel, {"a": str(rel)}) for rel in range(5)], "rel_id long, tags map<string, string>")
    made = ways.multipolygons(parts, of)
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    want = [[square(k, 1000), *(square(500 + h, 1) for h in range(1, 60, 2))] for k in range(0, 60, 2)]
    assert {r["rel_id"]: (r["tags"], [[[p.asDict() for p in ring] for ring in poly] for poly in r["polygons"]]) for r in made.collect()} == {rel: ({"a": str(rel)}, want) for rel in range(5)}
