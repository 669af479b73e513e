"""The feed's order and what it keeps: gaps, waiting files, multipolygons, compaction, side inputs; and an import that is taken up again."""

import pytest
from pyspark.sql import functions as F
from test_formats import write_feed

from skylattice.programs import importer
from skylattice.streaming.replication import SCHEMAS, Replica, feed_folder, run_of


def node(i, lon=1.0, lat=2.0, op="create"):
    return f'<{op}><node id="{i}" lon="{lon}" lat="{lat}"><tag k="name" v="n{i}"/></node></{op}>'


def osc(*parts):
    return "<osmChange>" + "".join(parts) + "</osmChange>"


def follow(r, feed, tmp_path):
    r.follow(str(feed), str(tmp_path / "ck")).awaitTermination(200)


def ids(r, table="nodes"):
    return sorted(x["id"] for x in r.tables()[table].select("id").collect())


def test_run_of():
    assert run_of(4, [7, 5, 9, 6, 3]) == [5, 6, 7] and run_of(4, [6, 7]) == [] and run_of(-1, [8, 9, 11]) == [8, 9] and run_of(3, []) == []


def test_gap_stops_and_is_filled_later(spark, tmp_path):
    """Sequences 5, then 7, then 6: nothing is lost, and the order is that of the numbers."""
    feed, r = tmp_path / "feed", Replica(spark, str(tmp_path / "db"))
    write_feed(feed, 5, osc(node(5)))
    follow(r, feed, tmp_path)
    assert r.state() == (1, 5)
    write_feed(feed, 7, osc(node(7), node(5, lon=9.0, op="modify")), True)
    follow(r, feed, tmp_path)
    assert r.state() == (1, 5) and ids(r) == [5]
    write_feed(feed, 6, osc(node(6), node(5, lon=3.0, op="modify")))
    follow(r, feed, tmp_path)
    assert r.state() == (2, 7) and ids(r) == [5, 6, 7]
    assert r.tables()["coords"].where("id = 5").first()["lon"] == 9.0
    assert spark.read.schema("seq long").parquet(str(tmp_path / "db" / "waiting")).count() == 0


def test_batch_with_gap_and_empty_file(spark, tmp_path):
    feed, r = tmp_path / "feed", Replica(spark, str(tmp_path / "db"))
    for n, body in ((1, osc(node(1))), (2, "<osmChange/>"), (3, osc(node(3))), (5, osc(node(55)))):
        write_feed(feed, n, body)
    follow(r, feed, tmp_path)
    assert r.state() == (1, 3) and ids(r) == [1, 3]
    write_feed(feed, 4, osc(node(4)))
    follow(r, feed, tmp_path)
    assert r.state() == (2, 5) and ids(r) == [1, 3, 4, 55]


RING = "".join(f'<node id="{i}" lon="{x}" lat="{y}"/>' for i, (x, y) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4)], 1))
HALVES = '<way id="11"><nd ref="1"/><nd ref="2"/><nd ref="3"/><tag k="barrier" v="wall"/></way><way id="12"><nd ref="3"/><nd ref="4"/><nd ref="1"/><tag k="barrier" v="wall"/></way>'


def area(i=8, kind="multipolygon", op="create", ways=(11, 12)):
    members = "".join(f'<member type="way" ref="{w}" role="outer"/>' for w in ways)
    return f'<{op}><relation id="{i}">{members}<tag k="type" v="{kind}"/><tag k="name" v="a"/></relation></{op}>'


def test_relation_changes_alter_areas(spark, tmp_path):
    feed, r = tmp_path / "feed", Replica(spark, str(tmp_path / "db"), compact=2)
    write_feed(feed, 1, osc(f"<create>{RING}{HALVES}</create>", area()))
    follow(r, feed, tmp_path)
    got = r.tables()["areas"].collect()
    assert [(x["id"], len(x["polygons"]), len(x["polygons"][0][0])) for x in got] == [(-8, 1, 5)] and ids(r, "relations") == []
    write_feed(feed, 2, osc(area(kind="route", op="modify")))
    follow(r, feed, tmp_path)
    assert ids(r, "areas") == [] and ids(r, "relations") == [8]
    assert sorted(p.name for p in (tmp_path / "db" / "areas").iterdir()) == ["base=2"]  # compacted, what lay before is gone
    write_feed(feed, 3, osc(area(op="modify", ways=(11, 99)), area(i=9)))
    follow(r, feed, tmp_path)
    # one known half is closed by force with three points and one more: a ring of four
    assert ids(r, "areas") == [-9, -8] and ids(r, "relations") == []
    write_feed(feed, 4, osc('<delete><relation id="8"/><relation id="9"/></delete>'))
    follow(r, feed, tmp_path)
    assert ids(r, "areas") == [] and ids(r, "ways") == [11, 12] and r.state() == (4, 4)
    assert {n: df.columns for n, df in r.tables().items()} == {n: spark.createDataFrame([], s).columns for n, s in SCHEMAS.items()}


def test_way_that_crosses_a_region_stays(spark, tmp_path):
    regions = spark.createDataFrame([(0, "r", 1.0, 3.0, -1.0, 1.0)], "bit int, name string, min_lon double, max_lon double, min_lat double, max_lat double")
    feed, r = tmp_path / "feed", Replica(spark, str(tmp_path / "db"), regions=regions)
    write_feed(feed, 1, osc(f"<create>{RING}{HALVES}</create>"))
    follow(r, feed, tmp_path)
    assert ids(r, "ways") == [11] and ids(r) == []  # no vertex of it lies in the region


def test_installed_regions_are_found(spark, tmp_path):
    assert Replica(spark, str(tmp_path / "db"), regions="installed").regions is None
    spark.createDataFrame([(0, "r", 1.0, 3.0, -1.0, 1.0)], "bit int, name string, min_lon double, max_lon double, min_lat double, max_lat double").write.parquet(str(tmp_path / "db" / "installed_regions"))
    assert Replica(spark, str(tmp_path / "db"), regions="installed").regions.count() == 1
    assert feed_folder("/x/", "hour") == "/x/hour"
    with pytest.raises(ValueError):
        feed_folder("/x", "week")


def test_side_inputs_are_refreshed_when_due(spark, tmp_path):
    r, ran = Replica(spark, str(tmp_path / "db")), []
    loads = {n: (lambda n=n: ran.append(n)) for n in ("airports", "airspace")}
    remote = lambda at: spark.createDataFrame([("airports", at), ("airspace", 0)], "name string, modified long")
    now = lambda s: F.lit(s).cast("timestamp")
    assert r.refresh(remote(1000), loads, now("2024-01-01 00:00:00"), {"airspace": 30}) == ["airports", "airspace"]
    assert r.refresh(remote(1200), loads, now("2024-01-02 00:00:00"), {"airspace": 30}) == []
    assert r.refresh(remote(2000), loads, now("2024-01-20 00:00:00"), {"airspace": 30}) == ["airports"]
    assert r.refresh(remote(2000), loads, now("2024-02-01 00:00:00"), {"airspace": 30}) == ["airspace"] and len(ran) == 4


def test_import_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    from test_formats import extract

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.osm.pbf").write_bytes(extract("zlib"))
    one = importer.Import(spark, str(tmp_path / "in"), str(tmp_path / "db"))
    assert one.done() == []
    tables = one.run(until="nodes")
    assert one.done() == ["entities", "nodes"] and set(tables) == {"entities", "coords", "nodes", "node_tags"}
    monkeypatch.setattr(importer.osm, "read_extract", lambda *a: pytest.fail("decoded again"))
    tables = importer.Import(spark, str(tmp_path / "in"), str(tmp_path / "db")).run()
    assert tables["coords"].count() == 2 and [r["id"] for r in tables["nodes"].collect()] == [10]
    assert [(r["id"], len(r["points"])) for r in tables["ways"].collect()] == [(7, 3)]
    assert {(r["phase"], r["table"]): r["n"] for r in one.statistics().collect()}["entities", "entities"] == 4
