import math
import random

import pytest
from pyspark.sql import functions as F

from skylattice.functions import geo
from skylattice.operators import delta, quality, raster, regional, spatial, ways
from skylattice.plans import public
from skylattice.sources import loaders


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, y double")


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(1)
    ps = [(i, rnd.uniform(-1e7, 1e7), rnd.uniform(-1e7, 1e7)) for i in range(150)]
    ss = [(i, rnd.gauss(0, 3e5), rnd.gauss(0, 3e5)) for i in range(60)] + [(100, 9e6, 9e6), (101, 9e6, 9e6)]
    for k in (1, 3):
        got = spatial.nearest(points(spark, ps), points(spark, ss), ["id"], 20_000.0, 4e7, k=k).collect()
        want = {(p, n + 1): s for p, x, y in ps for n, (_, s) in enumerate(sorted((math.hypot(x - a, y - b), s) for s, a, b in ss)[:k])}
        assert {(r["point_id"], r["rank"]): r["id"] for r in got} == want
    few = spatial.nearest(points(spark, ps[:3]), points(spark, ss[:1]), ["id"], 20_000.0, 4e7, k=3).collect()
    assert sorted((r["point_id"], r["rank"]) for r in few) == [(0, 1), (1, 1), (2, 1)]
    assert spatial.nearest(points(spark, ps), points(spark, []), ["id"], 1e4, 4e7).count() == 0


def test_containment_boundary_and_holes(spark):
    sq = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    area = spark.createDataFrame([("A", [[{"x": float(x), "y": float(y)} for x, y in r] for r in (sq(0, 10), sq(4, 6))])], "name string, rings array<array<struct<x: double, y: double>>>")
    ps = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 0.0, 5.0), (4, 4.0, 5.0), (5, 11.0, 5.0), (6, 10.0, 10.0), (7, 3.9, 6.1), (8, None, 1.0)]
    assert sorted(r["point_id"] for r in spatial.containing(points(spark, ps), area, 3.0, ["name"]).collect()) == [1, 7]


def test_region_boxes_and_wrap(spark):
    boxes = loaders.region_boxes(spark)
    ps = spark.createDataFrame([(1, 170.0, -18.0), (2, -170.0, -15.0), (3, -30.0, 0.0), (4, 10.0, 48.0), (5, 0.0, -80.0)], "id long, lon double, lat double")
    got = {(r["id"], r["region"]) for r in spatial.expand_mask(spatial.region_mask(ps, boxes), boxes).collect()}
    want = {(i, n) for i, lon, lat in ps.collect() for n, (w, s, e, t) in loaders.REGION_BOXES.items() if s <= lat <= t and (w <= lon <= e if w <= e else lon >= w or lon <= e)}
    assert got == want and (1, "oceania") in got and (2, "oceania") in got


def test_stitching():
    a, b, c, d = (0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)
    assert ways.stitch([[a, b], [c, b], [c, d, a]]) == [[a, b, c, d, a]]
    assert ways.stitch([[a, b, c]]) == [[a, b, c, a]]
    assert ways.stitch([[a, b]]) == []
    assert ways.stitch([[a, b, c, d, a], [a, b, c, a]]) == [[a, b, c, d, a], [a, b, c, a]]
    assert ways.stitch([[], [a, b]]) == []
    hole = [(0.2, 0.2), (0.3, 0.2), (0.3, 0.3), (0.2, 0.2)]
    far = [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]
    assert ways.polygons([[a, b, c, a]], [hole, far]) == [[[a, b, c, a], hole, far]]
    assert ways.polygons([[a, b, c, d, a], far], [hole]) == [[[a, b, c, d, a], hole], [far]]


def test_stitch_against_plain_scan():
    rnd = random.Random(4)
    for _ in range(200):
        spots = [(float(i % 3), float(i // 3)) for i in range(9)]
        segs = [[rnd.choice(spots) for _ in range(rnd.randint(2, 3))] for _ in range(rnd.randint(1, 7))]
        left, rings = list(segs), []
        while left:
            ring = list(left.pop(0))
            while not (len(ring) >= 4 and ring[0] == ring[-1]):
                hit = next((s for s in left if ring[-1] in (s[0], s[-1])), None)
                if hit is None:
                    break
                left = left[: (k := next(i for i, s in enumerate(left) if s is hit))] + left[k + 1 :]
                ring += hit[1:] if hit[0] == ring[-1] else hit[:-1][::-1]
            ring += [ring[0]] if ring[0] != ring[-1] else []
            rings += [ring] if len(ring) >= 4 else []
        assert ways.stitch(segs) == rings


def test_multipolygons(spark):
    p = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    rows = [(1, 2, "outer", p((4, 4), (0, 4), (0, 0))), (1, 1, "", p((0, 0), (4, 0), (4, 4))), (1, 3, "inner", p((1, 1), (2, 1), (2, 2), (1, 1))), (2, 1, "inner", p((1, 1), (2, 1), (2, 2), (1, 1)))]
    got = ways.multipolygons(spark.createDataFrame(rows, "rel_id long, pos int, role string, points array<struct<x: double, y: double>>")).collect()
    assert len(got) == 1 and got[0]["rel_id"] == 1
    assert [[(q["x"], q["y"]) for q in r] for r in got[0]["polygons"][0]] == [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]]


def test_store_merge_and_replay(spark):
    a, b = points(spark, [(i, 100.0, 200.0) for i in (1, 3, 5, 7)]), points(spark, [(i, 1.0, 2.0) for i in (2, 3, 4, 8)])
    got = {r["id"]: r["x"] for r in delta.merge_stores(a, b).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 7, 8] and got[3] == 100.0
    base = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, value double")
    last = delta.last_changes(spark.createDataFrame([(1, 0, 1, "modify", 5.0), (1, 1, 2, "delete", None), (2, 0, 3, "create", 7.0), (1, 2, 1, "modify", 6.0)], "seq long, ord long, id long, op string, value double")).select("id", "op", "value")
    once = delta.upsert(base, last)
    assert sorted(map(tuple, once.collect())) == [(1, 6.0), (3, 7.0)] == sorted(map(tuple, delta.upsert(once, last).collect()))


def test_install(spark):
    t = lambda rows, s: spark.createDataFrame(rows, s)
    base = {"ways": t([(1,)], "id long"), "way_tags": t([(1, "a")], "id long, k string")}
    bundle = {"ways": t([(1,), (2,)], "id long"), "way_tags": t([(1, "b"), (2, "c")], "id long, k string")}
    out = regional.install(base, bundle, ["ways"], {"way_tags": ("ways", "id")})
    assert sorted(r["id"] for r in out["ways"].collect()) == [1, 2]
    assert sorted(map(tuple, out["way_tags"].collect())) == [(1, "a"), (2, "c")]


def test_export_by_region(spark, tmp_path):
    boxes = spark.createDataFrame([(0, "w", -180.0, 0.0, -90.0, 90.0), (1, "all", -180.0, 180.0, -90.0, 90.0)], "bit int, name string, min_lon double, max_lon double, min_lat double, max_lat double")
    ps = spark.createDataFrame([(i, -10.0 if i % 2 else 10.0, 0.0) for i in range(20)], "id long, lon double, lat double")
    regional.export(spatial.region_mask(ps, boxes), boxes, str(tmp_path / "out"))
    assert {r["region"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("region").count().collect()} == {"w": 10, "all": 20}


def test_tiles_wrap_and_names(spark):
    box = spark.createDataFrame([("o", 178.5, 10.0, -178.5, 11.5)], "name string, min_lon double, min_lat double, max_lon double, max_lat double")
    got = {(r["lat"], r["lon"]) for r in raster.box_tiles(box).collect()}
    assert got == {(la, lo) for la in (10, 11) for lo in (178, 179, -180, -179)}
    d = spark.createDataFrame([(39, -105)], "lat int, lon int").select(*(geo.tile_name(F.col("lat"), F.col("lon"), s) for s in ("usgs", "copernicus"))).first()
    assert tuple(d) == ("n40w105", "N39_00_W105_00")
    t = spark.createDataFrame([(39, -105), (10, 10)], "lat int, lon int")
    assert raster.outside_box(t, (-125.0, 24.0, -66.0, 50.0)).count() == 1


def test_profile_runs_north(spark):
    cells = [float(i) for i in range(1600)]
    tile = spark.createDataFrame([(1, 0.0, 10.0, 0.25, 0.25, 40, 40, cells)], "tile_id int, x0 double, y0 double, dx double, dy double, w int, h int, cells array<double>")
    o = spark.createDataFrame([(7, 5.1, 5.1, 0.0, 100.0)], "id long, lon double, lat double, bearing_deg double, distance_km double")
    rows = public.elevation_along_bearing_ft(o, tile, 10.0, 50_000.0).orderBy("distance_m").collect()
    assert [r["distance_m"] for r in rows] == [0.0, 50000.0, 100000.0]
    want = [cells[int((10 - r["lat"]) / 0.25) * 40 + int(r["lon"] / 0.25)] * 3.28084 for r in rows]
    assert [round(r["elevation_ft"], 6) for r in rows] == [round(w, 6) for w in want]


def test_quality(spark):
    rows = spark.createDataFrame([(i, "airport" if i == 0 else "random", 2 if i in (5, 9) else 0) for i in range(100)], "idx int, kind string, flags int")
    got = sorted(r["idx"] for r in quality.report_rows(rows, 13).collect())
    assert len(got) == 13 and {0, 5, 9} <= set(got)
    assert quality.report_rows(rows, 100).count() == 100
    s = quality.seeded_sample(spark.range(1000), 10, 3).collect()
    assert s == quality.seeded_sample(spark.range(1000).repartition(7), 10, 3).collect()
    lat = [r["lat"] for r in quality.sphere_points(spark, 2000, 1).collect()]
    assert abs(sum(abs(v) < 30 for v in lat) / 2000 - 0.5) < 0.05
    facts = spark.createDataFrame([("a", 10.0, 1.0, None), ("b", None, None, "KDEN"), ("c", 1.0, 1.0, None)], "key string, expected double, tolerance double, ident string")
    seen = spark.createDataFrame([("a", 10.5, None), ("b", None, "KDEN")], "key string, value double, ident string")
    assert {r["key"]: r["ok"] for r in quality.golden(facts, seen).collect()} == {"a": True, "b": True, "c": False}


def test_plans_stay_equi_joins(spark):
    """Grid joins must not fall back to nested loops, and filters and columns must reach the scan."""
    from skylattice.plans.queries import QUERIES

    for name in ("obstacles_nearby", "nearest_airport", "airspace_at_point", "raster_point_value"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_regions_beyond_a_mask_are_refused(spark):
    from skylattice.operators import spatial

    points = spark.createDataFrame([(1, 5.0, 5.0)], "id long, lon double, lat double")
    regions = lambda bits: spark.createDataFrame([(b, f"r{k}", 0.0, 10.0, 0.0, 10.0) for k, b in enumerate(bits)], "bit int, name string, min_lon double, max_lon double, min_lat double, max_lat double")
    all_of_them = regions(range(32))
    masked = spatial.region_mask(points, all_of_them)
    assert masked.first()["mask"] == (1 << 32) - 1 and spatial.expand_mask(masked, all_of_them).count() == 32
    for bits in ([*range(32), 31], [0, 32], [-1], [None]):
        for f in (lambda r: spatial.region_mask(points, r), lambda r: spatial.expand_mask(masked, r)):
            with pytest.raises(ValueError):
                f(regions(bits))
