import gzip
import json
import math
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylattice.functions import geodesic, magnetic, text, wkb
from skylattice.sources import loaders, osm

xy = st.tuples(st.floats(allow_nan=False), st.floats(allow_nan=False))
line = st.lists(xy, min_size=2, max_size=5)
shape = st.one_of(
    st.tuples(st.just("Point"), xy), st.tuples(st.just("LineString"), line), st.tuples(st.just("Polygon"), st.lists(line, max_size=3)),
    st.tuples(st.just("MultiLineString"), st.lists(line, max_size=3)), st.tuples(st.just("MultiPolygon"), st.lists(st.lists(line, max_size=2), max_size=3)),
)


@given(shape)
@settings(max_examples=200, deadline=None)
def test_wkb_round_trip(s):
    kind, coords = s
    data = wkb.encode(kind, coords)
    got = wkb.decode(data)
    assert got == (kind, coords, 3857)
    assert wkb.decode(data[:-1]) is None
    assert wkb.decode(b"\x00" + data[1:]) is None


def test_wkb_bad_counts():
    assert wkb.decode(struct.pack("<BII", 1, 2, 1 << 30)) is None
    assert wkb.decode(b"") is None and wkb.decode(None) is None


def test_wkb_columns(spark):
    sq = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    rows = [(bytearray(wkb.encode("Polygon", [sq])),), (bytearray(wkb.encode("Point", (1.0, 2.0), None)),), (None,), (bytearray(b"x"),)]
    df = spark.createDataFrame(rows, "b binary").select(wkb.rings(F.col("b")).alias("r"), wkb.srid(F.col("b")).alias("s"))
    got = df.collect()
    assert [(p["x"], p["y"]) for p in got[0]["r"][0]] == sq and got[0]["s"] == 3857
    assert [(r["r"], r["s"]) for r in got[1:]] == [(None, None)] * 3


def test_wkt():
    assert wkb.parse_multipolygon("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5),(5.1 5.1,5.2 5.1,5.2 5.2,5.1 5.1)))")[1][1][0] == (5.1, 5.1)
    assert len(wkb.parse_multipolygon("POLYGON ((0 0,1 0,1 1,0 0))")) == 1
    for bad in ("LINESTRING (0 0,1 1)", "POLYGON ((0 0,1 1)", "POLYGON ((0 0,1 1)))"):
        with pytest.raises(ValueError):
            wkb.parse_multipolygon(bad)


def test_text_repairs(spark):
    assert text.drop_invalid(b"a\xffb\xc3\xa9\x00c\xe2\x82") == "abéc"
    assert text.latin1_repair(b"Caf\xe9 \xc3\xa9") == "Café é"
    rows = [(bytearray(b"ok"),), (bytearray(b"a\xff\x00"),), (None,)]
    df = spark.createDataFrame(rows, "b binary").select(text.sanitize(F.col("b")).alias("s"), text.repair(F.col("b")).alias("r"))
    assert [tuple(r) for r in df.collect()] == [("ok", "ok"), ("a", "aÿ\x00"), (None, None)]


def test_numbers(spark):
    rows = [("12abc",), (" -7",), ("",), ("x",), ("3.5e2z",), (".5",), (None,)]
    df = spark.createDataFrame(rows, "s string").select(text.parse_int(F.col("s")).alias("i"), text.parse_double(F.col("s")).alias("d"))
    assert [tuple(r) for r in df.collect()] == [(12, 12.0), (-7, -7.0), (None, None), (None, None), (3, 350.0), (None, 0.5), (None, None)]


def test_geodesic_known_line():
    # Vincenty's Flinders Peak to Buninyong line, on WGS84 by the published GDA figures
    lon, lat = geodesic.direct(144.42486788888888, -37.95103341666667, 306.86815920333337, 54972.271)
    assert abs(lon - 143.92649552777778) < 1e-6 and abs(lat + 37.652821138888889) < 1e-6
    lon, lat = geodesic.direct(0.0, 0.0, 90.0, 1000.0)
    assert abs(lat) < 1e-12 and abs(lon - math.degrees(1000 / geodesic.A)) < 1e-9


def test_magnetic_dipole_and_grid(spark):
    axial = [(1, 0, -30000.0, 0.0, 0.0, 0.0)]
    assert np.allclose(magnetic.declination([10, -70], [45, -30], [0, 0], 0.0, axial), 0)
    tilted = [(1, 0, -29351.8, 0, 0, 0), (1, 1, -1410.8, 4545.4, 0, 0)]
    # by hand from the potential in Cartesian form at sea level: B is -grad of m.r / r^3
    lon, lat = np.radians(-100.0), np.radians(40.0)
    m = np.array([-1410.8, 4545.4, -29351.8])
    a, b = magnetic.A, magnetic.B
    curve = a * a / math.hypot(a * math.cos(lat), b * math.sin(lat))
    r = np.array([curve * math.cos(lat) * math.cos(lon), curve * math.cos(lat) * math.sin(lon), curve * (b / a) ** 2 * math.sin(lat)])
    n = np.linalg.norm(r)
    field = 3 * m.dot(r) * r / n**5 - m / n**3
    east = field @ np.array([-math.sin(lon), math.cos(lon), 0])
    north = field @ np.array([-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat)])
    assert abs(magnetic.declination([-100.0], [40.0], [0.0], 0.0, tilted)[0] - math.degrees(math.atan2(east, north))) < 1e-9
    tiles = magnetic.grid(spark, (-105.0, 35.0, -101.0, 39.0), 0.0, tilted).collect()
    assert [(t["tile_id"], len(t["cells"])) for t in tiles] == [("N30W110", 1600)]
    epoch, rows = magnetic.read_coefficients("2025.0 X 11/13/2024\n 1 0 -29351.8 0.0 12.0 0.0\n 1 1 -1410.8 4545.4 9.7 -21.5\n" + "9" * 48)
    assert epoch == 2025.0 and rows[1] == (1, 1, -1410.8, 4545.4, 9.7, -21.5)


def vi(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def fld(k, v):
    return vi(k << 3) + vi(v) if isinstance(v, int) else vi(k << 3 | 2) + vi(len(v)) + v


def zz(n):
    return n << 1 if n >= 0 else (-n << 1) - 1


def extract(codec):
    strings = [b"", b"name", b"X", b"highway", b"stop", b"outer"]
    table = b"".join(fld(1, s) for s in strings)
    pk = lambda vs: b"".join(vi(v) for v in vs)
    dense = fld(1, pk([zz(10), zz(1)])) + fld(8, pk([zz(400000000), zz(-5)])) + fld(9, pk([zz(-1050000000), zz(7)])) + fld(10, pk([1, 2, 0, 0]))
    way = fld(1, 7) + fld(2, pk([3])) + fld(3, pk([4])) + fld(8, pk([zz(10), zz(1), zz(-1)]))
    rel = fld(1, 9) + fld(8, pk([5, 0])) + fld(9, pk([zz(7), zz(3)])) + fld(10, pk([1, 0]))
    block = fld(1, table) + fld(2, fld(2, dense)) + fld(2, fld(3, way)) + fld(2, fld(4, rel))
    blob = fld(1, block) if codec == "raw" else fld(2, len(block)) + (fld(3, zlib.compress(block)) if codec == "zlib" else fld(4, block))
    head = lambda t, b: fld(1, t) + fld(3, len(b))
    out = b""
    for t, b in ((b"OSMHeader", fld(1, b"")), (b"OSMData", blob)):
        h = head(t, b)
        out += len(h).to_bytes(4, "big") + h + b
    return out


@pytest.mark.parametrize("codec", ["raw", "zlib", "other"])
def test_extract(spark, tmp_path, codec):
    (tmp_path / "a.osm.pbf").write_bytes(extract(codec))
    rows = {(r["kind"], r["id"]): r for r in osm.read_extract(spark, str(tmp_path)).collect()}
    if codec == "other":
        assert not rows
        return
    assert set(rows) == {("node", 10), ("node", 11), ("way", 7), ("relation", 9)}
    assert rows["node", 10]["tags"] == {"name": "X"} and rows["node", 11]["tags"] == {}
    assert abs(rows["node", 11]["lat"] - 39.9999995) < 1e-9 and abs(rows["node", 10]["lon"] + 105) < 1e-9
    assert rows["way", 7]["refs"] == [10, 11, 10] and rows["way", 7]["tags"] == {"highway": "stop"}
    assert [tuple(m) for m in rows["relation", 9]["members"]] == [(7, "outer")]
    offsets = [at for at, *_ in osm.blobs(extract(codec))]
    assert [t for _, t, _ in osm.blobs(extract(codec), offsets[1])] == ["OSMData"]


def test_airports_csv(spark, tmp_path):
    head = ",".join(f'"c{i}"' for i in range(19))
    good = '1,"KAAA","small_airport","A ""B"" C",40.5,-105.25,123x,"NA","US","US-CO","T","yes","","","KAAA","","http://h","","k w"'
    bad = '2,"KBBB","heliport","N",95,10,,"NA","US","US-CO","T","no","","","","","","",""'
    (tmp_path / "a.csv").write_text("\n".join([head, good, bad, "3,short"]) + "\n")
    df = loaders.airports(spark, str(tmp_path / "a.csv"))
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["name"] == 'A "B" C' and rows[1]["elevation_ft"] == 123 and rows[1]["scheduled"] and rows[1]["x"] is not None
    assert rows[2]["x"] is None and not rows[2]["scheduled"]
    assert sorted((r["key"], r["value"]) for r in loaders.airport_tags(df).collect()) == [("home_link", "http://h"), ("keywords", "k w")]


def test_obstacles_csv(spark, tmp_path):
    f = ["O1", "O", "US", "CO", "A,B", "40.1", "-105", "", "", "TOWER", "1", "00100", "x", "R", "1A", "N", "S", "A", "2024"]
    line = lambda v: ",".join(f'"{x}"' if "," in x else x for x in v)
    rows = ["OAS,head", "-----", "", line(f), line([*f[:5], "", *f[6:]]), "a,b"]
    (tmp_path / "o.dat").write_bytes("\n".join(rows).encode() + b"\n" + line([*f[:4], "Caf\xff", *f[5:]]).encode("latin-1") + b"\n")
    got = loaders.obstacles(spark, str(tmp_path / "o.dat")).orderBy("city").collect()
    assert [(r["city"], r["agl_ht"], r["amsl_ht"], r["verified"], r["h_accuracy"], r["v_accuracy"]) for r in got] == [("A,B", 100, 0, True, "1", "A"), ("Cafÿ", 100, 0, True, "1", "A")]


def test_airspace_json(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    fs = [{"properties": {"NAME": "A", "LOWER_VAL": "100", "CLASS": "B"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {"NAME": "N"}, "geometry": None}, {"properties": {"NAME": "M"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]
    (tmp_path / "c.json").write_text(json.dumps({"features": fs}, indent=1))
    got = {r["name"]: r for r in loaders.airspace(spark, str(tmp_path / "c.json"), "class").collect()}
    assert set(got) == {"A", "M"} and got["A"]["lower_val"] == 100.0 and got["A"]["city"] == "" and len(got["M"]["rings"]) == 2
    lines = [{"properties": {"IDENT": "IR1", "MTR_TYPE": 3}, "geometry": {"type": "LineString", "coordinates": c}} for c in ([[0, 0], [1, 1]], [[0, 0]])]
    (tmp_path / "r.json").write_text(json.dumps({"features": lines}))
    got = loaders.airspace(spark, str(tmp_path / "r.json"), "routes").collect()
    assert [(r["ident"], r["mtr_type"], len(r["points"])) for r in got] == [("IR1", 3, 2)]
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(Exception, match="no features"):
        loaders.airspace(spark, str(tmp_path / "bad.json"), "class").collect()
    items = [{"_id": "1", "name": "I", "type": 4, "icaoClass": 3, "country": "FR", "lowerLimit": {"value": 5, "unit": 1, "referenceDatum": 0}, "onDemand": True, "geometry": fs[0]["geometry"]}, {"_id": "2", "country": "US", "geometry": fs[0]["geometry"]}]
    (tmp_path / "p1.json").write_text(json.dumps({"items": items}))
    got = loaders.international(spark, str(tmp_path / "p1.json")).collect()
    assert [(r["id"], r["icao_class"], r["lower_val"], r["lower_unit"], r["on_demand"], r["by_notam"]) for r in got] == [("1", 3, 5.0, 1, True, False)]


def test_small_files(spark, tmp_path):
    (tmp_path / "manifest.txt").write_text("region=europe\nbbox=1,2,3,4\nexported_at=1700000000\n")
    assert {r["key"]: r["value"] for r in loaders.manifest(spark, str(tmp_path / "manifest.txt")).collect()}["bbox"] == "1,2,3,4"
    (tmp_path / "state.txt").write_text("#c\nsequenceNumber=123\ntimestamp=2024-01-02T03\\:04\\:05Z\n")
    s = loaders.feed_state(spark, str(tmp_path / "state.txt")).first()
    assert s["sequence"] == 123 and str(s["at"]) == "2024-01-02 03:04:05"
    (tmp_path / "a.wkt").write_text("MULTIPOLYGON(((0 0,4 0,4 4,0 0)))")
    assert loaders.region_outlines(spark, str(tmp_path), ["a"]).first()["name"] == "a"
    with pytest.raises(Exception):
        loaders.region_outlines(spark, str(tmp_path), ["a", "gone"]).collect()
    assert loaders.region_boxes(spark).count() == 22


OSC = """<osmChange><create><node id="1" lat="10" lon="20"><tag k="name" v="A"/></node><node id="2" lat="10" lon="21"/><node id="3" lat="11" lon="21"/>
<way id="5"><nd ref="1"/><nd ref="2"/><nd ref="0"/><nd ref="3"/><nd ref="1"/><tag k="building" v="hangar"/></way>
<way id="6"><nd ref="1"/><nd ref="2"/><tag k="highway" v="primary"/></way>
<relation id="8"><member type="way" ref="6" role=""/><member type="node" ref="1" role=""/><tag k="route" v="road"/></relation></create></osmChange>"""
OSC2 = """<osmChange><modify><node id="2" lat="12" lon="22"/><way id="5"><nd ref="1"/><nd ref="2"/><tag k="highway" v="x"/></way></modify><delete><relation id="8"/></delete></osmChange>"""


def write_feed(folder, n, body, zipped=False):
    d = folder / "000" / "000"
    d.mkdir(parents=True, exist_ok=True)
    (d / (f"{n:03d}.osc" + (".gz" if zipped else ""))).write_bytes(gzip.compress(body.encode()) if zipped else body.encode())


def test_feed_stream_equals_batch(spark, tmp_path):
    from skylattice.streaming.replication import Replica, apply_changes, empty_tables

    feed = tmp_path / "feed"
    write_feed(feed, 1, OSC)
    r = Replica(spark, str(tmp_path / "db"))
    r.follow(str(feed), str(tmp_path / "ck")).awaitTermination(120)
    t = r.tables()
    assert r.state() == (1, 1)
    assert {n: sorted(x["id"] for x in t[n].collect()) for n in t} == {"coords": [1, 2, 3], "nodes": [1], "ways": [6], "areas": [5], "relations": [8], "roads": [8]}
    write_feed(feed, 2, OSC2, True)
    r.follow(str(feed), str(tmp_path / "ck")).awaitTermination(120)
    t = r.tables()
    assert r.state() == (2, 2)
    assert {n: sorted(x["id"] for x in t[n].collect()) for n in t} == {"coords": [1, 2, 3], "nodes": [1], "ways": [5, 6], "areas": [], "relations": [], "roads": []}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(feed))
    both = osm.changes(files)
    once = apply_changes(empty_tables(spark), both)
    assert sorted(x["id"] for x in once["ways"].collect()) == [5, 6]
    before = sorted(map(tuple, t["coords"].collect()))
    r.apply(both)  # a replay changes nothing
    assert r.state() == (2, 2) and sorted(map(tuple, r.tables()["coords"].collect())) == before


def test_feed_regions_and_cascade(spark, tmp_path):
    from skylattice.streaming.replication import apply_changes, empty_tables

    def changes(seq, body):
        names = "seq long, ord long, op string, kind string, id long, tags map<string,string>, lon double, lat double, refs array<long>, members array<struct<id: long, role: string>>"
        return spark.createDataFrame([(seq, *x) for x in osm.changes_of(body.encode())], names)

    regions = spark.createDataFrame([(0, "far", 100.0, 120.0, 0.0, 20.0)], "bit int, name string, min_lon double, max_lon double, min_lat double, max_lat double")
    t = apply_changes(empty_tables(spark), changes(1, OSC), regions)
    assert t["coords"].count() == 3 and t["nodes"].count() == 0 and t["ways"].count() == 0
    t = apply_changes(empty_tables(spark), changes(1, OSC))
    moved = changes(2, '<osmChange><modify><node id="2" lat="40" lon="40"/></modify></osmChange>')
    y = lambda tables: max(p["y"] for p in tables["ways"].where("id = 6").first()["points"])
    assert y(apply_changes(t, moved)) == y(t) and y(apply_changes(t, moved, cascade=True)) > y(t)
