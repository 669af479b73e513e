"""Registered queries that go through files: what they read is first written from the benchmark tables, in the formats that the sources
take, so that the SQL beside each can say from the tables alone what must come back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo, text, wkb
from ..operators import quality, raster, regional, sinks, spatial, tags, ways
from ..programs import bundles, checks
from ..programs.importer import Import
from ..sources import loaders, mirror, osm, terrain
from . import public
from .fixtures import folder, frame, with_views as w, write_extract, write_file, write_lines
from .oracles import C, CLOSED, EXCL, IN, MADE, N, TAGS, X, Y

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers f(spark, t), where t(name) is a table or a derived view, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, lambda name: frame(spark, sf_dir, name))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# a map extract: written, imported in phases, and read back from the imported tables


def entities(t) -> DataFrame:
    """Every node but each tenth, with a name that is given twice; ways that close; relations with members that aren't ways."""
    pairs = lambda view: t(view).select("id", F.struct("k", F.col("v").cast("string").alias("v")).alias("p")).groupBy("id").agg(F.sort_array(F.collect_list("p")).alias("tags"))
    no = lambda kind: F.lit(None).cast(kind)
    members = "array<struct<id: long, role: string, type: int>>"
    twice = F.when(F.exists("tags", lambda p: p["k"] == "name"), F.concat(F.array(F.struct(F.lit("name").alias("k"), F.lit("old").alias("v"))), F.col("tags"))).otherwise(F.col("tags"))
    nodes = t("fx_nodes").where("id % 10 <> 0").join(pairs("fx_node_tags"), "id", "left").select(F.lit("node").alias("kind"), "id", twice.alias("tags"), "lon", "lat", no("array<long>").alias("refs"), no(members).alias("members"))
    from .queries import closed_refs

    refs = closed_refs(t).groupBy(F.col("way_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "node_id"))).alias("r"))
    made = refs.join(pairs("fx_way_tags"), "id", "left").select(F.lit("way").alias("kind"), "id", "tags", no("double").alias("lon"), no("double").alias("lat"), F.transform("r", lambda x: x["node_id"]).alias("refs"), no(members).alias("members"))
    held = t("fx_rel_members").groupBy(F.col("rel_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "way_id", "role"))).alias("m"))
    node = F.array(F.struct(F.lit(7).cast("long").alias("id"), F.lit("stop").alias("role"), F.lit(0).alias("type")))
    listed = F.concat(node, F.transform("m", lambda x: F.struct(x["way_id"].alias("id"), x["role"].alias("role"), F.lit(1).alias("type"))))
    one = lambda k, v: F.struct(F.lit(k).alias("k"), F.lit(v).alias("v"))
    kinds = F.when(F.col("id") % 3 == 0, F.array(one("type", "multipolygon"))).when(F.col("id") % 3 == 1, F.array(one("route", "road"), one("type", "route"))).otherwise(F.array(one("route", "bus"), one("type", "route")))
    rel = held.select(F.lit("relation").alias("kind"), "id", kinds.alias("tags"), no("double").alias("lon"), no("double").alias("lat"), no("array<long>").alias("refs"), listed.alias("members"))
    return nodes.unionByName(made).unionByName(rel)


_imported: dict[tuple[str, str], tuple[str, dict[int, int]]] = {}


def imported(spark: SparkSession, t) -> Import:
    """The import of the extract that the tables make, done once a session and folder."""
    at = (spark.sparkContext.applicationId, t("part").inputFiles()[0])
    if at not in _imported:
        root = folder(spark)
        starts = write_extract(spark, f"{root}/in/a.osm.pbf", entities(t))
        Import(spark, f"{root}/in", f"{root}/db").run()
        _imported[at] = root, starts
    return Import(spark, f"{_imported[at][0]}/in", f"{_imported[at][0]}/db")


WAY_TAGS = f"""wt as (select id, max(case when k='name' then v end) as name, max(case when k='area' then v end) area,
    bool_or(not {EXCL} and (k <> 'building' or v in ('hangar','terminal','control_tower')) and k <> '' and v <> '') keep,
    bool_or(k in ('highway','railway','waterway','power','man_made') or (k='barrier' and v in ('fence','wall','hedge','retaining_wall','city_wall'))) linear,
    bool_or(k in ('building','building:part','landuse','leisure','natural','amenity','shop','tourism','historic','military','boundary','place','sport','landcover')) areal from fx_way_tags group by id)"""
STORED = f"""{WAY_TAGS}, st as (select way_id id, wt.name, p, closed, case when not closed then false when area='yes' then true when area='no' then false when linear then false else areal end is_area
    from made join wt on wt.id = way_id where keep)"""
GEO = "fx_nodes", "fx_way_refs", "fx_way_tags"


@query(f"{w('fx_nodes')} select id, round(lon,7) lon, round(lat,7) lat, round({X.format('')},2) x, round({Y.format('')},2) y from fx_nodes where id % 10 <> 0")
def import_coords(spark, t):
    return imported(spark, t).table("coords").select("id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"), F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query(f"{w('fx_node_tags')}, {TAGS} select t.id, max(case when k='name' then v end) as name from t join s using (id) where keep and t.id % 10 <> 0 group by t.id")
def import_nodes(spark, t):
    return imported(spark, t).table("nodes").select("id", "name")


@query(f"""{w('fx_node_tags')}, {TAGS} select t.id, k key_name, v key_value from t join s using (id) where keep and t.id % 10 <> 0 and not {EXCL} and not (k = 'highway' and v = 'stop')
    and (not (k = 'natural' and v = 'tree') or high) and v <> ''""")
def import_node_tags(spark, t):
    return imported(spark, t).table("node_tags")


@query(f"{w(*GEO)}, {N}, {C}, {CLOSED}, {MADE}, {STORED} select id, name, cast(len(p) as int) n, round(p[1].x,2) x, round(p[-1].y,2) y from st where not is_area")
def import_ways(spark, t):
    return imported(spark, t).table("ways").select("id", "name", F.size("points").alias("n"), F.round(F.element_at("points", 1)["x"], 2).alias("x"), F.round(F.element_at("points", -1)["y"], 2).alias("y"))


@query(f"{w(*GEO)}, {N}, {C}, {CLOSED}, {MADE}, {STORED} select id, name, cast(len(p) as int) n from st where is_area")
def import_areas(spark, t):
    return imported(spark, t).table("areas").select("id", "name", F.size("points").alias("n"))


@query(f"{w(*GEO)}, {N}, {C}, {CLOSED}, {MADE}, {STORED} select f.id, k key_name, v key_value from fx_way_tags f join st using (id) where not is_area and not {EXCL} and v <> ''")
def import_way_tags(spark, t):
    return imported(spark, t).table("way_tags")


LINES = "ln as (select rel_id, count(*) n_lines, sum(len(p)) n_points from fx_rel_members m join st on st.id = m.way_id where not closed group by rel_id)"


@query(f"""{w(*GEO, 'fx_rel_members')}, {N}, {C}, {CLOSED}, {MADE}, {STORED}, {LINES} select rel_id id, cast(n_lines as int) n_lines, cast(n_points as int) n_points
    from (select distinct rel_id from fx_rel_members where rel_id % 3 <> 0) left join ln using (rel_id)""")
def import_relations(spark, t):
    rows = imported(spark, t).table("relations")
    return rows.select("id", F.when(F.col("lines").isNotNull(), F.size("lines")).alias("n_lines"), F.when(F.col("lines").isNotNull(), F.size(F.flatten("lines"))).alias("n_points"))


@query(f"{w(*GEO, 'fx_rel_members')}, {N}, {C}, {CLOSED}, {MADE}, {STORED}, {LINES} select rel_id id, cast(n_lines as int) n_lines from ln where rel_id % 3 = 1")
def import_roads(spark, t):
    return imported(spark, t).table("roads").select("id", F.size("lines").alias("n_lines"))


@query()
def import_multipolygons(spark, t):
    return imported(spark, t).table("multipolygons").select("id", F.size("polygons").alias("n_polygons"))


@query(f"""{w(*GEO)}, {N}, {C}, {CLOSED}, {MADE}, {STORED} select 'nodes' phase, 'coords' as table, count(*) n from c
    union all select 'ways', case when is_area then 'areas' else 'ways' end, count(*) from st group by 2""")
def import_statistics(spark, t):
    return imported(spark, t).statistics().where("table in ('coords', 'ways', 'areas')").select("phase", "table", "n")


@query(f"""{w('fx_nodes', 'fx_rel_members')} select 'node' kind, count(*) n from fx_nodes where id % 10 <> 0
    union all select 'relation', count(distinct rel_id) from fx_rel_members union all select 'way', count(distinct l_orderkey) from lineitem
    union all select 'members', count(*) from fx_rel_members""")
def extract_entities(spark, t):
    """Entities by kind, and the members that are ways, straight from the extract."""
    rows = osm.read_extract(spark, imported(spark, t).extract)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).unionByName(rows.agg(F.sum(F.when(F.col("kind") == "relation", F.size("members"))).alias("n")).select(F.lit("members").alias("kind"), "n"))


@query("select count(*) n, min(p_partkey) lowest from part where p_partkey % 10 <> 0 and p_partkey % 6 >= 3")
def extract_resumed(spark, t):
    """Nodes of the blobs from the middle of the file on: the blobs hold ids by their remainder."""
    path = imported(spark, t).extract + "/a.osm.pbf"
    _, starts = _imported[spark.sparkContext.applicationId, t("part").inputFiles()[0]]
    rows = osm.read_extract(spark, path, min(at for n, at in starts.items() if n >= 3))
    return rows.where("kind = 'node'").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lowest"))


# rings and polygons

SQUARE = "cast(n_nationkey * 100 as double)"


@query(f"""select n_nationkey rel_id, cast(case when n_nationkey % 2 = 0 then 1 else 2 end as int) n_polygons, cast(case when n_nationkey % 2 = 0 then 2 else 3 end as int) n_rings,
    cast(10 as int) n_first, 1600.0::double outer_area, 100.0::double hole_area from nation""")
def multipolygon_squares(spark, t):
    """Squares of two open halves, every second one reversed, with a square hole of two halves; odd ones have a second square beside."""
    n = t("nation")
    base = (F.col("n_nationkey") * 100).cast("double")
    at = lambda x, y: F.struct((base + x).alias("x"), F.lit(float(y)).alias("y"))
    half = lambda lo, hi, first: F.array(at(lo, lo), at(hi, lo), at(hi, hi)) if first else F.when(F.col("n_nationkey") % 3 == 0, F.array(at(lo, lo), at(lo, hi), at(hi, hi))).otherwise(F.array(at(hi, hi), at(lo, hi), at(lo, lo)))
    part = lambda pos, role, points: F.struct(F.lit(pos).alias("pos"), F.lit(role).alias("role"), points.alias("points"))
    parts = F.array(part(0, "inner", half(10, 20, True)), part(1, "outer", half(0, 40, False)), part(2, "inner", half(10, 20, False)), part(3, "", half(0, 40, True)))
    beside = F.when(F.col("n_nationkey") % 2 == 1, F.array(part(4, "outer", half(50, 60, True)), part(5, "outer", half(50, 60, False)))).otherwise(F.slice(parts, 1, 0))
    rows = n.select(F.col("n_nationkey").cast("long").alias("rel_id"), F.explode(F.concat(parts, beside)).alias("p")).select("rel_id", "p.*")
    shapes = ways.multipolygons(rows)
    area = lambda ring: F.abs(F.aggregate(geo.edges(ring), F.lit(0.0), lambda a, e: a + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2
    first = F.element_at("polygons", 1)
    return shapes.select(F.col("rel_id").cast("int").alias("rel_id"), F.size("polygons").alias("n_polygons"), F.size(F.flatten("polygons")).alias("n_rings"), F.size(F.flatten(first)).alias("n_first"), F.round(area(first[0]), 6).alias("outer_area"), F.round(area(first[1]), 6).alias("hole_area"))


@query(f"""{w('fx_nodes', 'fx_way_refs')}, {N}, {C}, {CLOSED}, {MADE} select way_id id, '0103000020110F000001000000' head, cast(3857 as int) srid, cast(len(p) as int) n, round(list_sum(list_transform(p, lambda q: q.x)),2) sum_x from made where closed
    union all select way_id, '0102000020110F0000', cast(3857 as int), null, null from made where not closed""")
def ewkb_round_trip(spark, t):
    """Lines and polygons as extended binary: the header in hex, the reference id, and the ring that is decoded from it."""
    from .queries import closed_refs, way_coords

    made = ways.assemble(closed_refs(t), way_coords(t))
    data = made.select(F.col("way_id").alias("id"), "closed", wkb.from_points(F.col("points"), F.col("closed")).alias("b"))
    ring = wkb.rings(F.col("b"))[0]
    rows = data.select("id", F.hex(F.substring("b", 1, F.when(F.col("closed"), 13).otherwise(9))).alias("head"), wkb.srid(F.col("b")).alias("srid"), ring.alias("r"))
    return rows.select("id", "head", "srid", F.when(F.col("r").isNotNull(), F.size("r")).alias("n"), F.round(F.aggregate("r", F.lit(0.0), lambda a, p: a + p["x"]), 2).alias("sum_x"))


# tabular files


def lines(spark, rows: DataFrame, head: list[str], name: str, encoding: str = "utf-8") -> str:
    """The rows' only column as lines of a file below a head."""
    return write_lines(spark, f"{folder(spark)}/{name}", rows, head, encoding)


def quoted(*values):
    """A CSV line with every value in quotes, quotes doubled."""
    return F.concat_ws(",", *(F.concat(F.lit('"'), F.replace(F.coalesce(v.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for v in values))


L = F.lit


@query(f"""{w('fx_airports')} select cast(id as int) id, ident || ', "' || type || '"' as name, type, case when id % 4 <> 1 then cast(id % 900 as int) end elevation_ft, id % 2 = 0 scheduled,
    case when id % 5 <> 0 then round({X.format('')},2) end x from fx_airports where id % 7 <> 3""")
def airport_rows(spark, t):
    """Airports of a file with quotes and commas in names, numbers with text after them, positions out of range, and short rows."""
    a = t("fx_airports")
    name = F.concat("ident", L(', "'), "type", L('"'))
    height = F.when(F.col("id") % 4 == 0, F.concat((F.col("id") % 900).cast("string"), L("ft"))).when(F.col("id") % 4 == 1, "x").otherwise((F.col("id") % 900).cast("string"))
    lat = F.when(F.col("id") % 5 == 0, L("95")).otherwise(F.col("lat").cast("string"))
    rows = quoted(F.col("id"), F.col("ident"), F.col("type"), name, lat, F.col("lon"), height, L("NA"), L("US"), L("US-X"), L("T"), F.when(F.col("id") % 2 == 0, "yes").otherwise("no"), *(L(x) for x in ("", "", "G", "", "http://h", "", "k w")))
    short = quoted(F.col("id"), F.col("ident"), F.col("type"), F.concat(name, L(",,,,,,,,,,,,,,,,,,")))
    path = lines(spark, a.select(F.when(F.col("id") % 7 == 3, short).otherwise(rows)), [",".join(f'"c{i}"' for i in range(19))], "airports.csv")
    return loaders.airports(spark, path).select("id", "name", "type", "elevation_ft", "scheduled", F.round("x", 2).alias("x"))


@query("""select 'home_link' as key, cast(count(*) as bigint) n from supplier where s_suppkey % 3 = 0 union all select 'keywords', count(*) from supplier""")
def airport_tag_rows(spark, t):
    empty = [L("")] * 9
    rows = t("supplier").select(quoted(F.col("s_suppkey"), F.col("s_name"), L("heliport"), F.col("s_name"), L("1"), L("2"), L("3"), *empty, F.when(F.col("s_suppkey") % 3 == 0, "http://h").otherwise(""), L(""), F.col("s_name")))
    path = lines(spark, rows, [",".join(f'"c{i}"' for i in range(19))], "airports.csv")
    return loaders.airport_tags(loaders.airports(spark, path)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("""select 'countries' as file, n_nationkey id, n_name || '|' || n_regionkey said from nation union all select 'regions', n_nationkey, 'R' || n_nationkey || '|' || n_name from nation
    union all select 'frequencies', n_nationkey, n_regionkey || '|' || (100 + n_nationkey) || '.25' from nation
    union all select 'runways', n_nationkey, (n_nationkey * 100) || '|true|' || n_nationkey || '.5' from nation
    union all select 'navaids', n_nationkey, (200 + n_nationkey) || '|-1.5|HI' from nation""")
def companion_files(spark, t):
    """The five files beside the airports, one row of each a nation."""
    n, k = t("nation"), F.col("n_nationkey")
    wide = {"countries": loaders.COUNTRIES, "regions": loaders.ISO_REGIONS, "frequencies": loaders.FREQUENCIES, "runways": loaders.RUNWAYS, "navaids": loaders.NAVAIDS}
    given = {
        "countries": {"id": k, "code": L("X"), "name": F.col("n_name"), "continent": F.col("n_regionkey")},
        "regions": {"id": k, "code": F.concat(L("R"), k.cast("string")), "name": F.col("n_name")},
        "frequencies": {"id": k, "airport_ref": F.col("n_regionkey"), "mhz": F.concat((k + 100).cast("string"), L(".25MHz"))},
        "runways": {"id": k, "length_ft": k * 100, "lighted": L("1"), "le_heading": F.concat(k.cast("string"), L(".5"))},
        "navaids": {"id": k, "khz": k + 200, "slaved_variation": L("-1.5"), "usage": L("HI")},
    }
    said = {"countries": ("name", "continent"), "regions": ("code", "name"), "frequencies": ("airport_ref", "mhz"), "runways": ("length_ft", "lighted", "le_heading"), "navaids": ("khz", "slaved_variation", "usage")}
    out = None
    for name, layout in wide.items():
        columns = [x.split(" ")[0] for x in layout.split(", ")]
        path = lines(spark, n.select(quoted(*(given[name].get(c, L("")) for c in columns))), [",".join(columns)], f"{name}.csv")
        rows = loaders.read_csv(spark, path, layout).select(L(name).alias("file"), "id", F.concat_ws("|", *(F.col(c).cast("string") for c in said[name])).alias("said"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""select 'O' || c_custkey oas, c_custkey % 3 = 0 verified, 'Caf' || chr(233) || ', ' || c_mktsegment city, cast(case when c_custkey % 4 = 0 then 0 else c_custkey % 2000 end as int) agl_ht, '1' h_accuracy, 'A' v_accuracy
    from customer where c_custkey % 5 <> 0 and c_custkey % 7 <> 0""")
def obstacle_rows(spark, t):
    """A Latin-1 file with quoted commas, lines to skip, rows without a position and numbers that don't parse."""
    k = F.col("c_custkey")
    city = F.concat(L('"Café, '), "c_mktsegment", L('"'))
    values = [F.concat(L("O"), k.cast("string")), F.when(k % 3 == 0, "O").otherwise("U"), L("US"), L("CO"), city, F.when(k % 5 == 0, "").otherwise("40.5"), L("-105.25"), L(""), L(""), L("TOWER"), L("1"), F.when(k % 4 == 0, "x").otherwise(F.lpad((k % 2000).cast("string"), 5, "0")), L("7"), L("R"), L("1A"), L("N"), L("S"), L("A"), L("2024")]
    row = F.when(k % 7 == 0, F.concat_ws(",", *values[:5])).otherwise(F.concat_ws(",", *values))
    path = lines(spark, t("customer").select(row), ["OAS,head", "-" * 20, ""], "obstacles.dat", "iso-8859-1")
    return loaders.obstacles(spark, path).select("oas", "verified", "city", "agl_ht", "h_accuracy", "v_accuracy")


def feature_file(spark, rows, name: str) -> str:
    return write_file(spark, f"{folder(spark)}/{name}", json.dumps({"type": "FeatureCollection", "features": rows}).encode())


def ring(k):
    return [[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]]


@query(f"""select 'class' as layer, n_name as name, cast(n_nationkey * 100 as double) lower_val, 'FT' uom, cast(1 as int) n_shapes, round(radians(n_nationkey)*6378137.0,2) x from nation where n_nationkey % 4 <> 0
    union all select 'special_use', n_name, cast(n_nationkey * 100 as double), 'FT', 2, round(radians(n_nationkey)*6378137.0,2) from nation where n_nationkey % 4 <> 0
    union all select 'defense_tfr', n_name, null, '', 1, round(radians(n_nationkey)*6378137.0,2) from nation where n_nationkey % 4 <> 0
    union all select 'routes', n_name, cast(n_nationkey * 100 as double), 'FT', 2, round(radians(n_nationkey)*6378137.0,2) from nation where n_nationkey % 4 <> 0""")
def airspace_files(spark, t):
    """Four feature files; every fourth feature has a shape that its layer doesn't take."""
    nations = [(r["n_nationkey"], r["n_name"]) for r in t("nation").collect()]
    out = None
    for layer in loaders.LAYERS:
        rows = []
        for k, name in nations:
            good = {"class": {"type": "Polygon", "coordinates": [ring(k)]}, "special_use": {"type": "MultiPolygon", "coordinates": [[ring(k)], [ring(k + 5)]]}, "defense_tfr": {"type": "Polygon", "coordinates": [ring(k)]}, "routes": {"type": "LineString", "coordinates": [[k, 0], [k + 1, 1]]}}[layer]
            bad = None if k % 8 == 0 else {"type": "LineString", "coordinates": [[k, 0]]}
            rows.append({"type": "Feature", "properties": {"NAME": name, "IDENT": name, "LOWER_VAL": str(k * 100) if k % 2 else k * 100, "LOWER_UOM": "FT", "MTR_TYPE": 1}, "geometry": bad if k % 4 == 0 else good})
        got = loaders.airspace(spark, feature_file(spark, rows, f"{layer}.json"), layer)
        shape = "points" if layer == "routes" else "rings"
        first = F.element_at(shape, 1) if layer == "routes" else F.element_at(F.element_at(shape, 1), 1)
        value = F.col("lower_val") if "lower_val" in got.columns else L(None).cast("double")
        part = got.select(L(layer).alias("layer"), F.col("ident" if layer == "routes" else "name").alias("name"), value.alias("lower_val"), (F.col("lower_uom") if "lower_uom" in got.columns else L("")).alias("uom"), F.size(shape).alias("n_shapes"), F.round(first["x"], 2).alias("x"))
        out = part if out is None else out.unionByName(part)
    return out


@query("""select cast(n_nationkey as varchar) id, n_name as name, cast(n_nationkey % 8 as int) icao_class, cast(n_nationkey * 10 as double) lower_val, cast(1 as int) lower_unit, n_nationkey % 2 = 0 on_demand
    from nation where n_nationkey % 6 <> 0""")
def international_pages(spark, t):
    """Pages of a folder; the country that has layers of its own is left out, pages after a short one aren't read."""
    items = [{"_id": str(r["n_nationkey"]), "name": r["n_name"], "type": 4, "icaoClass": r["n_nationkey"] % 8, "country": "US" if r["n_nationkey"] % 6 == 0 else "FR", "lowerLimit": {"value": str(r["n_nationkey"] * 10) if r["n_nationkey"] % 3 else r["n_nationkey"] * 10, "unit": 1, "referenceDatum": 0}, "onDemand": r["n_nationkey"] % 2 == 0, "geometry": {"type": "Polygon", "coordinates": [ring(r["n_nationkey"])]}} for r in t("nation").orderBy("n_nationkey").collect()]
    root = folder(spark)
    for page, at in enumerate(range(0, len(items), 10), 1):
        write_file(spark, f"{root}/page_{page}.json", json.dumps({"items": items[at : at + 10]}).encode())
    write_file(spark, f"{root}/page_9.json", json.dumps({"items": items[:3]}).encode())
    return loaders.international(spark, root, page_size=10).select("id", "name", "icao_class", "lower_val", "lower_unit", "on_demand")


@query(f"""{w('fx_nodes', 'fx_regions')} select r.name, count(*) n from fx_nodes n join fx_regions r on n.lon > r.min_lon and n.lon < r.max_lon and n.lat > r.min_lat and n.lat < r.max_lat group by r.name""")
def region_outline_counts(spark, t):
    """Outlines written as text, read, and used as the exact test of a mask; the region that wraps has no single outline here."""
    root, boxes = folder(spark), [r for r in t("fx_regions").collect() if r["min_lon"] <= r["max_lon"]]
    for r in boxes:
        a, b, c, d = r["min_lon"], r["min_lat"], r["max_lon"], r["max_lat"]
        write_file(spark, f"{root}/{r['name']}.wkt", f"MULTIPOLYGON((({a} {b},{c} {b},{c} {d},{a} {d},{a} {b})))".encode())
    shapes = loaders.region_outlines(spark, root, [r["name"] for r in boxes])
    regions = t("fx_regions").join(shapes, "name").select("bit", "name", "min_lon", "max_lon", "min_lat", "max_lat", "rings")
    masks = spatial.region_mask(t("fx_nodes"), regions)
    return spatial.expand_mask(masks, regions).withColumnRenamed("region", "name").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("""select n_nationkey id, cast(6000000 + n_nationkey as bigint) sequence, cast(timestamp '2024-01-01 00:00:00' + to_hours(n_nationkey) as timestamp) as "at", n_name region from nation where n_nationkey < 5""")
def state_files(spark, t):
    """Feed states with escaped colons, and manifests in which a key is repeated."""
    out = None
    for r in t("nation").where("n_nationkey < 5").collect():
        k = r["n_nationkey"]
        state = write_file(spark, f"{folder(spark)}/state.txt", f"#x\nsequenceNumber={6000000 + k}\ntimestamp=2024-01-01T{k:02d}\\:00\\:00Z\n".encode())
        held = write_file(spark, f"{folder(spark)}/manifest.txt", f"region=old\nbbox=1,2,3,4\nregion={r['n_name']}\n".encode())
        region = loaders.manifest(spark, held).where("key = 'region'").select(F.col("value").alias("region"))
        part = loaders.feed_state(spark, state).crossJoin(region).select(L(k).alias("id"), "sequence", "at", "region")  # one row each
        out = part if out is None else out.unionByName(part)
    return out


@query("""with c as (select n_nationkey k, unnest(range(0, 48)) i from nation where n_nationkey < 6) select 'g' || k || '/' || lpad(cast(i // 8 // 4 * 4 as varchar), 5, '0') || '/' || lpad(cast(i % 8 // 4 * 4 as varchar), 5, '0') tile_id,
    cast(k as double) + i % 8 // 4 * 4 * 0.5 x0, cast(10 as double) + (6 - i // 8 // 4 * 4) * 0.5 y0, cast(sum(case when i % 5 <> 0 then i + k end) as double) total, cast(count(*) as int) n from c where k % 2 = 1 group by k, i // 8 // 4, i % 8 // 4""")
def elevation_grids(spark, t):
    """Text grids of 6 x 8 cells in tiles of 4 x 4; of the grids that are there only those wanted and not loaded yet are read."""
    root = folder(spark)
    for r in t("nation").where("n_nationkey < 6").collect():
        k = r["n_nationkey"]
        rows = "\n".join(" ".join("-9999" if i % 5 == 0 else str(i + k) for i in range(8 * j, 8 * j + 8)) for j in range(6))
        write_file(spark, f"{root}/g{k}.asc", f"ncols 8\nnrows 6\nxllcorner {k}\nyllcorner 10\ncellsize 0.5\nNODATA_value -9999\n{rows}\n".encode())
    wanted = t("nation").select(F.concat(L("g"), F.col("n_nationkey").cast("string")).alias("tile"))
    got = terrain.load(spark, root, wanted, wanted.where("cast(substring(tile, 2) as int) % 2 = 0"), side=4)
    return got.select("tile_id", "x0", "y0", F.aggregate("cells", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))).alias("total"), F.size("cells").alias("n"))


# sinks


@query("""select 'good' as part, p_partkey id from part where p_size <= 40 union all select 'size', p_partkey from part where p_size > 40 and p_partkey % 2 = 0""")
def append_and_quarantine(spark, t):
    """Two appends to one folder; what fails a check lies beside it with its reason."""
    root = folder(spark)
    rows = t("part").select(F.col("p_partkey").alias("id"), "p_size")
    for some in (rows.where("id % 2 = 0"), rows.where("id % 2 = 1 and p_size <= 40")):
        sinks.append(some, f"{root}/parts", {"size": F.col("p_size") <= 40})
    return spark.read.parquet(f"{root}/parts").select(L("good").alias("part"), "id").unionByName(spark.read.parquet(f"{root}/parts_quarantine").select(F.col("reason").alias("part"), "id"))


@query("select p_partkey id, p_size + 1 size from part where p_partkey % 2 = 0")
def truncate_and_reload(spark, t):
    path = f"{folder(spark)}/t"
    rows = t("part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))
    sinks.reload(rows, path)
    sinks.reload(rows.where("id % 2 = 0").withColumn("size", F.col("size") + 1), path)
    return spark.read.parquet(path)


@query("""select 'sequence' as name, cast(9 as bigint) as value union all select 'absent', -1 union all select 'europe', 34""")
def state_and_regions(spark, t):
    """A state value set twice, one that isn't there, and a region registered twice."""
    now = F.lit("2024-06-01 00:00:00")
    state = spark.createDataFrame([], "name string, value long, checked_at timestamp")
    state = sinks.put_state(sinks.put_state(sinks.put_state(state, "sequence", 5, now), "other", 1, now), "sequence", 9, now)
    listed = spark.createDataFrame([], "name string, wkt string, min_lon double, min_lat double, max_lon double, max_lat double, installed_at timestamp")
    listed = sinks.register_region(sinks.register_region(listed, "europe", "", (1, 2, 3, 4), now), "europe", "", (-5, 34, 65, 82), now)
    rows = spark.createDataFrame([("sequence", sinks.get_state(state, "sequence")), ("absent", sinks.get_state(state, "absent"))], "name string, value long")
    return rows.unionByName(listed.select("name", F.col("min_lat").cast("long").alias("value")))


@query(f"{w('fx_nodes', 'fx_regions')} select r.name region, count(*) n, min(n.id) first, max(n.id) last, true ascending from fx_nodes n join fx_regions r on {IN.format('n.')} group by r.name")
def region_files(spark, t):
    """One folder a region, ids ascending through its files."""
    from pyspark.sql import Window

    path = f"{folder(spark)}/slices"
    regional.export(t("fx_nodes").join(spatial.region_mask(t("fx_nodes"), t("fx_regions")), "id"), t("fx_regions"), path)
    rows = spark.read.parquet(path).select("region", "id", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    order = Window.partitionBy("region", "file").orderBy("at")
    rows = rows.withColumn("before", F.lag("id").over(order))
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last"), F.coalesce(F.bool_and(F.col("before") < F.col("id")), F.lit(True)).alias("ascending"))


@query("""select 'html' as kind, count(*) n, true ok from nation union all select 'json', count(*), true from nation""")
def reports(spark, t):
    """The rows of both reports, counted from their text; markup in values is escaped."""
    rows = t("nation").select("n_nationkey", F.concat(L("<b>"), "n_name", L("&")).alias("name"))
    page, data = sinks.report_html(rows, "a < b"), json.loads(sinks.report_json(rows))
    return spark.createDataFrame([("html", page.count("<tr>") - 1, "&lt;b&gt;" in page and "a &lt; b" in page and "<b>" not in page), ("json", len(data), all(r["name"].startswith("<b>") for r in data))], "kind string, n long, ok boolean")


@query("select cast(7 as bigint) files, count(*) n from part")
def shuffled_table(spark, t):
    path = f"{folder(spark)}/r"
    sinks.write_shuffled(t("part"), path, 7)
    rows = spark.read.parquet(path).select(F.input_file_name().alias("file"))
    return rows.agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"))


# functions that had no query of their own


@query("""select p_partkey id, p_name dropped, chr(233) || p_name || chr(255) repaired from part""")
def text_repairs(spark, t):
    """Bad bytes dropped one by one, or read as Latin-1; a null byte goes in the first."""
    bad = F.concat(F.unhex(L("E9")), F.col("p_name").cast("binary"), F.unhex(L("FF")))
    return t("part").select(F.col("p_partkey").alias("id"), text.sanitize(F.concat(bad, F.unhex(L("00")))).alias("dropped"), text.repair(bad).alias("repaired"))


@query("""select o_orderkey id, round(year(o_orderdate) + (dayofyear(o_orderdate) - 1) / 365.25, 9) as years, round(degrees(asin((o_orderkey % 1000) / 1000.0::double * 2 - 1)), 9) lat from orders""")
def year_and_latitude(spark, t):
    return t("orders").select(F.col("o_orderkey").alias("id"), F.round(geo.decimal_year(F.col("o_orderdate")), 9).alias("years"), F.round(geo.uniform_latitude((F.col("o_orderkey") % 1000) / F.lit(1000.0)), 9).alias("lat"))


@query("""select a.n_nationkey a, b.n_nationkey b, case when b.n_nationkey % 3 = 0 then a.n_nationkey * 10 - 100 + 5 >= 150 or a.n_nationkey * 10 - 100 <= -160
    else a.n_nationkey * 10 - 100 <= b.n_nationkey * 8 - 90 and a.n_nationkey * 10 - 100 + 5 >= b.n_nationkey * 8 - 100 end meets from nation a join nation b on a.n_regionkey = b.n_regionkey""")
def range_overlaps(spark, t):
    n = t("nation")
    a, b = n.select(F.col("n_nationkey").alias("a"), "n_regionkey"), n.select(F.col("n_nationkey").alias("b"), "n_regionkey")
    lo, hi = F.when(F.col("b") % 3 == 0, 150).otherwise(F.col("b") * 8 - 100), F.when(F.col("b") % 3 == 0, -160).otherwise(F.col("b") * 8 - 90)
    return a.join(b, "n_regionkey").select("a", "b", geo.ranges_overlap(F.col("a") * 10 - 100, F.col("a") * 10 - 95, lo, hi).alias("meets"))


@query(f"{w('fx_nodes')} select cast(least(50, count(*)) as bigint) n, cast(0 as bigint) outside from fx_nodes where cast(floor(lon / 10) as bigint) % 3 = 0")
def covered_points(spark, t):
    """A seeded sample of the points in covered cells: as many as wanted, and none outside."""
    points = t("fx_nodes").select("id", F.floor(F.col("lon") / 10).alias("cell"))
    covered = points.where("cell % 3 = 0").select("cell").distinct()
    got = quality.covered_sample(points, covered, 50, 7)
    return got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cell") % 3 != 0).alias("outside"))


@query("""select n_nationkey origin_id, cast(unnest(range(0, n_nationkey * 1000 + 1, 500)) as double) distance_m, round(n_nationkey + degrees(unnest(range(0, n_nationkey * 1000 + 1, 500)) / 6378137.0), 8) lon, 0.0::double lat from nation where n_nationkey > 0""")
def equator_profile(spark, t):
    """Samples along the equator, where the geodesic is a circle's arc, in the order of their distance."""
    o = t("nation").where("n_nationkey > 0").select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").cast("double").alias("lon"), L(0.0).alias("lat"), L(90.0).alias("bearing_deg"), F.col("n_nationkey").cast("double").alias("distance_km"))
    tile = spark.createDataFrame([("t", -180.0, 10.0, 10.0, 10.0, 36, 2, [1.0] * 72)], "tile_id string, x0 double, y0 double, dx double, dy double, w int, h int, cells array<double>")
    return public.elevation_along_bearing_ft(o, tile, 400.0).select("origin_id", "distance_m", F.round("lon", 8).alias("lon"), F.round(F.abs("lat"), 8).alias("lat"))


DIPOLE = [(1, 0, -29351.8, 0.0, 0.0, 0.0), (1, 1, -1410.8, 4545.4, 0.0, 0.0)]
# the field of a dipole by vectors: 3 (m.r) r / |r|^5 - m / |r|^3 with r on the ellipsoid
FIELD = """p as (select id, lon, lat, radians(lon) l, radians(lat) f, 6378.137*6378.137/sqrt(pow(6378.137*cos(radians(lat)),2)+pow(6356.7523142*sin(radians(lat)),2)) c from pts),
    r as (select *, c*cos(f)*cos(l) x, c*cos(f)*sin(l) y, c*pow(6356.7523142/6378.137,2)*sin(f) z from p),
    d as (select *, -1410.8*x+4545.4*y-29351.8*z m, sqrt(x*x+y*y+z*z) n from r),
    b as (select *, 3*m*x/pow(n,5)+1410.8/pow(n,3) bx, 3*m*y/pow(n,5)-4545.4/pow(n,3) b_y, 3*m*z/pow(n,5)+29351.8/pow(n,3) bz from d),
    e as (select id, degrees(atan2(-bx*sin(l)+b_y*cos(l), -bx*sin(f)*cos(l)-b_y*sin(f)*sin(l)+bz*cos(f))) decl from b)"""


@query(f"{w('fx_nodes')}, pts as (select id, lon, lat from fx_nodes), {FIELD} select id, round(decl, 6) declination from e")
def dipole_declination(spark, t):
    from ..functions import magnetic

    return t("fx_nodes").select("id", F.round(magnetic.column(F.col("lon"), F.col("lat"), 0.0, DIPOLE), 6).alias("declination"))


@query(f"""{w('fx_nodes')}, pts as (select id, floor(lon / 0.5) * 0.5 + 0.25 lon, (floor(lat / 0.5) + 0.5) * 0.5 lat from fx_nodes where lon >= -20 and lon < 20 and lat > -20 and lat < 20 and lat * 2 <> floor(lat * 2)), {FIELD} select id point_id, round(decl, 6) declination from e""")
def declination_at_point(spark, t):
    """The declination grid, and the cell's value under each point."""
    from ..functions import magnetic

    tiles = magnetic.grid(spark, (-20.0, -20.0, 20.0, 20.0), 0.0, DIPOLE, step=0.5)
    points = t("fx_nodes").where("lon >= -20 and lon < 20 and lat > -20 and lat < 20 and lat * 2 <> floor(lat * 2)")
    return public.declination_at_point(points, tiles).select("point_id", F.round("declination", 6).alias("declination"))


@query(f"""{w('fx_nodes')} select id, floor(lat) < 25 or floor(lat) + 1 > 49 or floor(lon) < -125 or floor(lon) + 1 > -66 kept from fx_nodes""")
def tiles_outside_box(spark, t):
    tiles = t("fx_nodes").select("id", F.floor("lon").cast("int").alias("lon"), F.floor("lat").cast("int").alias("lat"))
    kept = raster.outside_box(tiles, (-125.0, 25.0, -66.0, 49.0)).select("id", L(True).alias("kept"))
    return tiles.join(kept, "id", "left").select("id", F.coalesce("kept", L(False)).alias("kept"))


@query(f"{w('fx_way_tags')} select id, k, v || '#2' v from fx_way_tags")
def last_tag_wins(spark, t):
    """A repeated key keeps its last value, whatever sorts first."""
    first = t("fx_way_tags").select("id", "k", F.concat(L("zzz"), "v").alias("v"), L(1).alias("at"))
    second = t("fx_way_tags").select("id", "k", F.concat("v", L("#2")).alias("v"), L(2).alias("at"))
    return tags.gather(first.unionByName(second)).select("id", F.explode("tags").alias("k", "v"))


# a change feed, followed as a stream from its files

FEED = """ev as (select cast(event_id // {size} as bigint) seq, event_id % {size} as ord, event_id, user_id as id, case event_type when 'error' then 'delete' when 'signup' then 'create' else 'modify' end op, value from events),
    ln as (select * from (select *, row_number() over (partition by id order by event_id desc) r from ev) where r = 1),
    co as (select id, cast(event_id % 3000 as double) / 20 - 75 lon, cast(event_id % 1700 as double) / 10 - 85 lat from ln where op <> 'delete')"""


#: Events of a change file at most; files come whole.
EVENTS = 5000


def change_files(spark, t) -> str:
    """Change files of the events, eight or more, of EVENTS events at most: a node an event, a way over it and the two ids after it by every
    third event, and a multipolygon over two such ways by every fifth. The first file has no changes of its own, and files lie in folders by
    sequence. They are written by the executors, every second one compressed, and only renamed by the driver."""
    root, made, rows = folder(spark), folder(spark), t("events")
    size = min(EVENTS, max(1, -(-rows.count() // 8)))
    k, name = F.col("event_id"), F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "signup", "create").otherwise("modify")
    say = lambda *parts: F.concat(*(p if not isinstance(p, str) else L(p) for p in parts))
    i = lambda c: c.cast("string")
    node = say('<node id="', i(F.col("user_id")), '" lon="', i((k % 3000).cast("double") / 20 - 75), '" lat="', i((k % 1700).cast("double") / 10 - 85), '"><tag k="name" v="n', i(k), ' &amp; co"/></node>')
    u = F.col("user_id")
    way = F.when(k % 3 == 0, say('<way id="', i(u), '"><nd ref="', i(u), '"/><nd ref="', i(u + 1), '"/><nd ref="0"/><nd ref="', i(u + 2), '"/><tag k="highway" v="w', i(k), '"/></way>')).otherwise("")
    rel = F.when(k % 5 == 0, say('<relation id="', i(u), '"><member type="way" ref="', i(u), '" role="outer"/><member type="node" ref="', i(u), '" role=""/><tag k="type" v="', F.when(k % 2 == 0, "multipolygon").otherwise("route"), '"/><tag k="boundary" v="b"/></relation>')).otherwise("")
    body = say("<", name, ">", node, way, rel, "</", name, ">")
    files = rows.select((F.floor(k / size) + 1).alias("seq"), k.alias("at"), body.alias("b"))
    ends = files.select("seq").distinct().select("seq", F.explode(F.array(F.struct(L(None).cast("long").alias("at"), L("<osmChange>").alias("b")), F.struct(L((1 << 63) - 1).alias("at"), L("</osmChange>").alias("b")))).alias("e")).select("seq", "e.*")
    every = files.unionByName(ends).repartition("seq").sortWithinPartitions("seq", "at")
    write_file(spark, f"{root}/000/000/000.osc", b"<osmChange/>")
    for odd, kind, codec in ((0, "osc", "none"), (1, "osc.gz", "gzip")):
        every.where(F.col("seq") % 2 == 1 - odd).select("seq", "b").write.partitionBy("seq").option("compression", codec).text(f"{made}/{kind}")
        for seq, path in parted(spark, f"{made}/{kind}"):
            moved(spark, path, f"{root}/{seq // 1_000_000:03d}/{seq // 1000 % 1000:03d}/{seq % 1000:03d}.{kind}")
    return root


def parted(spark, root: str) -> list[tuple[int, str]]:
    """(value, path) of the only file of each partition under root."""
    jvm, out = spark.sparkContext._jvm, []
    where = jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for at in fs.listStatus(where):
        if at.isDirectory() and "=" in at.getPath().getName():
            (one,) = [x.getPath().toString() for x in fs.listStatus(at.getPath()) if x.getPath().getName().startswith("part-")]
            out.append((int(at.getPath().getName().partition("=")[2]), one))
    return out


def moved(spark, path: str, to: str) -> None:
    jvm = spark.sparkContext._jvm
    where, there = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(there.getParent())
    if not fs.rename(where, there):
        raise OSError(f"{path} can't be moved to {to}")


_followed: dict[tuple[str, str], str] = {}


def followed(spark, t):
    """The replica that a feed left, once a session and folder."""
    from ..streaming.replication import Replica

    at = (spark.sparkContext.applicationId, t("part").inputFiles()[0])
    if at not in _followed:
        root = folder(spark)
        Replica(spark, f"{root}/db").follow(change_files(spark, t), f"{root}/checkpoint").awaitTermination()
        _followed[at] = f"{root}/db"
    return Replica(spark, _followed[at])


@query(f"with {FEED.format(size=1)} select id, round(lon, 7) lon, round(lat, 7) lat from co")
def feed_coords(spark, t):
    return followed(spark, t).tables()["coords"].select("id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query(f"with {FEED.format(size=1)} select id, 'n' || event_id || ' & co' as name from ln where op <> 'delete'")
def feed_nodes(spark, t):
    return followed(spark, t).tables()["nodes"].select("id", F.element_at("tags", "name").alias("name"))


LAST_WAY = """lw as (select * from (select *, row_number() over (partition by id order by event_id desc) r from ev where event_id % 3 = 0) where r = 1),
    wp as (select lw.id, lw.event_id, o.k, co.lon, co.lat from lw cross join (select 0 k union all select 1 union all select 2) o join co on co.id = lw.id + o.k where lw.op <> 'delete' and lw.id + o.k <> 0),
    ww as (select id, event_id, count(*) n, round(arg_min(lon, k), 6) lon from wp group by id, event_id having count(*) >= 2)"""


@query(f"with {FEED.format(size=1)}, {LAST_WAY} select id, 'w' || event_id as highway, cast(n as int) n, lon from ww")
def feed_ways(spark, t):
    """One batch: geometry from the last coordinates. A way that has been deleted or has no two nodes isn't there."""
    rows = followed(spark, t).tables()["ways"]
    return rows.select("id", F.element_at("tags", "highway").alias("highway"), F.size("points").alias("n"), F.round(geo.inverse_x(F.element_at("points", 1)["x"]), 6).alias("lon"))


@query(f"""with {FEED.format(size=1)}, {LAST_WAY}, lr as (select * from (select *, row_number() over (partition by id order by event_id desc) r from ev where event_id % 5 = 0) where r = 1)
    select case when lr.event_id % 2 = 0 then 'areas' else 'relations' end as table, count(*) n, sum(lr.id * (case when lr.event_id % 2 = 0 then -1 else 1 end)) ids
    from lr left join ww on ww.id = lr.id where lr.op <> 'delete' and (lr.event_id % 2 = 1 or ww.n = 3) group by 1""")
def feed_relations(spark, t):
    """Multipolygons are areas under the negative id where their ring has three places at least; other relations keep their row."""
    got = followed(spark, t).tables()
    both = got["areas"].where("id < 0").select(L("areas").alias("table"), "id").unionByName(got["relations"].select(L("relations").alias("table"), "id"))
    return both.groupBy("table").agg(F.count(F.lit(1)).alias("n"), F.sum("id").cast("decimal(38,0)").cast("long").alias("ids"))


# regions: shapes that meet them

SHAPES = """sh as (select id, lon px, lat py, least(180.0::double, lon + 31 - id % 7) qx, lat + 17 - id % 5 qy from fx_airports),
    bx as (select bit, name, min_lon a, max_lon b, min_lat c, max_lat d from fx_regions where min_lon <= max_lon union all select bit, name, min_lon, 180, min_lat, max_lat from fx_regions where min_lon > max_lon
        union all select bit, name, -180, max_lon, min_lat, max_lat from fx_regions where min_lon > max_lon)"""
CLIP = "greatest(0.0, least((a-px)/(qx-px), (b-px)/(qx-px)), least((c-py)/(qy-py), (d-py)/(qy-py))) <= least(1.0, greatest((a-px)/(qx-px), (b-px)/(qx-px)), greatest((c-py)/(qy-py), (d-py)/(qy-py)))"


def long_lines(t) -> DataFrame:
    p, q = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")), F.struct(F.least(L(180.0), F.col("lon") + 31 - F.col("id") % 7).alias("x"), (F.col("lat") + 17 - F.col("id") % 5).alias("y"))
    return t("fx_airports").select("id", F.array(p, q).alias("points"))


@query(f"{w('fx_airports', 'fx_regions')}, {SHAPES} select id, cast(bit_or(cast(1 as bigint) << bit) as bigint) mask from sh join bx on {CLIP} group by id")
def line_region_mask(spark, t):
    """Lines of two points, most of which cross regions without a vertex in them."""
    return regional.classify_shapes(long_lines(t), t("fx_regions"))


@query(f"""{w('fx_airspace', 'fx_regions')}, bx as (select bit, min_lon a, max_lon b, min_lat c, max_lat d from fx_regions where min_lon <= max_lon union all select bit, min_lon, 180, min_lat, max_lat from fx_regions where min_lon > max_lon
        union all select bit, -180, max_lon, min_lat, max_lat from fx_regions where min_lon > max_lon),
    s as (select id, min_lon - 90 x0, max_lon + 90 x1, min_lat - 90 y0, max_lat + 90 y1 from fx_airspace)
    select id, cast(bit_or(cast(1 as bigint) << bit) as bigint) mask from s join bx on x0 <= b and x1 >= a and y0 <= d and y1 >= c group by id""")
def ring_region_mask(spark, t):
    """Rings of a quarter of the world and more: they cross regions, lie in them, or go around them."""
    x0, x1, y0, y1 = F.col("min_lon") - 90, F.col("max_lon") + 90, F.col("min_lat") - 90, F.col("max_lat") + 90
    return regional.classify_shapes(t("fx_airspace").select("id", geo.box_ring(x0, y0, x1, y1).alias("points")), t("fx_regions"))


@query(f"""{w('fx_nodes', 'fx_airspace')}, {N}, b as (select id, radians(min_lon)*6378137.0 x0, radians(max_lon)*6378137.0 x1, ln(tan(pi()/4+radians(greatest(-85.0,min_lat))/2))*6378137.0 y0, ln(tan(pi()/4+radians(least(85.0,max_lat))/2))*6378137.0 y1 from fx_airspace),
    d as (select n.id point_id, b.id, sqrt(pow(greatest(x0-x, 0.0, x-x1), 2) + pow(greatest(y0-y, 0.0, y-y1), 2)) dist from n cross join b) select point_id, id, round(dist, 3) dist_m from d where dist <= 200000""")
def areas_nearby(spark, t):
    """Areas near points; a point inside has distance 0."""
    from .queries import airspace, nodes

    areas = airspace(t).select("id", F.col("rings")[0].alias("points"))
    return spatial.areas_within(nodes(t), areas, 200_000.0, ["id"]).select("point_id", "id", F.round("dist", 3).alias("dist_m"))


@query(f"""{w('fx_nodes', 'fx_regions')}, v as (select lon, lat, cast(bit_or(case when id % 2 = 0 then 3 else 12 end) as bigint) mask from fx_nodes where id % 3 <> 0 group by lon, lat),
    m as (select n.id, cast(bit_or(cast(1 as bigint) << r.bit) as bigint) mask from fx_nodes n join fx_regions r on {IN.format('n.')} group by n.id)
    select n.id, v.mask & ~coalesce(m.mask, 0) mask from fx_nodes n join v on v.lon = n.lon and v.lat = n.lat left join m on m.id = n.id where v.mask & ~coalesce(m.mask, 0) <> 0""")
def extra_nodes(spark, t):
    """Nodes at the places of wanted vertices, without the regions that hold them already."""
    from .queries import nodes

    n = nodes(t)
    wanted = n.where("id % 3 <> 0").select("x", "y", F.when(F.col("id") % 2 == 0, 3).otherwise(12).cast("long").alias("mask"))
    return spatial.exact_matches(n, wanted, spatial.region_mask(t("fx_nodes"), t("fx_regions")))


# bundles: the imported database cut into regions, and two of them installed elsewhere

_bundled: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def bundled(spark, t) -> tuple[str, DataFrame]:
    """The folder of the exported bundles and the counts that the export returned, once a session and folder."""
    at = (spark.sparkContext.applicationId, t("part").inputFiles()[0])
    if at not in _bundled:
        one, root = imported(spark, t), f"{folder(spark)}/bundles"
        names = ["coords", "nodes", "node_tags", "ways", "way_tags", "areas", "area_tags", "relations", "relation_tags"]
        counts = bundles.export({n: one.table(n) for n in names}, t("fx_regions"), root, 1700000000, per_batch=3)
        _bundled[at] = root, counts
    return _bundled[at]


BOX = """bx as (select bit, name, min_lon a, max_lon b, min_lat c, max_lat d from fx_regions where min_lon <= max_lon union all select bit, name, min_lon, 180, min_lat, max_lat from fx_regions where min_lon > max_lon
    union all select bit, name, -180, max_lon, min_lat, max_lat from fx_regions where min_lon > max_lon)"""
KEPT_NODES = f"kn as (select t.id from t join s using (id) where keep and t.id % 10 <> 0 group by t.id)"  # noqa: F541


@query(f"""{w('fx_nodes', 'fx_node_tags', 'fx_regions')}, {TAGS}, {KEPT_NODES}, {BOX}, q as (select bx.name region, n.id from fx_nodes n join kn using (id) join bx on n.lon between a and b and n.lat between c and d)
    select region, 'nodes' as table, count(*) n from q group by region
    union all select region, 'node_tags', count(*) from q join t using (id) where not {EXCL} and not (k = 'highway' and v = 'stop') and (not (k = 'natural' and v = 'tree') or high) and v <> '' group by region""")
def bundle_rows(spark, t):
    """Rows of the bundles' node tables, counted from their files; the manifests must say the same."""
    root, counts = bundled(spark, t)
    out = None
    for r in t("fx_regions").collect():
        said = loaders.manifest(spark, f"{root}/{r['name']}/manifest").where("key like 'table.%.rows'").select(F.split("key", "[.]")[1].alias("table"), F.col("value").cast("long").alias("n"))
        part = said.where("table in ('nodes', 'node_tags') and n > 0").join(counts.where(F.col("region") == r["name"]).select("table", "n"), ["table", "n"], "left_semi").select(L(r["name"]).alias("region"), "table", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""{w(*GEO, 'fx_regions')}, {N}, {C}, {CLOSED}, {MADE}, {STORED}, v as (select id, is_area, unnest(p) q from st)
    select case when is_area then 'areas' else 'ways' end as table, r.name region, count(distinct v.id) n from v join c on c.x = v.q.x and c.y = v.q.y join fx_regions r on {IN.format('c.')} group by 1, 2""")
def bundle_shapes(spark, t):
    """Ways and areas of the bundles that have a vertex in the region; those that only cross it are in the bundles too and don't count here."""
    root, _ = bundled(spark, t)
    out = None
    for r in t("fx_regions").collect():
        for name in ("ways", "areas"):
            rows = schemas.read(spark, f"{root}/{r['name']}", name).select("id", F.explode("points").alias("p")).select("id", F.round(geo.inverse_x(F.col("p.x")), 9).alias("lon"), F.round(geo.inverse_y(F.col("p.y")), 9).alias("lat"))
            inside = geo.in_range(F.col("lon"), L(r["min_lon"]), L(r["max_lon"])) & F.col("lat").between(r["min_lat"], r["max_lat"])
            part = rows.where(inside).agg(F.count_distinct("id").alias("n")).select(L(name).alias("table"), L(r["name"]).alias("region"), "n").where("n > 0")
            out = part if out is None else out.unionByName(part)
    return out


@query(f"""{w('fx_nodes', 'fx_node_tags', 'fx_regions')}, {TAGS}, {KEPT_NODES}, {BOX}, q as (select distinct n.id from fx_nodes n join kn using (id) join bx on bx.bit in (1, 2) and n.lon between a and b and n.lat between c and d)
    select 'nodes' as table, count(*) n, count(distinct id) ids from q union all
    select 'node_tags', count(*), count(distinct t.id) from q join t using (id) where not {EXCL} and not (k = 'highway' and v = 'stop') and (not (k = 'natural' and v = 'tree') or high) and v <> ''
    union all select 'installed_regions', 2, 2""")
def installed_rows(spark, t):
    """Two bundles that overlap, the first one twice, into an empty database: nothing is there twice."""
    root, _ = bundled(spark, t)
    db, names = folder(spark), [r["name"] for r in t("fx_regions").where("bit in (1, 2)").orderBy("bit").collect()]
    for name in [*names, names[0]]:
        bundles.install(spark, f"{root}/{name}", db, "2024-06-01 00:00:00")
    parts = [schemas.read(spark, db, n).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("ids")).select(L(n).alias("table"), "n", "ids") for n, key in (("nodes", "id"), ("node_tags", "id"), ("installed_regions", "name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""{w('fx_nodes', 'fx_node_tags')} select 'node_tags' as table, count(*) n from fx_node_tags where id % 10 = 0 union all select 'way_tags', count(*) from (select 1 from orders where o_orderkey % 4 = 0 and o_orderkey % 3 <> 0)""")
def orphan_pairs(spark, t):
    way_tags = t("fx_way_tags").where("k = 'name'").select("id")
    tables = {"node_tags": t("fx_node_tags"), "nodes": t("fx_nodes").where("id % 10 <> 0"), "way_tags": way_tags, "ways": t("orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"))}
    return checks.orphan_counts(tables, {"node_tags": "nodes", "way_tags": "ways"})


@query("select count(*) n from nation where n_nationkey % 2 = 1")
def multipart_area_count(spark, t):
    one = F.array(F.array(F.array(F.struct(L(0.0).alias("x"), L(0.0).alias("y")))))
    rows = t("nation").select((F.when(F.col("n_nationkey") % 5 == 4, 1).otherwise(-1) * 0 - F.col("n_nationkey") - 1).alias("id"), F.when(F.col("n_nationkey") % 2 == 1, F.concat(one, one)).otherwise(one).alias("polygons"))
    return checks.multipart_areas(rows)


@query("select cast(least(5, count(*)) as bigint) n, cast(0 as bigint) wrong from supplier where s_suppkey % 2 = 0 and s_suppkey % 3 = 0 and s_suppkey < 1000")
def minor_airport_sample(spark, t):
    k = F.col("s_suppkey")
    rows = t("supplier").select(F.when(k % 2 == 0, "small_airport").otherwise("heliport").alias("type"), L("US").alias("country"), F.when((k % 3 == 0) & (k < 1000), F.concat(L("K"), F.lpad(k.cast("string"), 3, "0"))).otherwise(F.concat(L("k"), k.cast("string"))).alias("ident"), k.alias("k"))
    got = checks.minor_airports(rows, 5, 3)
    return got.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("k") % 2 != 0) | (F.col("k") % 3 != 0)).alias("wrong"))


@query("""select 'structure' as kind, true as pass, cast(5 as bigint) n union all select 'structure', false, 6 union all select 'fact', true, 1 union all select 'fact', false, 1""")
def check_results(spark, t):
    """The checks of the imported database: no orphans, far too few rows, one fact that holds and one that doesn't."""
    facts = spark.createDataFrame([("a", 10.0, 1.0, None), ("b", 10.0, 1.0, None)], "key string, expected double, tolerance double, ident string")
    measured = spark.createDataFrame([("a", 10.5, None), ("b", 12.0, None)], "key string, value double, ident string")
    found = checks.Checks(spark, imported(spark, t).root, facts, measured).results()
    return found.groupBy("kind", "pass").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{w('fx_regions')} select 'missing' as what, cast({len(schemas.TABLES)} as bigint) n union all select 'again', 0 union all select 'columns', {sum(1 for _ in schemas.TABLES)}""")
def schema_tables(spark, t):
    """Tables that are created in an empty folder, then nothing more; each reads by its schema."""
    root = folder(spark)
    first, second = schemas.ensure(spark, root), schemas.ensure(spark, root)
    good = [n for n in schemas.TABLES if schemas.conform(schemas.read(spark, root, n), n).schema.names == schemas.struct(spark, n).names]
    return spark.createDataFrame([("missing", len(first)), ("again", len(second)), ("columns", len(good))], "what string, n long")


@query(f"""{w('fx_nodes', 'fx_obstacles', 'fx_airspace')}, {N}, o as (select *, {X.format('')} x, {Y.format('')} y from fx_obstacles)
    select 'obstacles' as what, count(*) n, count(distinct n.id) points from n join o on abs(n.x-o.x) <= 100000 and sqrt((n.x-o.x)*(n.x-o.x)+(n.y-o.y)*(n.y-o.y)) <= 100000
    union all select 'airspace', count(*), count(distinct n.id) from fx_nodes n join fx_airspace a on n.lon > min_lon and n.lon < max_lon and n.lat > greatest(-85.0, min_lat) and n.lat < least(85.0, max_lat)""")
def points_in_metres(spark, t):
    """The point functions with points in the projected reference system, served in order."""
    from .queries import airspace, nodes

    points = nodes(t).select("id", "x", "y")
    near = public.served(public.obstacles_nearby(points, t("fx_obstacles"), 100_000.0, srid=3857))
    layers = {"class": airspace(t).withColumn("class", L("C"))}
    held = public.airspace_at_point(points, layers, srid=3857)
    count = lambda df, what: df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("point_id").alias("points")).select(L(what).alias("what"), "n", "points")
    return count(near, "obstacles").unionByName(count(held, "airspace"))


@query("""with n as (select p_partkey id, cast(p_partkey as bigint) * p_partkey * 7919 n, p_partkey * 7.3::double s from part) select id,
    case when n >= 1000000000 then (n // 1000000000) || '.' || (n % 1000000000 // 100000000) || 'B' when n >= 1000000 then (n // 1000000) || '.' || (n % 1000000 // 100000) || 'M'
        when n >= 1000 then (n // 1000) || '.' || (n % 1000 // 100) || 'K' else cast(n as varchar) end said,
    case when s < 60 then printf('%.1fs', s) when s >= 3600 then printf('%d:%02d:%02d', cast(floor(s) as bigint) // 3600, cast(floor(s) as bigint) % 3600 // 60, cast(floor(s) as bigint) % 60)
        else printf('%d:%02d', cast(floor(s) as bigint) // 60, cast(floor(s) as bigint) % 60) end took from n""")
def human_figures(spark, t):
    k = F.col("p_partkey").cast("long")
    return t("part").select(k.alias("id"), text.human_count(k * k * 7919).alias("said"), text.duration(k * F.lit(7.3)).alias("took"))


@query(r"""select p_partkey id, case when p_partkey % 3 = 0 then '"' || p_name || ',""' || '"' else p_name end field, '''it''' || chr(92) || '''''s ' || p_name || '''' arg, 'a &lt;b&gt; &amp; ' || p_name said from part""")
def quoted_text(spark, t):
    name = F.col("p_name")
    field = F.when(F.col("p_partkey") % 3 == 0, F.concat(name, L(',"'))).otherwise(name)
    return t("part").select(F.col("p_partkey").alias("id"), text.csv_field(field).alias("field"), text.shell_argument(F.concat(L("it's "), name)).alias("arg"), text.markup(F.concat(L("a <b> & "), name)).alias("said"))


@query("""with v as (select n_nationkey k, unnest(range(0, 48)) i from nation), b as (select k, i // 8 r, i % 8 c, cast(ceil(((i * 7 + k) % 20 - (select floor(min((i * 7 + k) % 20) / 4.0) * 4 from v where i % 5 <> 0)) / 4.0) as int) band from v where i % 5 <> 0),
    z as (select *, case when lag(band) over o is distinct from band or lag(c) over o is distinct from c - 1 then 1 else 0 end first from b window o as (partition by k, r order by c))
    select band, cast(sum(first) as bigint) n, cast(count(*) as double) area from z group by band""")
def band_rectangles(spark, t):
    """Bands as rectangles: their number, and their area in cells."""
    cells = F.transform(F.sequence(L(0), L(47)), lambda i: F.when(i % 5 != 0, ((i * 7 + F.col("n_nationkey")) % 20).cast("double")))
    tiles = t("nation").select(F.col("n_nationkey").cast("string").alias("tile_id"), (F.col("n_nationkey") * 10).cast("double").alias("x0"), L(6.0).alias("y0"), L(1.0).alias("dx"), L(1.0).alias("dy"), L(8).alias("w"), L(6).alias("h"), cells.alias("cells"))
    wide = (F.col("ring")[2]["x"] - F.col("ring")[0]["x"]) * (F.col("ring")[2]["y"] - F.col("ring")[0]["y"])
    return raster.band_rectangles(tiles, 4.0).groupBy("band").agg(F.count(L(1)).alias("n"), F.round(F.sum(wide), 6).alias("area"))


@query(f"""{w('fx_regions')}, la as (select unnest(range(-60,75)) lat), lo as (select unnest(range(-180,180)) lon),
    q as (select r.name, r.bit, lat, lon from fx_regions r cross join la cross join lo where case when min_lon<=max_lon then lon>=floor(min_lon) and lon<ceil(max_lon) else lon>=floor(min_lon) or lon<ceil(max_lon) end)
    select name, count(*) n from q where not (bit = 0 and lon >= -125 and lon + 1 <= -100 and lat >= 25 and lat + 1 <= 49)
        and not exists (select 1 from nation where n_nationkey = lat and n_nationkey * 3 = lon) group by name""")
def global_sweep(spark, t):
    done = t("nation").select(geo.tile_name(F.col("n_nationkey"), F.col("n_nationkey") * 3, "copernicus").alias("tile"))
    first = t("fx_regions").where("bit = 0").first()["name"]
    return raster.sweep(t("fx_regions"), done, (-125.0, 25.0, -100.0, 49.0), first).groupBy("name").agg(F.count(L(1)).alias("n"))


@query("""select 'whole' as what, 'ok' said union all select 'short', 'partial' union all select 'long', 'too long' union all select 'old', 'stale' union all select 'other', 'corrupt' union all select 'absent', 'missing'""")
def mirrored_files(spark, t):
    import hashlib

    data = "\n".join(r["n_name"] for r in t("nation").orderBy("n_nationkey").collect()).encode()
    path, said = write_file(spark, f"{folder(spark)}/planet", data), hashlib.md5(data).hexdigest()
    tries = {"whole": (path, len(data), 0, said), "short": (path, len(data) + 1, 0, said), "long": (path, len(data) - 1, 0, said), "old": (path, len(data), 1 << 40, said), "other": (path, len(data), 0, "0" * 32), "absent": (path + "-", len(data), 0, said)}
    return spark.createDataFrame([(k, mirror.verify(spark, *v)) for k, v in tries.items()], "what string, said string")


@query("""select 'stored' as what, cast(3857 as int) srid union all select 'other', 4326 union all select 'none', 3857""")
def table_srids(spark, t):
    points = F.array(F.struct(L(0.0).alias("x"), L(0.0).alias("y")), F.struct(F.col("n_nationkey").cast("double").alias("x"), L(1.0).alias("y")))
    made = lambda srid: t("nation").select(wkb.from_points(points, L(False), srid).alias("g"))
    rows = [("stored", wkb.common_srid(made(3857), "g")), ("other", wkb.common_srid(made(4326), "g")), ("none", wkb.common_srid(made(3857).where("g is null"), "g"))]
    return spark.createDataFrame(rows, "what string, srid int")


@query("select cast(40 as bigint) n, cast(0 as bigint) outside, cast(40 as bigint) ids from nation limit 1")
def sphere_sample(spark, t):
    """Points over the sphere that fall into covered cells, a sixth of it: drawn again until there are enough."""
    cover = spark.range(72).selectExpr("cast(id % 36 as bigint) - 18 as cx", "cast(floor(id / 36) as bigint) as cy")
    got = quality.covered_points(spark, cover, 40, 5, 10.0)
    return got.agg(F.count(L(1)).alias("n"), F.count_if((F.col("lat") < 0) | (F.col("lat") >= 20)).alias("outside"), F.count_distinct("id").alias("ids"))


ORACLES["declination_dipole"] = f"{w('fx_airports')}, pts as (select id, lon, lat from fx_airports), {FIELD} select id, round(decl, 4) declination from e"


@query(f"{w('fx_nodes')}, {N} select id, round(x, 3) x, round(y, 3) y from n where x between -2000000 and 5000000 and y between -3000000 and 1000000")
def rows_of_a_box(spark, t):
    """A table laid out by grid cell, and a box of it."""
    from .queries import nodes

    path = f"{folder(spark)}/cells"
    sinks.write_by_cell(nodes(t).select("id", "x", "y"), path, 500_000.0, files=8)
    got = sinks.read_box(spark, path, 500_000.0, (-2_000_000.0, -3_000_000.0, 5_000_000.0, 1_000_000.0))
    return got.select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(f"{w('fx_nodes', 'fx_regions')}, {N}, {C} select c.id, round(c.lon, 7) lon, round(c.lat, 7) lat from c join fx_regions r on r.bit = 1 and {IN.format('c.')} where c.id % 3 = 0")
def bundle_coordinates(spark, t):
    """Lookups by id in the coordinates of one bundle, of which those inside the region are compared; vertices beyond it are there too."""
    root, _ = bundled(spark, t)
    r = t("fx_regions").where("bit = 1").first()
    rows = bundles.read_coordinates(spark, f"{root}/{r['name']}").join(t("fx_nodes").where("id % 3 = 0").select("id"), "id", "left_semi")
    inside = geo.in_range(F.col("lon"), L(r["min_lon"]), L(r["max_lon"])) & F.col("lat").between(r["min_lat"], r["max_lat"])
    return rows.where(inside).select("id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))
