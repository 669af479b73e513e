"""Registered queries: each applies operators to whole tables or derived views; `oracles` holds the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import delta, quality, raster, regional, spatial, tags, ways
from . import public
from .fixtures import frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NEAR = 100_000.0


def query(f):
    QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: frame(spark, sf_dir, name))
    return f


def nodes(t) -> DataFrame:
    return spatial.project(t("fx_nodes"))


def way_coords(t) -> DataFrame:
    """Node coordinates without every tenth node, so that some references are missing."""
    return nodes(t).where("id % 10 <> 0").select("id", "x", "y", "lon", "lat")


def closed_refs(t) -> DataFrame:
    """Way references; the first one again at the end of every third way that has three at least."""
    refs = t("fx_way_refs")
    size = refs.groupBy("way_id").agg(F.max("pos").alias("last"))
    again = refs.where("pos = 1 and way_id % 3 = 0").join(size.where("last >= 3"), "way_id").select("way_id", (F.col("last") + 1).alias("pos"), "node_id")
    return refs.select("way_id", "pos", "node_id").unionByName(again)


def tagged(t, view: str) -> DataFrame:
    return tags.gather(t(view).select("id", "k", F.col("v").cast("string").alias("v")))


# points, distances, areas


@query
def mercator_points(t):
    return nodes(t).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query
def valid_lonlat_filter(t):
    far = t("fx_nodes").select("id", (F.col("lon") * 1.02).alias("lon"), (F.col("lat") * 1.1).alias("lat"))
    return far.where(geo.valid_lonlat(F.col("lon"), F.col("lat"))).select("id")


@query
def nearest_airport(t):
    near = public.nearest_airport(nodes(t), t("fx_airports"))
    return near.select("point_id", "ident", "type", "elevation_ft", F.round("dist_km", 3).alias("dist_km"))


@query
def nearest_airports_3(t):
    near = spatial.nearest(nodes(t), spatial.project(t("fx_airports")), ["ident"], 100_000.0, public.WORLD, k=3)
    return near.select("point_id", "rank", "ident", F.round("dist", 3).alias("dist_m"))


@query
def obstacles_nearby(t):
    near = public.obstacles_nearby(nodes(t), t("fx_obstacles"), NEAR)
    return near.select("point_id", "id", "obstacle_type", "agl_ht", F.round("dist_m", 3).alias("dist_m"))


@query
def obstacle_radius_stats(t):
    return quality.radius_stats(public.obstacles_nearby(nodes(t), t("fx_obstacles"), 2 * NEAR))


@query
def routes_nearby(t):
    lines = spatial.project(t("fx_route_points")).groupBy(F.col("route_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("v"))
    lines = lines.select("id", F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))
    near = public.military_routes_nearby(nodes(t), lines, 2 * NEAR)
    return near.select("point_id", "id", F.round("dist_m", 3).alias("dist_m"))


def airspace(t) -> DataFrame:
    box = [geo.mercator_x(F.col("min_lon")), geo.mercator_y(F.greatest(F.lit(-85.0), F.col("min_lat"))), geo.mercator_x(F.col("max_lon")), geo.mercator_y(F.least(F.lit(85.0), F.col("max_lat")))]
    return t("fx_airspace").withColumn("rings", F.array(geo.box_ring(*box)))


@query
def airspace_at_point(t):
    a = airspace(t)
    layers = {
        "international": a.where("id % 2 = 0").withColumn("type", F.lit("7")).withColumn("lower_val", F.col("id") * 100.0),
        "class": a.where("id % 2 = 1").withColumn("class", F.lit("C")).withColumn("type_code", F.lit("CLASS_C")).withColumn("lower_val", F.lit(None).cast("double")),
    }
    return public.airspace_at_point(nodes(t), layers).select("point_id", "source", "class", "type", "name", "lower_val")


@query
def icao_class_decode(t):
    return t("fx_airspace").select("id", geo.icao_class(F.col("icao_class")).alias("class"))


@query
def great_circle_km(t):
    a = t("fx_airports")
    b = a.select((F.col("id") - 1).alias("id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return a.join(b, "id").select("id", F.round(geo.great_circle(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")) / 1000, 3).alias("km"))


# tags


@query
def tag_survival(t):
    return tagged(t, "fx_node_tags").select("id", tags.survives(F.col("tags"), node=True).alias("survives"))


@query
def tag_rows(t):
    return tags.tag_rows(tagged(t, "fx_node_tags"), node=True)


@query
def node_clutter_filter(t):
    rows = t("fx_node_tags")
    return rows.where(tags.sign_or_barrier(F.col("k"), F.col("v")) | tags.plant_or_rock(F.col("k"), F.col("v"))).select("id", "k", "v")


@query
def is_area_classify(t):
    return tagged(t, "fx_way_tags").select("id", tags.is_area(F.col("id") % 3 == 0, F.col("tags")).alias("area"))


@query
def road_promotion(t):
    return tagged(t, "fx_way_tags").where(tags.is_road(F.col("tags"))).select("id")


@query
def multipolygon_flag(t):
    return tagged(t, "fx_way_tags").where(tags.is_multipolygon(F.col("tags"))).select("id")


@query
def tag_text_clean(t):
    long = F.concat(F.lit(" \t"), F.repeat(F.col("k"), 60), F.lit("\n"))
    return t("fx_node_tags").select("id", "k", tags.clean(text.trim(long)).alias("cleaned"), F.length(tags.clean(text.trim(long))).alias("n"))


# ways and relations


@query
def way_vertices(t):
    return ways.vertices(t("fx_way_refs"), way_coords(t)).select("way_id", "pos", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query
def way_closed_flag(t):
    return ways.assemble(closed_refs(t), way_coords(t)).select("way_id", F.size("points").alias("n"), "closed")


@query
def relation_members(t):
    made = ways.assemble(t("fx_way_refs"), way_coords(t)).select(F.col("way_id").alias("id"), "points")
    parts = ways.relation_parts(t("fx_rel_members"), made)
    return parts.select("rel_id", "pos", "way_id", "role", F.size("points").alias("n"))


@query
def relation_lines(t):
    made = ways.assemble(closed_refs(t), way_coords(t)).select(F.col("way_id").alias("id"), "points")
    lines = ways.collected_lines(ways.relation_parts(t("fx_rel_members"), made))
    return lines.select("rel_id", F.size("lines").alias("n_lines"), F.size(F.flatten("lines")).alias("n_points"), F.round(F.element_at(F.element_at("lines", 1), 1)["x"], 3).alias("first_x"))


@query
def multipolygon_rings(t):
    """Assembled from synthetic squares cut in two: whole relations, not SQL, so its oracle is a brute-force test."""
    made = ways.assemble(closed_refs(t), way_coords(t)).select(F.col("way_id").alias("id"), "points")
    shapes = ways.multipolygons(ways.relation_parts(t("fx_rel_members"), made))
    return shapes.select("rel_id", F.size("polygons").alias("n_polygons"), F.aggregate("polygons", F.lit(0), lambda a, p: a + F.size(p)).alias("n_rings"))


@query
def union_ways_areas(t):
    made = ways.assemble(closed_refs(t), way_coords(t)).select(F.col("way_id").alias("id"), "points", "closed")
    both = ways.ways_and_areas(made.where("not closed or id % 2 = 0").drop("closed"), made.where("closed").withColumn("points", F.slice("points", 1, 3)).drop("closed"))
    return both.select("id", F.size("points").alias("n"))


# regions


def regions(t) -> DataFrame:
    return t("fx_regions")


def node_masks(t) -> DataFrame:
    return spatial.region_mask(t("fx_nodes"), regions(t))


@query
def region_mask(t):
    return node_masks(t)


@query
def region_row_counts(t):
    return spatial.expand_mask(node_masks(t), regions(t)).groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query
def child_tags_by_region(t):
    return regional.inherit(t("fx_node_tags"), node_masks(t)).select("id", "k", "v", "mask")


def located_refs(t) -> DataFrame:
    return t("fx_way_refs").join(way_coords(t).withColumnRenamed("id", "node_id"), "node_id").select("way_id", "pos", "node_id", "lon", "lat", "x", "y")


@query
def way_region_mask(t):
    return regional.classify_ways(located_refs(t), regions(t))


@query
def extra_vertices(t):
    return regional.outside_vertices(located_refs(t), regions(t))


@query
def coord_exact_join(t):
    extra = regional.outside_vertices(located_refs(t), regions(t)).join(way_coords(t).withColumnRenamed("id", "node_id"), "node_id").select("x", "y", "mask")
    return spatial.exact_matches(nodes(t), extra)


@query
def manifest_counts(t):
    masks = node_masks(t)
    return regional.manifest({"nodes": masks, "node_tags": regional.inherit(t("fx_node_tags"), masks)}, regions(t))


@query
def installed_bbox(t):
    return regional.bounding_box(regions(t))


# stores, upserts, feeds


@query
def node_store_merge(t):
    n = nodes(t)
    first = n.where("id % 3 <> 0").select("id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    second = n.where("id % 2 = 0").select("id", (F.col("lon") + 1).alias("x"), F.col("lat").alias("y"))
    return delta.merge_stores(first, second)


@query
def store_resolve_tiers(t):
    n = t("fx_nodes")
    tier = lambda cond, by: n.where(cond).select("id", (F.col("lon") + by).alias("x"), F.col("lat").alias("y"))
    return delta.resolve(t("fx_way_refs"), tier("id % 7 = 0", 2), tier("id % 5 = 0", 1), tier("id % 10 <> 3", 0)).select("way_id", "pos", "node_id", "x")


@query
def store_update(t):
    n = t("fx_nodes").select("id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    moved = n.where("id % 11 = 0").select((F.col("id") * 100_000_000).alias("id"), (F.col("x") + 1).alias("x"), "y").unionByName(n.where("id % 13 = 0").withColumn("x", F.col("x") + 5))
    return delta.store_update(n, moved, n.where("id % 17 = 0"))


@query
def highest_populated_id(t):
    return delta.id_range(way_coords(t))


@query
def id_window(t):
    return delta.id_window(t("fx_nodes").select("id", "lon"), 100, 899)


@query
def insert_if_absent(t):
    n = t("fx_nodes").select("id", "lon")
    return delta.insert_absent(n.where("id % 3 = 0"), n.where("id % 2 = 0"))


@query
def child_semi_insert(t):
    n = t("fx_nodes").select("id", "lon")
    new = delta.insert_absent(n.where("id % 3 = 0"), n.where("id % 2 = 0"))
    return delta.children_of(t("fx_node_tags"), new, "id").select("id", "k", "v")


@query
def orphan_tags(t):
    return delta.orphans(t("fx_node_tags"), t("fx_nodes").where("id % 10 <> 0"), "id").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query
def changes_collapse(t):
    return delta.last_changes(t("fx_changes")).select("id", "seq", "ord", "op", "value")


@query
def upsert_result(t):
    base = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"))
    return delta.upsert(base, delta.last_changes(t("fx_changes")).select("id", "op", "value"))


@query
def tag_diff_ops(t):
    old = t("fx_node_tags").where("id % 4 <> 0").select("id", "k", "v")
    new = t("fx_node_tags").where("id % 6 <> 0").select("id", "k", F.when(F.col("id") % 5 == 0, F.concat("v", F.lit("!"))).otherwise(F.col("v")).alias("v"))
    return delta.tag_changes(old, new)


@query
def delete_cascade(t):
    gone = delta.last_changes(t("fx_changes")).where("op = 'delete'")
    return delta.delete_cascade(t("fx_nodes"), t("fx_node_tags"), gone)[1].groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query
def change_counts(t):
    return delta.change_counts(t("fx_changes"))


@query
def airport_fk_joins(t):
    airports = t("fx_airports").select(F.col("id").alias("airport_ref"), "ident")
    runways = t("lineitem").select((F.col("l_suppkey") + F.col("l_linenumber") * 20).alias("airport_ref"), F.col("l_quantity").alias("length"))
    return delta.children_of(runways, airports, "airport_ref", "airport_ref").groupBy("airport_ref").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"))


# formats and numbers


@query
def csv_numeric_coercion(t):
    raw = F.concat(F.element_at(F.array(F.lit(" "), F.lit("-"), F.lit(""), F.lit("x")), (F.col("p_partkey") % 4 + 1).cast("int")), F.col("p_size").cast("string"), F.element_at(F.array(F.lit("abc"), F.lit(".25"), F.lit("")), (F.col("p_partkey") % 3 + 1).cast("int")))
    return t("part").select("p_partkey", text.parse_int(raw).alias("i"), text.parse_double(raw).alias("d"), text.parse_bool(F.when(F.col("p_size") == 1, "yes").otherwise("no")).alias("b"))


@query
def json_limit_extract(t):
    doc = F.concat(F.lit('{"lowerLimit":'), F.regexp_replace("props", r"\{.k.: *(\d+)\}", r'{"value":"$1","unit":$1}'), F.lit("}"))
    return t("events").select("event_id", text.json_limit(doc, "lowerLimit")["value"].alias("value"), text.json_limit(doc, "lowerLimit")["unit"].alias("unit"), text.json_limit(doc, "upperLimit")["unit"].alias("upper"))


@query
def accuracy_split(t):
    code = F.when(F.col("p_size") % 5 == 0, "").when(F.col("p_size") % 5 == 1, F.substring("p_brand", 1, 1)).otherwise(F.substring("p_brand", 1, 2))
    h, v = text.accuracy(code)
    return t("part").select("p_partkey", h.alias("horizontal"), v.alias("vertical"), (F.substring("p_type", 1, 1) == "O").alias("verified"))


@query
def seq_to_path(t):
    seq = F.col("p_partkey") * 12347
    return t("part").select("p_partkey", text.sequence_path(seq).alias("path"))


@query
def sequence_estimate(t):
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    tip = F.lit(6_500_000).cast("long")
    return t("orders").select("o_orderkey", text.estimated_sequence(tip, F.lit(1_000_000_000).cast("long"), at).alias("seq"))


@query
def tile_names(t):
    lon, lat = F.floor("lon").cast("int"), F.floor("lat").cast("int")
    return t("fx_nodes").select("id", geo.tile_name(lat, lon, "copernicus").alias("dem"), geo.tile_name(F.floor(lat / 10).cast("int") * 10, F.floor(lon / 10).cast("int") * 10, "cell").alias("cell"))


@query
def tiles_missing(t):
    wanted = raster.box_tiles(regions(t).select("name", "min_lon", "min_lat", "max_lon", "max_lat"))
    loaded = t("fx_nodes").select(geo.tile_name(F.floor("lat").cast("int"), F.floor("lon").cast("int"), "copernicus").alias("tile"))
    return raster.absent(wanted.withColumn("tile", geo.tile_name(F.col("lat"), F.col("lon"), "copernicus")), loaded).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


# rasters


def height_tiles(t) -> DataFrame:
    """Forty by forty cells of a quarter degree a tile; heights are a rule of tile and cell, every seventh is missing."""
    cells = F.transform(F.sequence(F.lit(0), F.lit(1599)), lambda i: F.when((i + F.col("n_nationkey")) % 7 != 0, (i * 31 + F.col("n_nationkey") * 17) % 2000 + 0.5))
    x0, y0 = (F.col("n_nationkey") * 1439 % 340 - 170).cast("double"), (F.col("n_nationkey") * 37 % 140 - 60).cast("double")
    q = F.lit(0.25)
    return t("nation").select(F.col("n_nationkey").alias("tile_id"), x0.alias("x0"), y0.alias("y0"), q.alias("dx"), q.alias("dy"), F.lit(40).alias("w"), F.lit(40).alias("h"), cells.alias("cells"))


@query
def raster_point_value(t):
    return spatial.raster_values(t("fx_nodes"), height_tiles(t), 10.0).select("point_id", F.round(geo.elevation_ft(F.col("value")), 3).alias("elevation_ft"))


@query
def raster_summary(t):
    return raster.summary(height_tiles(t))


@query
def declination_band_id(t):
    v = F.col("value") / 10
    return t("fx_changes").select("seq", "ord", geo.band_id(v, geo.band_floor(F.lit(-3.3), 0.25), 0.25).alias("band"))


@query
def band_cells(t):
    return raster.band_counts(height_tiles(t), 100.0, 10.0)


@query
def elevation_profile_steps(t):
    far = F.col("p_size") * 37
    return t("part").select("p_partkey", F.explode(public.profile_steps(far, 500)).alias("distance_m")).withColumn("distance_m", F.col("distance_m").cast("int"))


@query
def elevation_profile(t):
    origins = t("fx_airports").select("id", "lon", "lat", (F.col("id") * 7 % 360).cast("double").alias("bearing_deg"), F.lit(40.0).alias("distance_km"))
    rows = public.elevation_along_bearing_ft(origins, height_tiles(t), 10.0, 1000.0)
    return rows.select("origin_id", "distance_m", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round("elevation_ft", 3).alias("elevation_ft"))


# The first-degree terms of the 2025 main field, enough for a dipole.
DIPOLE = [(1, 0, -29351.8, 0.0, 0.0, 0.0), (1, 1, -1410.8, 4545.4, 0.0, 0.0)]


@query
def declination_dipole(t):
    from ..functions import magnetic

    return t("fx_airports").select("id", F.round(magnetic.column(F.col("lon"), F.col("lat"), 0.0, DIPOLE), 4).alias("declination"))


# quality


@query
def angle_diff_stats(t):
    return quality.angle_stats(t("fx_changes").select((F.col("value") * 3).alias("a"), (F.col("id") * 1.0).alias("b")), "a", "b")


@query
def rough_region_counts(t):
    return quality.region_counts(t("fx_nodes"))


@query
def names_top3(t):
    pairs = public.obstacles_nearby(nodes(t), t("fx_obstacles"), 5 * NEAR).select("point_id", F.col("obstacle_type").alias("name"))
    return quality.top_names(pairs)


@query
def row_count_bounds(t):
    return quality.count_bounds({n: t(n) for n in ("orders", "customer", "fx_node_tags")}, {"orders": (1, 10**9), "customer": (10**7, 10**9), "fx_node_tags": (100, 10**7)})


@query
def staleness_flags(t):
    state = t("events").groupBy(F.col("event_type").alias("name")).agg(F.max(F.col("ts").cast("timestamp")).alias("checked_at"))
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    return quality.staleness(state, now, {"click": 24.0, "error": 1e6}).select("name", F.round("hours", 3).alias("hours"), "stale")


@query
def refresh_due(t):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    state = t("events").where("event_type <> 'view'").groupBy(F.col("event_type").alias("name")).agg(F.min(at).alias("value"))
    remote = t("events").groupBy(F.col("event_type").alias("name")).agg(F.max(at).alias("modified"))
    return quality.refresh_due(state, remote, F.lit("2024-06-01 00:00:00").cast("timestamp"), 300, {"signup": 90, "error": 100000})


@query
def report_row_sample(t):
    rows = t("part").select(F.col("p_partkey").alias("idx"), F.when(F.col("p_partkey") % 50 == 0, "airport").otherwise("random").alias("kind"), F.when(F.col("p_size") > 48, 3).when(F.col("p_size") > 45, 1).otherwise(0).alias("flags"))
    return quality.report_rows(rows, 500)


@query
def golden_facts(t):
    facts = t("nation").select(F.col("n_name").alias("key"), (F.col("n_nationkey") * 10.0).alias("expected"), F.lit(40.0).alias("tolerance"), F.lit(None).cast("string").alias("ident"))
    measured = t("supplier").groupBy("s_nationkey").agg(F.sum("s_nationkey").alias("value")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("key"), "value", F.lit(None).cast("string").alias("ident"))
    return quality.golden(facts, measured)


@query
def timing_by_category(t):
    return quality.timing(t("events"), "event_type", "value")


@query
def model_difference(t):
    return quality.model_difference(t("supplier").select("s_acctbal", (F.col("s_suppkey") * 10).alias("other")), "s_acctbal", "other", 500)


# sinks and samples


@query
def quarantine_rows(t):
    from ..operators import sinks

    far = t("fx_nodes").select("id", (F.col("lon") * 1.02).alias("lon"), (F.col("lat") * 1.1).alias("lat"))
    checks = {"longitude": F.col("lon").between(-180.0, 180.0), "latitude": F.col("lat").between(-90.0, 90.0), "id": F.col("id") % 97 != 0}
    return sinks.split_valid(far, checks)[1].select("id", "reason")


@query
def region_sample_check(t):
    """Of the nodes that a region's slice would hold, how many lie in it: the whole slice, not a sample, for the oracle."""
    slices = spatial.expand_mask(t("fx_nodes").join(node_masks(t), "id"), regions(t))
    boxes = regions(t).select(F.col("name").alias("region"), "min_lon", "max_lon", "min_lat", "max_lat")
    inside = geo.in_range(F.col("lon"), F.col("min_lon"), F.col("max_lon")) & F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
    return slices.join(F.broadcast(boxes), "region").groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.count_if(~inside).alias("outside"))


@query
def nodes_near_airports(t):
    """Ways and areas near a point, for nodes: the first five per airport within the radius, by distance and id."""
    from pyspark.sql import Window

    near = spatial.within_distance(spatial.project(t("fx_airports")), nodes(t), 5 * NEAR, ["id"])
    order = Window.partitionBy("point_id").orderBy("dist", "id")
    return near.withColumn("rank", F.row_number().over(order)).where("rank <= 5").select("point_id", "rank", "id", F.round("dist", 3).alias("dist_m"))


@query
def loaded_cells(t):
    """Cells of the declination grid per region that aren't computed yet, ten degrees a side."""
    wanted = raster.box_tiles(regions(t).select("name", "min_lon", "min_lat", "max_lon", "max_lat"), 10)
    wanted = wanted.withColumn("tile", geo.tile_name(F.col("lat"), F.col("lon"), "cell"))
    done = t("nation").select(geo.tile_name((F.col("n_nationkey") % 12 * 10 - 60).cast("int"), (F.col("n_nationkey") * 10 - 120).cast("int"), "cell").alias("tile"))
    return raster.absent(wanted, done).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


from . import file_queries  # noqa: E402  they use what is above
from .oracles import ORACLES  # noqa: E402

QUERIES.update(file_queries.QUERIES)
ORACLES.update(file_queries.ORACLES)
