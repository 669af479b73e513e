"""Which tags and which tagged things are worth keeping, and what kind of geometry tags imply. Tags are map<string, string>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules' keys and values.
EXCLUDED_KEYS = ("source", "created_by", "attribution")
EXCLUDED_PREFIXES = ("addr:", "building:", "source:", "tiger:")
KEPT_BUILDINGS = ("hangar", "terminal", "control_tower")
SIGN_HIGHWAYS = ("stop", "give_way", "traffic_signals", "milestone", "crossing", "turning_circle", "turning_loop", "motorway_junction", "street_lamp", "bus_stop")
SMALL_BARRIERS = ("gate", "bollard", "kerb", "lift_gate", "block", "cycle_barrier", "swing_gate", "stile")
PLANTS_AND_ROCKS = ("tree", "shrub", "rock")
LINEAR_KEYS = ("highway", "railway", "waterway", "power", "man_made")
LINEAR_TAGS = {"junction": ("roundabout", "circular"), "barrier": ("fence", "wall", "hedge", "retaining_wall", "city_wall"), "aeroway": ("runway", "taxiway", "taxilane")}
AREA_KEYS = ("building", "building:part", "landuse", "leisure", "natural", "amenity", "shop", "tourism", "historic", "military", "boundary", "place", "sport", "landcover")
MAX_TAG = 256


def excluded(key: Column) -> Column:
    out = key.isin(*EXCLUDED_KEYS)
    for p in EXCLUDED_PREFIXES:
        out = out | key.startswith(p)
    return out


def sign_or_barrier(key: Column, value: Column) -> Column:
    return (key == "traffic_sign") | ((key == "highway") & value.isin(*SIGN_HIGHWAYS)) | ((key == "barrier") & value.isin(*SMALL_BARRIERS))


def plant_or_rock(key: Column, value: Column) -> Column:
    return (key == "natural") & value.isin(*PLANTS_AND_ROCKS)


def has_elevation(tags: Column) -> Column:
    filled = lambda k: F.coalesce(F.length(F.try_element_at(tags, F.lit(k))) > 0, F.lit(False))
    return filled("height") | filled("ele")


def clean(value: Column) -> Column:
    """Without NULs, at most 256 characters. Strings are valid UTF-8 by then (see functions.text for bytes)."""
    return F.substring(F.replace(value, F.lit("\u0000"), F.lit("")), 1, MAX_TAG)


def _node_keeps(tags: Column, key: Column, value: Column) -> Column:
    return ~sign_or_barrier(key, value) & (~plant_or_rock(key, value) | has_elevation(tags))


def survives(tags: Column, node: bool = False) -> Column:
    """Whether one tag at least is worth keeping; a building counts only if it matters to aviation."""

    def worth(e: Column) -> Column:
        k, v = e["key"], e["value"]
        keep = ~excluded(k) & ((k != "building") | v.isin(*KEPT_BUILDINGS)) & (F.length(clean(k)) > 0) & (F.length(clean(v)) > 0)
        return keep & _node_keeps(tags, k, v) if node else keep

    return F.coalesce(F.exists(F.map_entries(tags), worth), F.lit(False))


def name(tags: Column) -> Column:
    """The name tag, cut like any tag; null where there is none."""
    return clean(F.try_element_at(tags, F.lit("name")))


def tag_rows(entities: DataFrame, node: bool = False) -> DataFrame:
    """(id, key_name, key_value) of the tags that are stored once an entity survives; any building value is stored then."""
    rows = entities.where(survives(F.col("tags"), node)).select("id", "tags", F.explode("tags").alias("k", "v"))
    rows = rows.where(~excluded(F.col("k")))
    if node:
        rows = rows.where(_node_keeps(F.col("tags"), F.col("k"), F.col("v")))
    return rows.select("id", clean(F.col("k")).alias("key_name"), clean(F.col("v")).alias("key_value")).where("key_name <> '' and key_value <> ''")


def gather(rows: DataFrame) -> DataFrame:
    """(id, tags) from rows (id, k, v[, at]); of a repeated key the last value by `at` stays, or, where rows have no order, the greatest,
    so that the result doesn't depend on how they lie."""
    last = F.max_by("v", "at") if "at" in rows.columns else F.max("v")
    return rows.groupBy("id", "k").agg(last.alias("v")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("tags"))


def is_area(closed: Column, tags: Column) -> Column:
    """A closed way is an area by area=yes, unless area=no, a linear tag, or no area key."""
    get = lambda k: F.try_element_at(tags, F.lit(k))
    has = lambda ks: F.exists(F.map_keys(tags), lambda k: k.isin(*ks))
    linear = has(LINEAR_KEYS)
    for k, vs in LINEAR_TAGS.items():
        linear = linear | F.coalesce(get(k).isin(*vs), F.lit(False))
    return F.coalesce(F.when(~closed, False).when(get("area") == "yes", True).when(get("area") == "no", False).when(linear, False).otherwise(has(AREA_KEYS)), F.lit(False))


def is_multipolygon(tags: Column) -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit("type")).isin("multipolygon", "boundary"), F.lit(False))


def is_road(tags: Column) -> Column:
    return F.coalesce((F.try_element_at(tags, F.lit("route")) == "road") | F.array_contains(F.map_keys(tags), "highway"), F.array_contains(F.map_keys(tags), "highway"), F.lit(False))
