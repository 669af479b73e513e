"""Lines, areas and relations from ordered references, with order carried in an explicit column."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import small_batches


def vertices(refs: DataFrame, coords: DataFrame) -> DataFrame:
    """(way_id, pos, node_id, x, y): references (way_id, pos, node_id) with coordinates (id, x, y); missing ones drop out."""
    return refs.join(coords.select(F.col("id").alias("node_id"), "x", "y"), "node_id").select("way_id", "pos", "node_id", "x", "y")


def assemble(refs: DataFrame, coords: DataFrame) -> DataFrame:
    """(way_id, points, closed): points in the order of pos; fewer than two points make no geometry and no row."""
    rows = vertices(refs, coords).groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("v"))
    points = rows.select("way_id", F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points")).where(F.size("points") >= 2)
    return points.withColumn("closed", geo.is_closed(F.col("points")))


def ways_and_areas(ways: DataFrame, areas: DataFrame) -> DataFrame:
    """Both as one (id, points), ways first: an id that both hold is taken from the ways."""
    both = ways.select("id", "points", F.lit(0).alias("src")).unionByName(areas.select("id", "points", F.lit(1).alias("src")))
    return both.groupBy("id").agg(F.min_by("points", "src").alias("points"))


def relation_parts(members: DataFrame, ways: DataFrame) -> DataFrame:
    """(rel_id, pos, role, way_id, points) of the members (rel_id, pos, way_id, role) whose way is known."""
    return members.join(ways.select(F.col("id").alias("way_id"), "points"), "way_id").select("rel_id", "pos", "role", "way_id", "points")


def collected_lines(parts: DataFrame) -> DataFrame:
    """(rel_id, lines): the open member lines in member order; closed ones were stored as polygons and are left out."""
    rows = parts.where(~geo.is_closed(F.col("points"))).groupBy("rel_id").agg(F.array_sort(F.collect_list(F.struct("pos", "points"))).alias("m"))
    return rows.select("rel_id", F.transform("m", lambda p: p["points"]).alias("lines"))


def stitch(segments: list[list[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Closed rings of segments: a ring grows at its end by the earliest unused segment that starts or ends there, is closed by
    force if nothing fits, and counts with four points or more. Ends are looked up in an index by place."""
    ends = defaultdict(list)
    for k, s in enumerate(segments):
        if s:
            for place in {s[0], s[-1]}:
                ends[place].append(k)
    unused, rings = dict.fromkeys(range(len(segments))), []
    for first in range(len(segments)):
        if first not in unused:
            continue
        del unused[first]
        ring = list(segments[first])
        while ring and not (len(ring) >= 4 and ring[0] == ring[-1]):
            k = next((k for k in ends.get(ring[-1], ()) if k in unused), None)
            if k is None:
                break
            del unused[k]
            s = segments[k]
            ring += s[1:] if s[0] == ring[-1] else s[-2::-1]
        if ring and ring[0] != ring[-1]:
            ring.append(ring[0])
        if len(ring) >= 4:
            rings.append(ring)
    return rings


def polygons(outer: list, inner: list) -> list[list]:
    """Rings per polygon: with one outer ring all inner ones are its holes; with several, an inner ring goes to every outer ring
    whose bounding box holds its first point."""
    if len(outer) == 1:
        return [[outer[0], *inner]]
    out = []
    for ring in outer:
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        out.append([ring, *(h for h in inner if min(xs) <= h[0][0] <= max(xs) and min(ys) <= h[0][1] <= max(ys))])
    return out


def multipolygons(parts: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(rel_id, polygons: array<array<array<struct<x, y>>>>): members with role inner are holes, all others outer; no outer ring, no row.

    Members are gathered and ordered in the JVM, one row a relation, which the map format bounds; Python gets batches of
    relations and folds each one. Of r rings a relation can give r^2 / 4 holes, as a hole goes to every outer ring around it: they come
    as flat coordinates, a relation at a time. Columns of `of` (rel_id, ...) are joined with the members, which are less than the polygons.
    """
    import numpy as np
    import pyarrow as pa

    ordered = F.array_sort(F.collect_list(F.struct("pos", (F.col("role") == "inner").alias("hole"), F.transform("points", lambda p: p["x"]).alias("xs"), F.transform("points", lambda p: p["y"]).alias("ys"))))
    rows = parts.groupBy("rel_id").agg(ordered.alias("m")).select("rel_id", *(F.col(f"m.{k}").alias(f"__{k}") for k in ("hole", "xs", "ys")))
    rows = rows if of is None else of.join(rows, "rel_id")
    kept = [c for c in rows.columns if not c.startswith("__")]
    place = pa.struct([("x", pa.float64()), ("y", pa.float64())])

    def nested(shape):
        """One value of the column polygons."""
        rings = list({id(r): r for poly in shape for r in poly}.values())
        number, sizes = {id(r): k for k, r in enumerate(rings)}, np.array([len(r) for r in rings])
        starts, flat = np.cumsum(sizes) - sizes, np.array([p for r in rings for p in r], np.float64)
        order = np.array([number[id(r)] for poly in shape for r in poly])
        ends = np.cumsum(sizes[order])
        at = np.arange(ends[-1]) + np.repeat(starts[order] - ends + sizes[order], sizes[order])
        offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        points = pa.StructArray.from_arrays([pa.array(flat[at, k]) for k in (0, 1)], fields=list(place))
        return pa.ListArray.from_arrays(pa.array([0, len(shape)], pa.int32()), pa.ListArray.from_arrays(offsets([len(p) for p in shape]), pa.ListArray.from_arrays(offsets(sizes[order]), points)))

    def build(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                holes, xs, ys = (one.column(f"__{c}")[0].as_py() for c in ("hole", "xs", "ys"))
                segments = [list(zip(x, y)) for x, y in zip(xs, ys)]
                outer, inner = (stitch([s for s, h in zip(segments, holes) if bool(h) == side]) for side in (False, True))
                if outer:
                    yield pa.RecordBatch.from_arrays([*(one.column(c) for c in kept), nested(polygons(outer, inner))], names=[*kept, "polygons"])

    small_batches(parts.sparkSession)
    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(build, f"{types}, polygons array<array<array<struct<x: double, y: double>>>>")
