"""Geographic views derived from the benchmark tables, as one SQL text for both engines."""

from __future__ import annotations

import base64
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..session import small_batches

VIEWS = {
    "fx_nodes": """select p_partkey as id, p_name as name,
        cast((p_partkey*7919)%36000 as double)/100-180 as lon,
        cast((p_partkey*104729)%17000 as double)/100-85 as lat from {part}""",
    "fx_obstacles": """select c_custkey as id, c_mktsegment as obstacle_type, cast(c_custkey%2000 as int) as agl_ht,
        cast(c_custkey%3000 as int) as amsl_ht,
        cast((c_custkey*15485863)%36000 as double)/100-180 as lon,
        cast((c_custkey*32452843)%17000 as double)/100-85 as lat from {customer}""",
    "fx_airports": """select s_suppkey as id, s_name as ident,
        case s_suppkey%3 when 0 then 'small_airport' when 1 then 'medium_airport' else 'heliport' end as type,
        cast(s_suppkey%900 as int) as elevation_ft,
        cast((s_suppkey*7919)%36000 as double)/100-180 as lon,
        cast((s_suppkey*15485863)%17000 as double)/100-85 as lat from {supplier}""",
    "fx_airspace": """select n_nationkey as id, n_name as name, n_nationkey%8 as icao_class,
        cast((n_nationkey*1439)%360-180 as double)-(5+n_nationkey%7) as min_lon,
        cast((n_nationkey*1439)%360-180 as double)+(5+n_nationkey%7) as max_lon,
        cast((n_nationkey*37)%160-80 as double)-(4+n_nationkey%5) as min_lat,
        cast((n_nationkey*37)%160-80 as double)+(4+n_nationkey%5) as max_lat from {nation}""",
    "fx_regions": """select r_regionkey as bit, r_name as name,
        cast(case when r_regionkey=4 then 150 else -180+80*r_regionkey end as double) as min_lon,
        cast(case when r_regionkey=4 then -160 else -85+80*r_regionkey end as double) as max_lon,
        cast(-60 as double) as min_lat, cast(75 as double) as max_lat from {region}""",
    "fx_way_refs": """select l_orderkey as way_id,
        row_number() over (partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey) as pos,
        l_partkey as node_id from {lineitem}""",
    "fx_rel_members": """select o_custkey as rel_id, row_number() over (partition by o_custkey order by o_orderkey) as pos,
        o_orderkey as way_id, case o_orderstatus when 'F' then 'inner' when 'O' then 'outer' else '' end as role from {orders}""",
    "fx_node_tags": """select p_partkey as id,'name' as k,p_name as v from {part} where p_partkey%5=0
        union all select p_partkey,'building',case when p_size%4=0 then 'hangar' else 'yes' end from {part} where p_partkey%3=0
        union all select p_partkey,'addr:street',p_brand from {part} where p_partkey%2=0
        union all select p_partkey,'highway',case when p_size%3=0 then 'stop' else 'primary' end from {part} where p_partkey%7=0
        union all select p_partkey,'natural','tree' from {part} where p_partkey%11=0
        union all select p_partkey,'height',cast(p_size as varchar(12)) from {part} where p_partkey%22=0""",
    "fx_route_points": """select n_nationkey as route_id, p.pos as pos,
        cast((n_nationkey*1439)%340-170 as double)+1.5*p.pos as lon, cast((n_nationkey*37)%140-70 as double)+(p.pos*p.pos)%3 as lat
        from {nation} cross join (select 0 as pos union all select 1 union all select 2 union all select 3 union all select 4) p""",
    "fx_way_tags": """select o_orderkey as id,'name' as k,o_orderpriority as v from {orders} where o_orderkey%4=0
        union all select o_orderkey,'building','yes' from {orders} where o_orderkey%3=0
        union all select o_orderkey,'highway','primary' from {orders} where o_orderkey%5=0
        union all select o_orderkey,'area',case when o_orderkey%2=0 then 'yes' else 'no' end from {orders} where o_orderkey%7=0
        union all select o_orderkey,'barrier',case when o_orderkey%2=0 then 'wall' else 'bollard' end from {orders} where o_orderkey%11=0
        union all select o_orderkey,'route',case when o_orderkey%2=0 then 'road' else 'bus' end from {orders} where o_orderkey%13=0
        union all select o_orderkey,'type',case when o_orderkey%3=0 then 'multipolygon' when o_orderkey%3=1 then 'boundary' else 'route' end from {orders} where o_orderkey%6<3""",
    "fx_changes": """select cast(floor(event_id/100.0) as bigint) as seq, event_id%100 as ord, user_id as id,
        case event_type when 'signup' then 'create' when 'error' then 'delete' else 'modify' end as op, value from {events}""",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, or a benchmark table as it is."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("varchar(12)", "string")
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"{(\w+)}", text))})


def with_views(*names: str) -> str:
    """`with fx_… as (…)` for the oracle engine."""
    return "with " + ", ".join(f"{n} as ({re.sub(r'{(\w+)}', r'\1', VIEWS[n])})" for n in names)


def folder(spark: SparkSession) -> str:
    """A new folder for files that a query writes and reads back: in the shared checkpoint folder, or a local one where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="skylattice-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"


def write_file(spark: SparkSession, path: str, data: bytes) -> str:
    """A small file, through the file system that Spark uses."""
    return write_parts(spark, path, [data])


def write_parts(spark: SparkSession, path: str, parts: Iterable[bytes], least: int = 1 << 20) -> str:
    """A file of any size from its parts in order, through the file system that Spark uses; the driver holds `least` bytes and a part."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    put = lambda data: out.write(jvm.java.util.Base64.getDecoder().decode(base64.b64encode(data).decode()))
    held = bytearray()
    for part in parts:
        held += part
        if len(held) >= least:
            put(held)
            held = bytearray()
    put(held)
    out.close()
    return path


def write_lines(spark: SparkSession, path: str, rows: DataFrame, head: Iterable[str] = (), encoding: str = "utf-8") -> str:
    """A file of any size: the head, then the rows' only column as lines. Executors write the lines; the driver's JVM joins their files, a buffer at a time."""
    from pyspark.sql import functions as F

    staged = folder(spark)
    rows.toDF("value").select(F.encode(F.col("value"), encoding).cast("string").alias("value")).write.text(staged)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    write_file(spark, path + ".head", "".join(f"{x}\n" for x in head).encode(encoding))
    parts = sorted(x.getPath().toString() for x in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staged)) if x.getPath().getName().startswith("part-"))
    out = fs.create(where)
    for part in [path + ".head", *parts]:
        held = fs.open(jvm.org.apache.hadoop.fs.Path(part))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(held, out, 1 << 20, False)
        held.close()
    out.close()
    return path


def vi(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(k: int, v) -> bytes:
    return vi(k << 3) + vi(v) if isinstance(v, int) else vi(k << 3 | 2) + vi(len(v)) + v


def deltas(values) -> bytes:
    last, out = 0, []
    for v in values:
        d, last = v - last, v
        out.append(vi(d << 1 if d >= 0 else (-d << 1) - 1))
    return b"".join(out)


def extract_block(rows, dense: bool) -> bytes:
    """A block of (kind, id, tags, lon, lat, refs, members) rows; nodes are dense or plain."""
    strings: dict[str, int] = {"": 0}
    number = lambda x: strings.setdefault(x, len(strings))
    pairs = lambda tags: field(2, b"".join(vi(number(k)) for k, _ in tags)) + field(3, b"".join(vi(number(v)) for _, v in tags)) if tags else b""
    place = lambda v: round(v * 1e7)
    nodes, groups = [r for r in rows if r[0] == "node"], []
    if nodes and dense:
        kv = b"".join(b"".join(vi(number(k)) + vi(number(v)) for k, v in r[2] or ()) + vi(0) for r in nodes)
        groups.append(field(2, field(1, deltas(r[1] for r in nodes)) + field(8, deltas(place(r[4]) for r in nodes)) + field(9, deltas(place(r[3]) for r in nodes)) + field(10, kv)))
    zz = lambda v: v << 1 if v >= 0 else (-v << 1) - 1
    for kind, i, tags, lon, lat, refs, members in rows:
        if kind == "node" and not dense:
            groups.append(field(1, field(1, zz(i)) + pairs(tags) + field(8, zz(place(lat))) + field(9, zz(place(lon)))))
        elif kind == "way":
            groups.append(field(3, field(1, i) + pairs(tags) + field(8, deltas(refs))))
        elif kind == "relation":
            groups.append(field(4, field(1, i) + pairs(tags) + field(8, b"".join(vi(number(r)) for _, r, _ in members)) + field(9, deltas(m for m, _, _ in members)) + field(10, b"".join(vi(t) for _, _, t in members))))
    return field(1, b"".join(field(1, s.encode()) for s in strings)) + b"".join(field(2, g) for g in groups)


def extract_blob(kind: str, block: bytes, codec: str = "zlib") -> bytes:
    blob = field(1, block) if codec == "raw" else field(2, len(block)) + field(3, zlib.compress(block))
    head = field(1, kind.encode()) + field(3, len(blob))
    return len(head).to_bytes(4, "big") + head + blob


#: Ids of one kind that a block holds at most, and entities, tags, references and members together, but for what one entity has.
BLOCK, VALUES = 4000, 50_000


def write_extract(spark: SparkSession, path: str, entities: DataFrame, blocks: int = 6) -> dict[int, int]:
    """An extract of (kind, id, tags: array of pairs, lon, lat, refs, members: array of (id, role, type)) rows, in data blobs of mixed codecs.

    The ids of each remainder by `blocks` follow each other, BLOCK of a kind and VALUES in a blob. Returns where each remainder's first blob begins.
    Executors sort the rows and make a blob from those that come next, so that they hold no more than one; blobs are staged beside
    the extract's folder and pass the driver one after the other."""
    import pyarrow as pa

    def entity(kind, i, keys, values, lon, lat, refs, ids, roles, types):
        return kind, i, list(zip(keys or (), values or ())), lon, lat, refs, None if ids is None else list(zip(ids, roles, types))

    def encode(batches):
        at, held, size, seq = None, [], 0, 0

        def blob():
            data = extract_blob("OSMData", extract_block(held, at[0] % 3 != 0), "raw" if at[0] % 2 else "zlib")
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([seq], pa.int64()), pa.array([data], pa.binary())], names=["n", "part", "seq", "blob"])

        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                for n, part, *row in zip(*(c.to_pylist() for c in batch.slice(first, 500).columns)):
                    one = entity(*row)
                    values = 1 + sum(len(x or ()) for x in (one[2], one[5], one[6]))
                    if held and (at != (n, part) or size + values > VALUES):
                        yield blob()
                        seq = seq + 1 if at == (n, part) else 0
                        held, size = [], 0
                    at = n, part
                    held.append(one)
                    size += values
        if held:
            yield blob()

    small_batches(spark)
    keys = f"cast(pmod(id, {blocks}) as int) as n", f"cast(floor(id / {blocks * BLOCK}) as long) as part"
    lists = (f"transform({c}, x -> x.{k}) as {c}_{k}" for c, k in (("tags", "k"), ("tags", "v"), ("members", "id"), ("members", "role"), ("members", "type")))
    rows = entities.selectExpr(*keys, "kind", "id", *lists, "lon", "lat", "refs")
    rows = rows.select("n", "part", "kind", "id", "tags_k", "tags_v", "lon", "lat", "refs", "members_id", "members_role", "members_type")
    staged = folder(spark)
    rows.repartition("n", "part").sortWithinPartitions("n", "part", "kind", "id").mapInArrow(encode, "n int, part long, seq long, blob binary").write.parquet(staged)
    starts: dict[int, int] = {}

    def parts():
        at = extract_blob("OSMHeader", b"")
        yield at
        at = len(at)
        for r in spark.read.parquet(staged).orderBy("n", "part", "seq").toLocalIterator():  # a partition at a time
            starts.setdefault(r["n"], at)
            at += len(r["blob"])
            yield bytes(r["blob"])

    write_parts(spark, path, parts())
    return starts
