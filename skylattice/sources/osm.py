"""Map extracts (blocked binary) and change files (XML, plain or gzip) as DataFrames.

Change files are small and come whole. Extracts are read by byte ranges: the bytes that begin every data blob's header are the record
separator of Spark's line reader, which splits a file of any size over tasks and finds the next record in each range, in any
file system; a record is a blob. Messages are read with a small wire-format reader; blocks with a codec other than raw and zlib
give no rows.
"""

from __future__ import annotations

import zlib
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_batches

ENTITY = "kind string, id long, tags map<string, string>, lon double, lat double, refs array<long>, members array<struct<id: long, role: string>>"
CHANGE = "ord long, op string, " + ENTITY


def varint(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 0x7F) << shift
        if b < 0x80:
            return value, at
        shift += 7


def fields(data: bytes):
    """(number, value) of a message: integers, or bytes of length-delimited and fixed fields."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = varint(data, at)
        elif wire == 2:
            n, at = varint(data, at)
            value, at = data[at : at + n], at + n
        elif wire in (1, 5):
            n = 8 if wire == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError("wire type")
        yield key >> 3, value


def packed(data) -> list[int]:
    if isinstance(data, int):
        return [data]
    out, at = [], 0
    while at < len(data):
        v, at = varint(data, at)
        out.append(v)
    return out


def zigzag(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def running(values) -> list[int]:
    total, out = 0, []
    for v in values:
        total += zigzag(v)
        out.append(total)
    return out


def blobs(data: bytes, start: int = 0):
    """(offset, type, blob bytes) of an extract from a blob boundary on."""
    at = start
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        head = dict(fields(data[at + 4 : at + 4 + n]))
        size = head[3]
        yield at, bytes(head[1]).decode(), data[at + 4 + n : at + 4 + n + size]
        at += 4 + n + size


def unpack(blob: bytes) -> bytes | None:
    """The content of a blob; None for codecs other than raw and zlib."""
    f = dict(fields(blob))
    return bytes(f[1]) if 1 in f else zlib.decompress(f[3]) if 3 in f else None


def block_entities(block: bytes) -> list[tuple]:
    """Rows of ENTITY of one primitive block; of members only ways are kept."""
    strings, groups, granularity, lat0, lon0 = [], [], 100, 0, 0
    for k, v in fields(block):
        if k == 1:
            strings = [bytes(s).decode("utf-8", "replace") for n, s in fields(v) if n == 1]
        elif k == 2:
            groups.append(v)
        elif k == 17:
            granularity = v
        elif k == 19:
            lat0 = signed(v)
        elif k == 20:
            lon0 = signed(v)
    place = lambda v, zero: 1e-9 * (zero + granularity * v)
    out = []
    for group in groups:
        for k, item in fields(group):
            f: dict = {}
            for n, v in fields(item) if k in (1, 2, 3, 4) else ():
                f.setdefault(n, []).append(v)
            many = lambda n: [x for v in f.get(n, []) for x in packed(v)]
            pairs = lambda: {strings[a]: strings[b] for a, b in zip(many(2), many(3))}
            if k == 2:
                ids, lats, lons, at, kv = running(many(1)), running(many(8)), running(many(9)), 0, many(10)
                for i, la, lo in zip(ids, lats, lons):
                    tags = {}
                    while at < len(kv) and kv[at]:
                        tags[strings[kv[at]]] = strings[kv[at + 1]]
                        at += 2
                    at += 1
                    out.append(("node", i, tags, place(lo, lon0), place(la, lat0), None, None))
            elif k == 1:
                out.append(("node", zigzag(f[1][0]), pairs(), place(zigzag(f[9][0]), lon0), place(zigzag(f[8][0]), lat0), None, None))
            elif k == 3:
                out.append(("way", signed(f[1][0]), pairs(), None, None, running(many(8)), None))
            elif k == 4:
                kinds = many(10)
                members = [{"id": i, "role": strings[r]} for i, r, t in zip(running(many(9)), many(8), kinds) if t == 1]
                out.append(("relation", signed(f[1][0]), pairs(), None, None, None, members))
    return out


#: How the header of every data blob begins: field 1, seven bytes, its type.
DATA_HEAD = "\n\u0007OSMData"


def data_blob(record: bytes) -> bytes | None:
    """The blob of a record, which is what follows DATA_HEAD up to the next one; None for what stands before the first.

    The header gives the blob's size, so a separator that a blob holds by chance is an error and not a lost block."""
    if not record or record[0] == 0:  # the four bytes of a header's length; they are below 2^24
        return None
    at, size = 0, None
    while size is None:
        key, at = varint(record, at)
        if key == 2 << 3 | 2:
            n, at = varint(record, at)
            at += n
        elif key == 3 << 3:
            size, at = varint(record, at)
        else:
            raise ValueError("blob header")
    if len(record) < at + size:
        raise ValueError("a blob is cut short")
    return record[at : at + size]


def blob_offsets(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(offset, type, bytes) of a file's blobs, by seeking from header to header through the file system that Spark uses.

    One seek a blob of up to 32 MB, so tens of thousands for the largest files there are."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    end, at, out = fs.getFileStatus(where).getLen(), 0, []
    stream = fs.open(where)
    try:
        while at + 4 <= end:
            stream.seek(at)
            n = int.from_bytes(stream.readNBytes(4), "big")
            head = dict(fields(bytes(stream.readNBytes(n))))
            out.append((at, bytes(head[1]).decode(), 4 + n + head[3]))
            at += 4 + n + head[3]
    finally:
        stream.close()
    return out


def read_extract(spark: SparkSession, path: str, start: int = 0) -> DataFrame:
    """ENTITY rows of the extracts under path; `start` resumes a single file at a blob offset.

    To resume, the blobs from there on are listed, and tasks read their ranges through the file systems that Arrow opens.
    """
    import pandas as pd

    names = [x.split(" ")[0] for x in ("kind s", "id s", "tags s", "lon s", "lat s", "refs s", "members s")]

    def entities(blob: bytes | None):
        block = None if blob is None else unpack(blob)
        if block is not None:
            yield pd.DataFrame(block_entities(block), columns=names)

    def decode(batches):
        for pdf in batches:
            for record in pdf["record"]:
                yield from entities(data_blob(bytes(record)))

    def ranges(batches):
        from pyarrow import fs

        for pdf in batches:
            for name, at, size in zip(pdf["path"], pdf["at"], pdf["size"]):
                store, inner = fs.FileSystem.from_uri(name)
                with store.open_input_file(inner) as f:
                    for _, kind, blob in blobs(f.read_at(size, at)):
                        if kind == "OSMData":
                            yield from entities(blob)

    small_batches(spark)
    if not start:
        records = spark.read.option("lineSep", DATA_HEAD).text(path).select(F.col("value").cast("binary").alias("record"))
        return records.mapInPandas(decode, ENTITY)
    todo = [(path, at, size) for at, kind, size in blob_offsets(spark, path) if at >= start and kind == "OSMData"]
    return spark.createDataFrame(todo, "path string, at long, size long").repartition(max(1, len(todo))).mapInPandas(ranges, ENTITY)


def changes_of(data: bytes) -> list[tuple]:
    """CHANGE rows of one change file, numbered in document order. A reference 0 is dropped, of members only ways are kept."""
    import gzip

    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    rows, state = [], {"op": None, "cur": None}

    def start(name, a):
        if name in ("create", "modify", "delete"):
            state["op"] = name
        elif name in ("node", "way", "relation") and state["op"]:
            num = lambda k: float(a[k]) if a.get(k) else None
            state["cur"] = [name, int(a.get("id", 0)), {}, num("lon"), num("lat"), [] if name == "way" else None, [] if name == "relation" else None]
        elif state["cur"]:
            cur = state["cur"]
            if name == "tag":
                cur[2][a.get("k", "")] = a.get("v", "")
            elif name == "nd" and cur[5] is not None and int(a.get("ref", 0)):
                cur[5].append(int(a["ref"]))
            elif name == "member" and cur[6] is not None and a.get("type") == "way" and int(a.get("ref", 0)):
                cur[6].append({"id": int(a["ref"]), "role": a.get("role", "")})

    def end(name):
        if state["cur"] and name == state["cur"][0]:
            rows.append((len(rows), state["op"], *state["cur"]))
            state["cur"] = None
        elif name == state["op"]:
            state["op"] = None

    p = expat.ParserCreate()
    p.StartElementHandler, p.EndElementHandler = start, end
    p.Parse(data, True)
    return rows


def sequence(path):
    """The sequence that a change file's last three path parts spell, null for other paths."""
    return F.regexp_replace(F.regexp_extract(path, r"(\d{3}/\d{3}/\d{3})\.osc(\.gz)?$", 1), "/", "").try_cast("long")


def changes(files: DataFrame) -> DataFrame:
    """(path, seq, CHANGE) of binaryFile rows; seq is the number that the three last path parts spell. Works on streams."""
    import pandas as pd

    names = ["path", *(x.strip().split(" ")[0] for x in ("ord l", "op s", "kind s", "id l", "tags m", "lon d", "lat d", "refs a", "members a"))]

    def run(batches):
        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame([(path, *r) for r in changes_of(data)], columns=names)

    small_batches(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "path string, " + CHANGE).withColumn("seq", sequence(F.col("path")))
