"""WARC archives: writing with segments and chunked transfer framing, and reassembly from continuation records.

Writing is a plan of DataFrame functions: each page is a record whose block is an HTTP response in chunked framing; a block
over `segment` bytes is cut into a first record and continuation records that name its origin and their number, the last
one with the total length. A payload of `least` bytes or more that several pages share is stored once, under the largest
page id; the others are revisit records with its digest and that page. Records are written by Spark's text writer with the
record end as line end, so archives are true WARC files in any file system that Spark reaches.

Reading takes whole files (none holds more than `file_bytes` before compression), parses records, groups segments by
origin, orders them by number, checks that none is missing and that the total is met, and decodes the framing. A record that
fails a check is returned with a reason and no payload. A revisit's payload is resolved to that of the page it refers to.

Null html is an empty payload. Pages that repeat an id are records of their own; of several with one shared payload and
the same largest id, all are responses. A null id is kept and is never referred to if another page has the payload.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, stage_path

END, CHUNK, SEGMENT, FILE_BYTES = "\r\n\r\n", 4096, 16384, 16 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def joined(parts: Column) -> Column:
    """The parts of a binary array in one step, in proportion to their bytes."""
    return F.unhex(F.array_join(F.transform(parts, F.hex), ""))


def marked(pages: DataFrame, least: int, id_col: str, html_col: str, url_col: str) -> DataFrame:
    """(id, url, data, digest, refers): refers is the page that holds the payload, null for those that hold it themselves."""
    data = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), data.alias("data")).withColumn("digest", F.sha1("data"))
    # only shared payloads need a holder; counts are pre-aggregated, so a payload of a third of all pages is one row a task
    shared = rows.where(F.octet_length("data") >= least).groupBy("digest").agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # written, as a join with an aggregate on its own key can't be split where a payload is hot
    shared = stage(shared, "shared")
    met = rows.join(shared, "digest", "left")
    return met.select("id", "url", "data", "digest", F.when(F.col("holder").isNotNull() & ~F.coalesce(F.col("id") == F.col("holder"), F.lit(False)), F.col("holder")).alias("refers"))


def write(pages: DataFrame, path: str, least: int = 1000, segment: int = SEGMENT, chunk: int = CHUNK, file_bytes: int = FILE_BYTES, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> None:
    """Writes gzip-compressed WARC files to the folder `path`."""
    rows = marked(pages, least, id_col, html_col, url_col).withColumn("uid", F.concat_ws("-", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.monotonically_increasing_id().cast("string")))
    text = lambda c: c.cast("binary")
    size_of = F.octet_length("data")
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(size_of, F.lit(1)) - 1) / chunk).cast("int")), lambda i: F.substring(F.col("data"), i * chunk + 1, F.lit(chunk)))
    framed = F.transform(F.filter(pieces, lambda p: F.octet_length(p) > 0), lambda p: F.concat(text(F.lower(F.hex(F.octet_length(p)))), F.lit(b"\r\n"), p, F.lit(b"\r\n")))
    body = F.concat(F.lit(HTTP), joined(framed), F.lit(b"0\r\n\r\n"))
    rows = rows.withColumn("block", F.when(F.col("refers").isNull(), body).otherwise(F.lit(HTTP)))
    total = F.octet_length("block")
    segments = F.transform(F.sequence(F.lit(0), F.floor((total - 1) / segment).cast("int")), lambda i: F.struct((i + 1).alias("no"), F.substring(F.col("block"), i * segment + 1, F.lit(segment)).alias("part")))
    rows = rows.withColumn("n", F.ceil(total / segment).cast("int")).withColumn("total", total).select("id", "uid", "url", "digest", "refers", "n", "total", F.explode(segments).alias("s"))
    # a URL is a header line: characters that would end it are escaped
    safe = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    many, later = F.col("n") > 1, F.col("s.no") > 1
    kind = F.when(later, "continuation").when(F.col("refers").isNotNull(), "revisit").otherwise("response")
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("uid"), F.when(later, F.concat(F.lit("-s"), F.col("s.no").cast("string"))).otherwise(""), F.lit(">")),
        F.when(~later, F.concat(F.lit("WARC-Target-URI: "), safe)),
        F.when(~later, F.concat(F.lit("WARC-Page-ID: "), F.coalesce(F.col("id").cast("string"), F.lit("null")))),
        F.when(~later, F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))),
        F.when(~later & F.col("refers").isNotNull(), F.concat(F.lit("WARC-Refers-To-Page: "), F.col("refers").cast("string"))),
        F.when(many, F.concat(F.lit("WARC-Segment-Number: "), F.col("s.no").cast("string"))),
        F.when(later, F.concat(F.lit("WARC-Segment-Origin-ID: <urn:page:"), F.col("uid"), F.lit(">"))),
        F.when(later & (F.col("s.no") == F.col("n")), F.concat(F.lit("WARC-Segment-Total-Length: "), F.col("total").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("s.part").cast("string")),
    )
    record = F.concat(text(F.concat(head, F.lit(END))), F.col("s.part")).cast("string")
    # no record is larger than a segment and its header, so a count of records bounds a file; records stay in the partitions of the join
    most = max(1, file_bytes // (segment + 1024))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def parse(data: bytes):
    """Records of an uncompressed archive: (headers, block). What isn't a record is skipped to the next version line."""
    at = 0
    while True:
        at = data.find(b"WARC/1.", at)
        if at < 0:
            return
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = headers.get("content-length", "")
        if not size.isdigit():
            at += 7
            continue
        at = stop + 4 + int(size)
        yield headers, data[stop + 4 : at]


def dechunk(body: bytes) -> bytes | None:
    """The payload of chunked framing; None if it is broken or cut."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+(;.*)?", body[at:line]):
            return None
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body


RECORD = "uid string, page string, url string, type string, digest string, refers string, no int, total long, part binary"


def number(x: str | None, most: int) -> int | None:
    """A header's count; None where it is missing, -1 where it isn't a number up to `most`."""
    return None if x is None else int(x) if x.isascii() and x.isdigit() and len(x) < 20 and int(x) <= most else -1


def records(spark, path: str) -> DataFrame:
    """All records of the archives in a folder, one row a segment; uid is the origin's record id, no is 0 for records in one piece, -1 for a broken header."""
    import gzip

    import pandas as pd

    def run(batches):
        for pdf in batches:
            for data in pdf["content"]:
                rows = []
                for h, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    uid = h.get("warc-segment-origin-id", h.get("warc-record-id", ""))
                    no, total = number(h.get("warc-segment-number"), (1 << 31) - 1), number(h.get("warc-segment-total-length"), (1 << 63) - 1)
                    rows.append((uid, h.get("warc-page-id"), h.get("warc-target-uri"), h.get("warc-type"), (h.get("warc-payload-digest") or "").removeprefix("sha1:"), h.get("warc-refers-to-page"), 0 if no is None else no, total, block))
                for k in range(0, len(rows), 500):
                    out = pd.DataFrame(rows[k : k + 500], columns=[x.split(" ")[0] for x in RECORD.split(", ")])
                    yield out.assign(total=out["total"].astype("Int64"))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(run, RECORD)


def read(spark, path: str) -> DataFrame:
    """(page_id, url, type, digest, refers_to, payload, reason): whole records; reason is null for sound ones."""
    found = records(spark, path)
    # only segmented records are shuffled; a group is one record
    several = found.where("no <> 0").groupBy("uid").agg(
        F.max("page").alias("page"), F.max("url").alias("url"), F.max(F.when(F.col("no") == 1, F.col("type"))).alias("type"), F.max(F.when(F.col("no") == 1, F.col("digest"))).alias("digest"),
        F.max("refers").alias("refers"), F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("no", "part"))).alias("parts"),
    )
    block = joined(F.transform("parts", lambda s: s["part"]))
    gapless = F.transform("parts", lambda s: s["no"]) == F.sequence(F.lit(1), F.size("parts"))
    several = several.select("page", "url", "type", "digest", "refers", block.alias("block"), F.when((F.get("parts", F.lit(0))["no"] < 0) | (F.col("total") < 0), "segment header broken").when(~gapless, "segment missing or repeated").when(F.col("total").isNull(), "no last segment").when(F.octet_length(block) != F.col("total"), "length differs").alias("reason"))
    single = found.where("no = 0").select("page", "url", "type", "digest", "refers", F.col("part").alias("block"), F.lit(None).cast("string").alias("reason"))

    def decode(batches):
        for pdf in batches:
            payload, reason = [], []
            for block, kind, digest, why in zip(pdf["block"], pdf["type"], pdf["digest"], pdf["reason"]):
                data = None
                if why is None and kind != "revisit":
                    data = http_payload(block)
                    why = "framing broken" if data is None else "digest differs" if hashlib.sha1(data).hexdigest() != digest else None
                payload.append(data if why is None else None)
                reason.append(why)
            yield pdf.drop(columns=["block"]).assign(payload=payload, reason=reason)

    out = several.union(single).mapInPandas(decode, "page string, url string, type string, digest string, refers string, reason string, payload binary")
    return out.select(F.expr("try_cast(page as bigint)").alias("page_id"), "url", "type", "digest", F.expr("try_cast(refers as bigint)").alias("refers_to"), "payload", "reason")


def round_trip(pages: DataFrame, least: int = 1000, **how) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, reason) of every page as read back from its archive."""
    spark = pages.sparkSession
    path = stage_path(spark, "warc")
    write(pages, path, least, **how)
    got = read(spark, path)
    back = got.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.when(F.col("payload").isNotNull(), F.sha1("payload")).alias("payload_digest"), "type", "digest", "refers_to", "reason")
    back = stage(back, "warc-rows")
    # the record that a revisit names must hold the payload that it names
    held = back.where("type = 'response' and payload_bytes is not null").groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("payload_bytes").alias("held_bytes"), F.max("payload_digest").alias("held_digest"))
    held = stage(held, "held")
    revisits = back.where("type = 'revisit'").join(held, ["refers_to", "digest"], "left")
    plain = back.where("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to", "reason")
    return plain.union(revisits.select("page_id", "held_bytes", "held_digest", F.col("type").alias("record_type"), "refers_to", F.when(F.col("held_bytes").isNull(), "payload not found").alias("reason")))

