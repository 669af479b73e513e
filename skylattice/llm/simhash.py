"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document gets a 64-bit fingerprint of its word shingles. For a radius r, each bit position is mapped to a vector
of r + 1 bits, and each of the 2^(r+1) - 1 nonzero vectors v gives a mask: the positions whose vector has an odd inner
product with v. For r differing positions some v is orthogonal to all their vectors, so the two fingerprints agree
under that mask: every pair within the radius collides in some table, none is missed by chance.

Equal fingerprints are one vertex, so groups of copies cost one row. In buckets of up to BUCKET fingerprints the pairs are
verified one by one; larger ones, at any size, are solved exactly without pairs where the radius is 2: two fingerprints
are within 2 bits iff they share a point at most one flipped bit away, so each joins 65 stars, and a star has at
most 65 members. For other radii large buckets are verified block by block in numpy, and a block
gives one link a member at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stage, text_batches
from .shingles import distinct_documents  # noqa: F401  the pipeline's stage, by exact similarity

BUCKET = 64


def masks(radius: int, bits: int = 64) -> list[int]:
    """Covering masks. The map from positions to vectors runs through all vectors in turn, so masks are of about equal weight."""
    vectors = [i % (1 << (radius + 1)) for i in range(1, bits + 1)]
    order = np.random.RandomState(radius).permutation(bits)
    return [sum(1 << int(order[i]) for i in range(bits) if bin(vectors[i] & v).count("1") % 2) for v in range(1, 1 << (radius + 1))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """A-Z lower-cased; words are runs without ASCII white space; bit i is set if over half the shingle hashes have it."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    buf = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(buf, seed)
    ends = np.flatnonzero(np.frombuffer(buf, np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    stops = [*ends.tolist(), len(buf)][words - 1 :]
    bits = np.zeros(64, np.int64)
    count = len(stops)
    for at in range(0, count, 1 << 16):
        hashes = np.array([digest(buf[a:b], seed) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])], dtype="<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): a map over the scan. Null and empty texts get fingerprint 0."""
    import pandas as pd

    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "fp": np.array([signed(fingerprint(t, words)) for t in pdf["text"]], dtype=np.int64)})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, fp long")


def joined(near: np.ndarray, same: bool) -> np.ndarray:
    """Of the rows and columns of a block of links: for each the least number (rows first) that links lead to."""
    n, m = near.shape
    rows, cols = np.arange(n), np.arange(m) if same else np.arange(n, n + m)
    while True:
        new_rows = np.minimum(rows, np.where(near, cols[None, :], n + m).min(axis=1))
        new_cols = np.minimum(cols, np.where(near, new_rows[:, None], n + m).min(axis=0))
        if same:
            new_rows = new_cols = np.minimum(new_rows, new_cols)
        if (new_rows == rows).all() and (new_cols == cols).all():
            return rows if same else np.concatenate([rows, cols])
        rows, cols = new_rows, new_cols


def _verify_blocks(radius: int, block: int = 1024):
    """Links of a large bucket, found in blocks of pairs; each block gives at most one link for each of its members."""
    import pandas as pd

    def run(key, pdf):
        fps = np.unique(pdf["fp"].to_numpy()).view(np.uint64)
        out = []
        for i in range(0, len(fps), block):
            for j in range(i, len(fps), block):
                left, right = fps[i : i + block], fps[j : j + block]
                root = joined(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius, i == j)
                both = left if i == j else np.concatenate([left, right])
                moved = root != np.arange(len(both))
                out.append(np.stack([both[root[moved]], both[moved]]))
        a, b = np.concatenate(out, axis=1).view(np.int64)
        return pd.DataFrame({"a": a, "b": b})

    return run


def links(points: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all pairs within the radius."""
    tables = F.array(*(F.struct(F.lit(k).alias("m"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(masks(radius))))
    rows = points.select("fp", F.explode(tables).alias("t")).select("t.m", "t.key", "fp")
    sizes = rows.groupBy("m", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, as a join with an aggregate on its own key can't be split where a bucket is hot
    sizes = stage(sizes, "sizes")
    met = stage(rows.join(sizes, ["m", "key"]), "buckets")
    small = (
        met.where(F.col("n") <= BUCKET)
        .groupBy("m", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .selectExpr(f"explode(flatten(transform(fps, a -> transform(filter(fps, b -> a < b and bit_count(a ^ b) <= {radius}), b -> struct(a as a, b as b))))) as e")
        .select("e.a", "e.b")
    )
    large = met.where(F.col("n") > BUCKET)
    if radius == 2:
        flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)))
        stars = large.select("fp").distinct().select("fp", F.explode(flips).alias("star")).groupBy("star").agg(F.collect_list("fp").alias("fps"), F.min("fp").alias("a")).where(F.size("fps") > 1)
        big = stars.select("a", F.explode("fps").alias("b")).where("a <> b")
    else:
        big = large.groupBy("m", "key").applyInPandas(_verify_blocks(radius), "a long, b long")
    return small.union(big)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): one row per row of docs; component_id is the smallest id reachable by links, itself included.

    A null id takes part under its fingerprint but is never the smallest unless its whole component has none.
    """
    prints = stage(fingerprints(docs, words, id_col, text_col), "fingerprints")
    points = prints.groupBy("fp").agg(F.min("id").alias("low"))
    points = stage(points, "points")
    roots = components(links(points, radius))
    member = points.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = stage(member.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    classes = stage(member.join(lowest, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
