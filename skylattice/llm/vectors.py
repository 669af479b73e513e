"""Vector operators: near-duplicates over a pivot-permutation index, and exact top-k search with pivot-table elimination.

Vectors that are null or hold null or non-finite components take no part (zero vectors too, for cosine). A vec_id that is
given several times stands for its smallest vector; a null vec_id can't be named and takes no part.
"""

from __future__ import annotations

import json
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import components, stage
from .simhash import joined


def usable(vectors: DataFrame, id_col: str, vec_col: str, zero: bool) -> DataFrame:
    """(id, v): one row per vec_id whose vector has finite components only; floats stay floats, as they are half the bytes."""
    single = isinstance(vectors.schema[vec_col].dataType.elementType, FloatType)
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v")).where("id is not null and v is not null")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(fine & (F.size("v") > 0))
    if not zero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    # only ids move to see whether one is given several times, and only such rows are grouped
    again = stage(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "again")
    if again.isEmpty():
        return rows
    return rows.join(again, "id", "left_anti").union(rows.join(again, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v")))


def sample(rows: DataFrame, size: int) -> np.ndarray:
    """A bounded sample of distinct vectors of one length, the first `size` by hash of their components: same rows, same sample."""
    h = F.xxhash64("v")
    least = [r["h"] for r in rows.select(h.alias("h")).distinct().orderBy("h").limit(size).collect()]
    if not least:
        return np.zeros((0, 1))
    found = [r["v"] for r in rows.where(h.isin(least)).groupBy(h.alias("h")).agg(F.min("v").alias("v")).orderBy("h").collect()]
    length = Counter(map(len, found)).most_common(1)[0][0]
    return np.array([v for v in found if len(v) == length], dtype=np.float64)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by the largest component first so that squares neither overflow nor vanish."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def matrix(lists, width: int) -> np.ndarray:
    """Rows of an Arrow list array in double precision, cut or filled with zeros to `width`."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(flat) == len(lists) * width and (np.diff(ends, prepend=0) == width).all():
        return flat.reshape(-1, width)
    m = np.zeros((len(lists), width))
    for row, (a, b) in enumerate(zip([0, *ends], ends)):
        m[row, : min(b - a, width)] = flat[a : min(b, a + width)]
    return m


def constant(values, kind: str):
    """A list of numbers as one literal."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def near_pairs(vectors: DataFrame, at_least: float = 0.9, near: int = 8, shared: int = 2, block: int = 1024, most_pivots: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(links per vector: id, n_links), (edges: a, b that connect what links connect).

    Index: 2 x sqrt(n) pivots (from 32 to `most_pivots`, which bounds the sample on the driver) are sampled; each vector is described by its `near` nearest pivots in order
    and is posted in their inverted lists. Two vectors are candidates if their descriptions share `shared` pivots. A
    pair is counted in the shortest list that it shares, so that no pair is counted twice or written down; with `shared` pivots in
    common that list is among the near - shared + 1 shortest of both, and the longer ones needn't be kept. Lists are cut into blocks
    of about `block` vectors and block pairs are tasks of their own, so a list of any length is spread; a pair of blocks yields
    counts per vector and a spanning forest, not its pairs. With `near` of at least the number of pivots no pair is missed.
    """
    import pandas as pd

    rows = usable(vectors, id_col, vec_col, zero=False)
    n = rows.count()
    pivots = sample(rows, min(most_pivots, max(32, 2 * math.isqrt(n))))
    if not len(pivots):
        none = rows.select("id", F.lit(0).cast("long").alias("n_links"))
        return none, rows.select(F.col("id").alias("a"), F.col("id").alias("b"))
    pivots = unit(pivots)
    k = min(near, len(pivots))
    need = min(shared, k)

    def describe(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                m = matrix(part.column("v"), pivots.shape[1])
                sim = unit(np.where(np.abs(m).max(axis=1, keepdims=True) > 0, m, 1.0)) @ pivots.T
                top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(sim, top, axis=1), axis=1), axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, top.size + 1, k), pa.int32()), pa.array(top.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "pivots"])

    kind = rows.schema["v"].dataType.simpleString()
    hashed = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    described = stage(hashed.mapInArrow(describe, f"id long, v {kind}, h1 long, h2 long, pivots array<int>"), "described")
    # equal vectors are one row of the index with a multiplicity; all of them link with each other
    classes = stage(described.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    index = described.join(classes.select(F.col("rep").alias("id"), "copies"), "id").withColumnRenamed("id", "rep")
    sizes = {r["pivot"]: r["n"] for r in index.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per pivot
    order = sorted(range(len(pivots)), key=lambda p: (sizes.get(p, 0), p))
    rank = {p: i for i, p in enumerate(order)}
    ranks, cuts = constant([rank[p] for p in range(len(pivots))], "array<int>"), constant([-(-sizes.get(p, 0) // block) for p in order], "array<int>")
    # from here on a pivot goes by its rank
    ranked = F.array_sort(F.transform("pivots", lambda p: F.get(ranks, p)))
    lists = index.select("rep", "copies", "v", ranked.alias("pivots")).select("*", F.explode(F.slice("pivots", 1, k - need + 1)).alias("pivot"))
    lists = lists.withColumn("blocks", F.get(cuts, "pivot")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # each block meets every other once: block pairs (i, j) with i <= j
    lists = lists.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    lists = lists.select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "copies", "pivots", "v")

    def verify(key, found):
        pivot, i, j = (x.as_py() for x in key)
        own = found.column("own").to_numpy()
        left, right = (np.flatnonzero(own == x) for x in (i, j))
        reps, copies = found.column("rep").to_numpy(), found.column("copies").to_numpy()
        near_ids = matrix(found.column("pivots"), k).astype(np.int64)
        used, local, n = np.unique(near_ids, return_inverse=True, return_counts=True)
        # a shared pivot before this one counts 4096, one after it 1 (there are fewer than that); this one is shared by all, and single ones by none
        has = np.zeros((len(reps), len(used)), np.float32)
        has[np.arange(len(reps))[:, None], local.reshape(near_ids.shape)] = 1
        has = (has * np.where(used < pivot, np.float32(64), np.float32(1)))[:, (n > 1) & (used != pivot)]
        lengths = found.column("v").combine_chunks().value_lengths().to_numpy()
        m = unit(matrix(found.column("v"), int(lengths.max())))
        links, edges, same = np.zeros(len(reps), np.int64), [np.zeros((2, 0), np.int64)], i == j
        for a_at in range(0, len(left), 2048):
            a = left[a_at : a_at + 2048]
            for b_at in range(a_at if same else 0, len(right), 2048):
                b, one = right[b_at : b_at + 2048], same and a_at == b_at
                common = has[a] @ has[b].T
                hit = (common >= need - 1) & (common < 4096) & (lengths[a][:, None] == lengths[b][None, :])
                hit &= m[a] @ m[b].T >= at_least
                if one:
                    np.fill_diagonal(hit, False)
                links[a] += hit @ copies[b]
                if not one:
                    links[b] += copies[a] @ hit
                root, both = joined(hit | hit.T if one else hit, one), a if one else np.concatenate([a, b])
                moved = root != np.arange(len(both))
                edges.append(np.stack([both[root[moved]], both[moved]]))
        some = np.flatnonzero(links)
        x, y = np.concatenate(edges, axis=1)
        return pa.table({
            "a": np.concatenate([reps[some], reps[x]]),
            "b": np.concatenate([np.full(len(some), -1), reps[y]]),
            "n": np.concatenate([links[some], np.zeros(len(x), np.int64)]),
            "edge": np.repeat([False, True], [len(some), len(x)]),
        })

    met = stage(lists.groupBy("pivot", "i", "j").applyInArrow(verify, "a long, b long, n long, edge boolean"), "met")
    counted = met.where("not edge").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    per_class = stage(classes.join(counted, "rep", "left").select("h1", "h2", "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "per-class")
    members = described.select("id", "h1", "h2").join(per_class, ["h1", "h2"])
    edges = met.where("edge").select("a", "b").union(members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    return members.select("id", "n_links"), edges


def near_duplicates(vectors: DataFrame, at_least: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", **how) -> DataFrame:
    """(id, n_links, component_id, kept), one row per vec_id. What takes no part has no links and is its own component;
    a null id gives one row with a null component that is kept."""
    links, edges = near_pairs(vectors, at_least, id_col=id_col, vec_col=vec_col, **how)
    roots = components(edges)
    lowest = stage(roots.groupBy("root").agg(F.min("v").alias("component_id")), "lowest")
    of = roots.join(lowest, "root").select(F.col("v").alias("id"), "component_id")
    out = vectors.select(F.col(id_col).cast("long").alias("id")).distinct().join(links, "id", "left").join(of, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, n_pivots: int = 48, group: int = 8192, queries: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query with all other vectors.

    Queries are the rows whose id is divisible by `every`. Components become floor(scale * x), so scores are exact in double
    precision up to 2^53. A written table holds each vector's distances to `n_pivots` sampled pivots. For a query q and a candidate c
    d(q, c) >= max over pivots p of |d(q, p) - d(c, p)|, and q.c = (|q|^2 + |c|^2 - d^2) / 2 turns that into an upper bound of
    the score; the same with the least and greatest distances of a group bounds all its candidates.

    Vectors are grouped by nearest pivot, in groups of about `group`, and queries in blocks of `queries` by theirs. First each query
    searches one group near it, which gives a k-th score to beat. Then only those pairs of block and group are formed in which
    some bound reaches its query's k-th score; each is one task, evaluates candidates in the order of their bounds
    until these fall below the k-th score, and gives at most k rows a query. Vectors of other lengths have no inner product.
    """
    import pandas as pd

    ints = F.transform("v", lambda x: F.floor(x.cast("double") * float(scale)).cast("double"))
    rows = usable(vectors, id_col, vec_col, zero=True).select("id", ints.alias("v"))
    pivots = sample(rows, n_pivots)
    if not len(pivots):
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).where("false")
    width, p_norm = pivots.shape[1], (pivots * pivots).sum(axis=1)

    def measure(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lengths = part.column("v").value_lengths().to_numpy()
                m = matrix(part.column("v"), width)
                norm = np.array([float(np.dot(x, x)) for x in (np.asarray(y.values) for y in part.column("v"))])
                d = np.sqrt(np.maximum(0, norm[:, None] + p_norm[None, :] - 2 * (m @ pivots.T)))
                d[lengths != width] = 0  # what has no distance isn't bounded by any
                dist = pa.ListArray.from_arrays(pa.array(np.arange(0, d.size + 1, d.shape[1]), pa.int32()), pa.array(d.ravel().astype(np.float32)))
                cell = np.where(lengths == width, d.argmin(axis=1), -1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(norm), dist, pa.array(lengths.astype(np.int32)), pa.array(cell.astype(np.int32))], names=["id", "v", "norm", "dist", "length", "cell"])

    table = stage(rows.mapInArrow(measure, "id long, v array<double>, norm double, dist array<float>, length int, cell int"), "pivot-table")
    # a count per cell and length
    count = lambda df: {(r["length"], r["cell"]): r["n"] for r in df.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = table.where(F.col("id") % every == 0)
    sized = lambda of, most, name: table.sparkSession.createDataFrame([(*c, max(1, -(-n // most))) for c, n in of.items()] or [(0, 0, 1)], f"length int, cell int, {name} int")
    parts, blocks = F.broadcast(sized(count(table), group, "parts")), F.broadcast(sized(count(asked), queries, "blocks"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    own = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns))  # noqa: E731  the sides of a cogroup need columns of their own
    grouped = own(table.join(parts, ["length", "cell"]).select("id", "v", "norm", "dist", "length", "cell", part))
    block = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.col("blocks")).cast("int").alias("block")
    left = asked.join(parts, ["length", "cell"]).join(blocks, ["length", "cell"]).select("id", "v", "norm", "dist", "length", "cell", part, block)

    def search(key, q, c):
        columns = ["query_id", "vec_id", "score"]
        if not len(q) or not len(c):
            return pd.DataFrame(columns=columns).astype("int64")
        out, cid, cn = [], c["id"].to_numpy(), c["norm"].to_numpy()
        cm, qm, dc, dq = (np.stack(x).astype(np.float64) for x in (c["v"], q["v"], c["dist"], q["dist"]))
        floor_ = q["floor"].to_numpy() if "floor" in q else np.full(len(q), -np.inf)
        for i, (qid, qn, beat) in enumerate(zip(q["id"].tolist(), q["norm"].tolist(), floor_.tolist())):
            least = np.abs(dc - dq[i]).max(axis=1)
            bound = (qn + cn - least * least) / 2 + 1e-5 * (qn + cn) + 1  # rounding never makes a bound too low
            some = np.flatnonzero(bound >= beat)
            order = some[np.argsort(-bound[some])]
            got_s, got_i, at, step = np.empty(0), np.empty(0, np.int64), 0, 256
            while at < len(order) and (len(got_s) < k or bound[order[at]] >= got_s[-1]):
                some = order[at : at + step]
                some = some[cid[some] != qid]
                got_s, got_i = np.concatenate([got_s, cm[some] @ qm[i]]), np.concatenate([got_i, cid[some]])
                best = np.lexsort((got_i, -got_s))[:k]
                got_s, got_i, at, step = got_s[best], got_i[best], at + step, step * 2
            out.append((np.full(len(got_i), qid), got_i, got_s.astype(np.int64)))
        return pd.DataFrame(dict(zip(columns, (np.concatenate(x) for x in zip(*out)))))

    result, at_home = "query_id long, vec_id long, score long", ["length", "cell", "part"]
    first = stage(left.groupBy(*at_home).cogroup(grouped.groupBy(*at_home)).applyInPandas(search, result), "first")
    best = first.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    left = left.join(best, "id", "left").withColumn("floor", F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(float("-inf"))).drop("least", "n")
    left = stage(left, "queries")

    # what bounds a whole group: its largest norm, and the least and greatest distance to each pivot
    ends = [f(F.get("dist", i)).alias(f"{name}{i}") for name, f in (("lo", F.min), ("hi", F.max)) for i in range(len(pivots))]
    lo, hi = (F.array(*(f"{name}{i}" for i in range(len(pivots)))).alias(name) for name in ("lo", "hi"))
    bounds = grouped.groupBy(*at_home).agg(F.max("norm").alias("norm"), *ends).select(*at_home, "norm", lo, hi)
    bounds = stage(bounds.withColumn("chunk", F.pmod(F.xxhash64("cell", "part"), F.lit(max(1, bounds.count() // 1024))).cast("int")), "bounds")
    chunks = bounds.select("length", "chunk").distinct()
    asking = left.select("length", F.col("cell").alias("q_cell"), "block", "norm", "dist", "floor", F.col("part").alias("q_part")).join(chunks, "length")

    def promising(key, q, g):
        names = ["length", "q_cell", "block", "cell", "part"]
        if not len(q) or not len(g):
            return pd.DataFrame(columns=names).astype("int32")
        low, high, norm = np.stack(g["lo"]).astype(np.float64), np.stack(g["hi"]).astype(np.float64), g["norm"].to_numpy()
        wanted = np.zeros(len(g), bool)
        for d, qn, beat, cell, own in zip(q["dist"], q["norm"], q["floor"], q["q_cell"], q["q_part"]):
            d = np.asarray(d, np.float64)
            least = np.maximum(0, np.maximum(low - d, d - high)).max(axis=1)
            reach = (qn + norm - least * least) / 2 + 1e-5 * (qn + norm) + 1 >= beat
            wanted |= reach & ~((g["cell"].to_numpy() == cell) & (g["part"].to_numpy() == own))
        return g.loc[wanted, ["cell", "part"]].assign(length=key[0], q_cell=key[1], block=key[2])[names]

    keys = ["length", "q_cell", "block", "chunk"]
    blocks_of = asking.select(*keys).distinct()
    met = own(bounds.join(own(blocks_of), ["length", "chunk"]))
    pairs = asking.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInPandas(promising, "length int, q_cell int, block int, cell int, part int")
    pairs = stage(pairs, "pairs")
    # a query's own group was searched first
    ask = left.withColumnsRenamed({"cell": "q_cell", "part": "q_part"}).join(pairs, ["length", "q_cell", "block"]).where("not (cell = q_cell and part = q_part)")
    give = own(grouped.join(own(pairs), at_home))
    whole = ["length", "q_cell", "block", "cell", "part"]
    found = ask.groupBy(*whole).cogroup(give.groupBy(*whole)).applyInPandas(search, result).union(first)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
