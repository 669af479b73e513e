"""Helpers that the corpus operators share: table access, staged tables, distributed ranks, components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or (only where unset, as in tests) a temp folder. On a cluster
    it must be set, as a machine's own folder would be another one for each executor."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="skylattice-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def text_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Bounds an Arrow batch by bytes, as rows that hold whole texts are large: both sides hold a batch or two per task. Called by what sends texts to Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))
    if now <= 0 or now > most:
        spark.conf.set(key, str(most))


def give_back() -> None:
    """Returns what a Python worker has freed to the system: workers are reused, and would else keep the most that any task held."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass


def thrifty(batches, work):
    """work(batch) for each batch, without holding on to a batch while the next one is fetched; memory is given back at the end."""
    try:
        for batch in batches:
            out = work(batch)
            del batch
            yield from out
            del out
    finally:
        give_back()


def stage_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


_staged: list[str] = []


def staged() -> list[str]:
    """Paths of the staged tables that this process wrote and hasn't dropped."""
    return list(_staged)


def drop_stages(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> int:
    """Deletes the staged tables that this process wrote after the first `since`, except those that `keep` reads, once nothing
    lazy needs them any more. Returns how many are left, which is the next call's `since`."""
    kept = {f.rsplit("/", 1)[0] for f in keep.inputFiles()} if keep is not None else set()
    jvm = spark.sparkContext._jvm
    for path in _staged[since:]:
        if not any(k.endswith(path.rsplit("/", 1)[1]) for k in kept):
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            _staged.remove(path)
    return len(_staged)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors.

    The tables stay until `drop_stages`, since results are lazy and may read them at any time.
    """
    path = stage_path(df.sparkSession, tag)
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def global_rank(df: DataFrame, order: list, rank: str) -> DataFrame:
    """Adds a gapless rank from 0 in the given order without bringing rows to one task.

    Rows are range-partitioned and sorted, written once, counted per partition; the only thing that reaches
    the driver is one count per shuffle partition, which the session's partition setting bounds.
    `order` must be a total order for a reproducible rank.
    """
    spark = df.sparkSession
    kept = stage(
        df.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "rank",
    )
    counts = {r["__pid"]: r["n"] for r in kept.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for pid in sorted(counts):
        offsets.append((pid, total))
        total += counts[pid]
    steps = spark.createDataFrame(offsets or [(0, 0)], "__pid int, __off long")
    return kept.join(F.broadcast(steps), "__pid").withColumn(rank, F.col("__off") + F.col("__pos")).drop("__pid", "__pos", "__off")


def _forest(batches):
    """Reduce the edges of one partition to a spanning forest of stars, in bounded memory (restarts every 2M vertices)."""
    import pandas as pd

    parent: dict = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    def out():
        pairs = [(v, find(v)) for v in parent]
        return pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 2_000_000:
            yield out()
            parent.clear()
    yield out()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a long, b long) as rows (v, root).

    Local contraction: in each round every vertex takes the vertex of least priority (a fresh hash each round)
    in its closed neighbourhood, and edges are relabelled; the expected vertex count falls by a constant factor,
    for paths and hubs alike, so rounds grow with the logarithm of the largest component. Before each round
    partitions thin their own edges to a forest. Minima are pre-aggregated before the shuffle; relabelling is an
    equi-join that adaptive execution splits at hubs. Each round is a written table, nothing is collected but a count.
    """
    spark = edges.sparkSession
    edges = edges.select("a", "b").where("a <> b")
    maps: list[DataFrame] = []
    turn = 0
    while True:
        live = stage(edges.mapInPandas(_forest, "a long, b long"), "edges")
        if live.isEmpty():
            break
        turn += 1
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pri = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("p"), F.col(c).alias("v"))
        to = stage(both.groupBy("a").agg(F.least(F.min(pri("b")), F.min(pri("a"))).alias("m")).select(F.col("a").alias("v"), F.col("m.v").alias("to")), "hop")
        maps.append(to)
        left = live.join(to.select(F.col("v").alias("a"), F.col("to").alias("a2")), "a").select("a2", "b")
        edges = left.join(to.select(F.col("v").alias("b"), F.col("to").alias("b2")), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b")
    if not maps:
        return spark.createDataFrame([], "v long, root long")
    # unroll: the last map's values are roots; earlier maps look their values up in the later ones
    roots = None
    for to in reversed(maps):
        if roots is None:
            roots = to.select("v", F.col("to").alias("root"))
        else:
            up = roots.select(F.col("v").alias("to"), "root")
            roots = to.join(up, "to", "left").select("v", F.coalesce("root", "to").alias("root"))
    return stage(roots, "roots")
