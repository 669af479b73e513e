"""Checks of a loaded database: structure, staleness, golden facts, samples and report figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def count_bounds(tables: dict[str, DataFrame], bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """(table, n, ok): whether each table's rows are within its bounds."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table"), "n", F.col("n").between(*bounds[t]).alias("ok")) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def top_names(pairs: DataFrame, k: int = 3) -> DataFrame:
    """(point_id, name, n, total, rank): the most frequent names near each point (point_id, name), ties by name."""
    counts = pairs.where("name is not null and name <> ''").groupBy("point_id", "name").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("point_id")
    ranked = counts.withColumn("total", F.sum("n").over(own)).withColumn("rank", F.row_number().over(own.orderBy(F.desc("n"), "name")))
    return ranked.where(F.col("rank") <= k).select("point_id", "name", "n", "total", "rank")


def radius_stats(pairs: DataFrame) -> DataFrame:
    """(point_id, n, max_amsl, max_agl) of obstacle pairs."""
    return pairs.groupBy("point_id").agg(F.count(F.lit(1)).alias("n"), F.max("amsl_ht").alias("max_amsl"), F.max("agl_ht").alias("max_agl"))


def staleness(state: DataFrame, now: Column, limits: dict[str, float]) -> DataFrame:
    """(name, hours, stale): the age of each source's state (name, checked_at); one without a limit or never checked is stale."""
    hours = (F.unix_timestamp(now) - F.unix_timestamp("checked_at")) / F.lit(3600.0)
    limit = reduce(lambda c, kv: c.when(F.col("name") == kv[0], F.lit(float(kv[1]))), limits.items(), F.when(F.lit(False), F.lit(0.0)))
    return state.withColumn("hours", hours).select("name", "hours", F.coalesce(F.col("hours") > limit, F.lit(True)).alias("stale"))


def refresh_due(state: DataFrame, remote: DataFrame, now: Column, slack_s: int = 300, max_days: dict[str, int] | None = None) -> DataFrame:
    """(name, due): by days for the names of max_days, else if the remote time differs by more than slack; never recorded is due."""
    max_days = max_days or {}
    met = remote.select("name", F.col("modified").alias("__m")).join(state.select("name", F.col("value").alias("__v")), "name", "full")
    aged = reduce(lambda c, kv: c.when(F.col("name") == kv[0], F.unix_timestamp(now) - F.col("__v") >= kv[1] * 86400), max_days.items(), F.when(F.lit(False), F.lit(True)))
    differs = F.abs(F.col("__m") - F.col("__v")) > slack_s
    return met.select("name", F.coalesce(aged, differs, F.lit(True)).alias("due"))


def angle_stats(pairs: DataFrame, a: str, b: str) -> DataFrame:
    d = geo.angle_difference(F.col(a), F.col(b))
    return pairs.agg(F.round(F.avg(d), 6).alias("mean"), F.round(F.max(d), 6).alias("most"), F.count(F.lit(1)).alias("n"))


def timing(samples: DataFrame, category: str, ms: str) -> DataFrame:
    """(category, n, avg_ms, total_s), the costliest first: a slow kind of query stands out. One row a category."""
    rows = samples.groupBy(category).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(ms), 6).alias("avg_ms"), F.round(F.sum(ms) / 1000, 6).alias("total_s"))
    return rows.orderBy(F.desc("total_s"), category)


def model_difference(pairs: DataFrame, a: str, b: str, limit: float) -> DataFrame:
    """(mean, most, outliers) of the absolute difference of two models' values."""
    d = F.abs(F.col(a) - F.col(b))
    return pairs.agg(F.round(F.avg(d), 6).alias("mean"), F.round(F.max(d), 6).alias("most"), F.count_if(d > limit).alias("outliers"))


def region_counts(points: DataFrame) -> DataFrame:
    return points.groupBy(geo.rough_region(F.col("lon"), F.col("lat")).alias("region")).agg(F.count(F.lit(1)).alias("n"))


def report_rows(results: DataFrame, most: int) -> DataFrame:
    """Rows (idx, kind, flags, …) for a report of at most `most` rows, unless fixed ones alone are more.

    Fixed rows stay; of random ones those with most flags come first, then an even stride over the rest. The budget and the
    row counts are one small aggregate; ranks come from a window over the random rows, which a report bounds.
    """
    fixed, rand = results.where("kind <> 'random'"), results.where("kind = 'random'")
    sums = results.agg(F.count_if(F.col("kind") != "random").alias("n_fixed"), F.count_if(F.col("kind") == "random").alias("n_random"), F.count_if((F.col("kind") == "random") & (F.col("flags") > 0)).alias("n_flagged"))
    order = Window.partitionBy(F.col("flags") > 0).orderBy(F.desc("flags"), "idx")
    ranked = rand.withColumn("__r", F.row_number().over(order) - 1).crossJoin(F.broadcast(sums))  # one row
    budget = F.greatest(F.lit(0), F.lit(most) - F.col("n_fixed"))
    shown_flagged = F.least("n_flagged", budget)
    left = budget - shown_flagged
    step = F.greatest(F.lit(1), F.floor((F.col("n_random") - F.col("n_flagged")) / F.greatest(left, F.lit(1))))
    everything = F.col("n_fixed") + F.col("n_random") <= most
    keep = everything | (budget >= F.col("n_random")) | ((F.col("flags") > 0) & (F.col("__r") < shown_flagged)) | ((F.col("flags") <= 0) & (left > 0) & (F.col("__r") % step == 0) & (F.floor(F.col("__r") / step) < left))
    return fixed.unionByName(ranked.where(keep).select(*results.columns))


def golden(facts: DataFrame, measured: DataFrame) -> DataFrame:
    """(key, ok, diff): facts (key, expected, tolerance, ident) against measured (key, value, ident). A missing measure fails."""
    met = facts.join(measured.select("key", F.col("value").alias("__v"), F.col("ident").alias("__i")), "key", "left")
    diff = F.abs(F.col("__v") - F.col("expected"))
    ok = F.when(F.col("expected").isNotNull(), diff <= F.col("tolerance")).otherwise(F.col("__i") == F.col("ident"))
    return met.select("key", F.coalesce(ok, F.lit(False)).alias("ok"), F.round(diff, 6).alias("diff"))


def seeded_sample(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """n rows in the order of a seeded hash: the same on every run and every partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def sphere_points(spark, n: int, seed: int) -> DataFrame:
    """(id, lon, lat) uniform over the sphere."""
    u = lambda k: (F.xxhash64(F.col("id"), F.lit(seed), F.lit(k)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    return spark.range(n).select("id", (u(1) * 360 - 180).alias("lon"), geo.uniform_latitude(u(2)).alias("lat"))


def covered_sample(candidates: DataFrame, coverage: DataFrame, n: int, seed: int) -> DataFrame:
    """n candidates (id, cell) whose cell is covered: oversample, semi-join, take in hash order."""
    return seeded_sample(candidates.join(coverage.select("cell").distinct(), "cell", "left_semi"), n, seed)


def covered_points(spark, coverage: DataFrame, n: int, seed: int, cell: float, most: int = 300) -> DataFrame:
    """n points (id, lon, lat) over the sphere whose cell (cx, cy: degrees / cell) is covered; fewer if `most` draws a point don't find them.

    Draws grow fourfold until enough are found, so there are at most five jobs."""
    cells, draws = coverage.select("cx", "cy").distinct(), n
    while True:
        drawn = sphere_points(spark, draws, seed).withColumn("cx", geo.cell(F.col("lon"), cell)).withColumn("cy", geo.cell(F.col("lat"), cell))
        found = drawn.join(cells, ["cx", "cy"], "left_semi").orderBy("id").limit(n)
        if draws >= n * most or found.count() >= n:
            return found.select("id", "lon", "lat")
        draws = min(4 * draws, n * most)
