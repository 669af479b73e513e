"""Writers and table upkeep: quarantine of bad rows, versioned replacement, state rows, statistics, reports."""

from __future__ import annotations

import html
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the column `reason`): a row is bad for the first check that isn't true for it."""
    reason = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()))
    marked = df.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def append(df: DataFrame, path: str, checks: dict[str, Column] | None = None) -> None:
    """Appends the good rows; bad ones go to `path`_quarantine instead of stopping the load."""
    if checks:
        df, bad = split_valid(df, checks)
        bad.write.mode("append").parquet(path.rstrip("/") + "_quarantine")
    df.write.mode("append").parquet(path)


def reload(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def put_state(state: DataFrame, name: str, value: int, at: Column) -> DataFrame:
    """State rows (name, value, checked_at) with one name set."""
    row = state.sparkSession.range(1).select(F.lit(name).alias("name"), F.lit(value).cast("long").alias("value"), at.cast("timestamp").alias("checked_at"))
    return state.where(F.col("name") != name).select("name", "value", "checked_at").unionByName(row)


def get_state(state: DataFrame, name: str) -> int:
    """The value of a name, -1 where it isn't there."""
    row = state.where(F.col("name") == name).select("value").first()
    return -1 if row is None else row["value"]


def register_region(installed: DataFrame, name: str, wkt: str, box: tuple[float, float, float, float], at: Column) -> DataFrame:
    row = installed.sparkSession.createDataFrame([(name, wkt, *map(float, box))], "name string, wkt string, min_lon double, min_lat double, max_lon double, max_lat double").withColumn("installed_at", at.cast("timestamp"))
    return installed.where(F.col("name") != name).unionByName(row)


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Statistics for the planner after a load."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(columns)}" if columns else ""))


def write_by_cell(df: DataFrame, path: str, size: float, x: str = "x", y: str = "y", files: int = 64) -> None:
    """What a spatial index is for a table: rows with their grid cell (cx, cy), laid out by it, so that readers of a box skip files and
    row groups by their least and greatest cell. Rows without a place come first."""
    cells = df.withColumn("cx", geo.cell(F.col(x), size)).withColumn("cy", geo.cell(F.col(y), size))
    cells.repartitionByRange(files, "cx", "cy").sortWithinPartitions("cx", "cy").write.mode("overwrite").parquet(path)


def read_box(spark: SparkSession, path: str, size: float, box: tuple[float, float, float, float], x: str = "x", y: str = "y") -> DataFrame:
    """The rows of a table written by cell that lie in a box (least x, y, greatest x, y)."""
    x0, y0, x1, y1 = box
    at = lambda v: math.floor(v / size)
    near = spark.read.parquet(path).where(F.col("cx").between(at(x0), at(x1)) & F.col("cy").between(at(y0), at(y1)))
    return near.where(F.col(x).between(x0, x1) & F.col(y).between(y0, y1)).drop("cx", "cy")


def write_shuffled(df: DataFrame, path: str, files: int) -> None:
    """A table that has no order of its own, over a given number of files."""
    df.repartition(files).write.mode("overwrite").parquet(path)


def report_json(rows: DataFrame, most: int = 100_000) -> str:
    """The rows of a report, which is small by its nature; more than `most` rows are refused, not cut."""
    got = rows.limit(most + 1).toJSON().collect()
    if len(got) > most:
        raise ValueError(f"a report of more than {most} rows")
    return json.dumps([json.loads(r) for r in got])


def report_html(rows: DataFrame, title: str, most: int = 500) -> str:
    """An HTML table of at most `most` rows (a display limit), with the number of rows left out."""
    got, total = rows.limit(most).collect(), rows.count()
    cell = lambda tag, v: f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>"
    head = "".join(cell("th", c) for c in rows.columns)
    body = "".join("<tr>" + "".join(cell("td", v) for v in r) + "</tr>" for r in got)
    more = f"<p>{total - len(got)} rows aren't shown.</p>" if total > len(got) else ""
    return f"<!DOCTYPE html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr>{head}</tr>{body}</table>{more}"
