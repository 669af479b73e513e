"""Change feeds: collapse to the last change, upsert, delete, tag differences, insert-if-absent, store merges.

Nothing is updated in place: each operator gives the new version of a table, to be written beside the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_changes(changes: DataFrame, key: list[str] = ["id"]) -> DataFrame:  # noqa: B006
    """The change with the greatest (seq, ord) of each key: one aggregate that combines before the shuffle, not a window."""
    rest = [c for c in changes.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct("seq", "ord")).alias("last")
    return changes.groupBy(*key).agg(last).select(*key, *(F.col(f"last.{c}").alias(c) for c in rest))


def upsert(base: DataFrame, last: DataFrame) -> DataFrame:
    """base with deleted keys gone and created or modified ones replaced; `last` has id, op and base's columns."""
    new = last.where("op <> 'delete'").select(*base.columns)
    return base.join(last.select("id"), "id", "left_anti").select(*base.columns).unionByName(new)


def tag_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, k, op, old_v, new_v) of (id, k, v) rows that differ."""
    both = old.select("id", "k", F.col("v").alias("old_v")).join(new.select("id", "k", F.col("v").alias("new_v")), ["id", "k"], "full")
    op = F.when(F.col("old_v").isNull(), "insert").when(F.col("new_v").isNull(), "delete").when(F.col("old_v") != F.col("new_v"), "update")
    return both.withColumn("op", op).where("op is not null").select("id", "k", "op", "old_v", "new_v")


def delete_cascade(entities: DataFrame, tags: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    ids = gone.select("id").distinct()
    return entities.join(ids, "id", "left_anti"), tags.join(ids, "id", "left_anti")


def insert_absent(base: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of new whose id base doesn't have."""
    return new.join(base.select("id"), "id", "left_anti")


def children_of(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def merge_stores(*stores: DataFrame) -> DataFrame:
    """(id, x, y) of several coordinate stores; the first that has an id wins. Minimum of (number, x, y), combined before the shuffle."""
    rows = [s.select("id", F.struct(F.lit(k).alias("n"), "x", "y").alias("p")) for k, s in enumerate(stores)]
    all_rows = rows[0]
    for r in rows[1:]:
        all_rows = all_rows.union(r)
    return all_rows.groupBy("id").agg(F.min("p").alias("p")).select("id", "p.x", "p.y")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def resolve(refs: DataFrame, *stores: DataFrame) -> DataFrame:
    """refs (node_id, …) with x, y from the first of the stores, newest first, that knows the node; unknown ones drop out."""
    return refs.join(merge_stores(*stores).withColumnRenamed("id", "node_id"), "node_id")


def store_update(store: DataFrame, moved: DataFrame, removed: DataFrame, ceiling: int = 100_000_000_000) -> DataFrame:
    """A coordinate store after node changes; ids beyond the ceiling are refused."""
    kept = store.join(removed.select("id"), "id", "left_anti")
    return merge_stores(moved.where(F.col("id").between(0, ceiling)), kept)


def id_range(store: DataFrame) -> DataFrame:
    """(highest, lowest, n) of the populated ids."""
    return store.agg(F.max("id").alias("highest"), F.min("id").alias("lowest"), F.count(F.lit(1)).alias("n"))


def id_window(store: DataFrame, lo: int, hi: int) -> DataFrame:
    """The rows of ids from lo to hi; the range reaches the scan, and files in id order are skipped by it."""
    return store.where(F.col("id").between(lo, hi))
