"""Resumable stages: what is done is a table of keys, and what is left an anti-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.lineage import cut


def pending(items: DataFrame, done: DataFrame, key: Sequence[str], order: Sequence[str | Column] = (), limit: int | None = None) -> DataFrame:
    """Items whose key is not done; with a limit, the first of them in the order. The limit comes after the anti-join, before any fetch."""
    left = items.join(done.select(*key), list(key), "left_anti")
    if limit is None:
        return left
    if not order:
        raise ValueError("a limit needs an order")
    return left.orderBy(*order).limit(limit)


def tag_existing(items: DataFrame, done: DataFrame, key: Sequence[str], tag: str = "source") -> DataFrame:
    """Add 'existing' or 'new': whether the key is done."""
    known = done.select(*key).distinct().withColumn("_known", F.lit(True))
    return items.join(known, list(key), "left").withColumn(tag, F.when(F.col("_known"), "existing").otherwise("new")).drop("_known")


def whole_groups(rows: DataFrame, group: Sequence[str], ok: str) -> DataFrame:
    """Rows of the groups all of whose rows are ok."""
    good = rows.groupBy(*group).agg(F.bool_and(ok).alias("_all")).where("_all").select(*group)
    return rows.join(good, list(group), "left_semi")


def split_rejects(rows: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and the others; null counts as failing."""
    passed = F.coalesce(ok, F.lit(False))
    return rows.where(passed), rows.where(~passed)


def coverage(names: DataFrame, listed: DataFrame, done: DataFrame, key: str, name: str) -> DataFrame:
    """Per key, how many items are listed and done: a full outer join of two counts; keys without a name get ''."""
    a = listed.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("")).alias(key)).agg(F.count(F.lit(1)).alias("listed"))
    b = done.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("")).alias(key)).agg(F.count(F.lit(1)).alias("scraped"))
    zero = F.lit(0).cast("long")
    both = a.join(b, key, "full").select(key, F.coalesce("listed", zero).alias("listed"), F.coalesce("scraped", zero).alias("scraped"))
    return both.join(names.select(F.col(key).cast("string").alias(key), F.col(name)), key, "left").select(key, F.coalesce(name, F.lit("")).alias(name), "listed", "scraped")


def with_total(rows: DataFrame, label: str, sums: Sequence[str]) -> DataFrame:
    """A last row with the sums, marked TOTAL in the label column and '' in other texts."""
    total = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in sums))
    return rows.unionByName(total.select(*(F.lit("TOTAL").alias(c) if c == label else (F.col(c) if c in sums else F.lit("").alias(c)) for c in rows.columns)))


def follow(edges: DataFrame, starts: DataFrame, most: int = 500) -> DataFrame:
    """Pages that are reached from each start (start) by the edges (src, dst), with their depth; a page is visited once a start, and `most` steps are taken at the utmost. A loop of joins; each round's lineage is cut."""
    edges = cut(edges.select("src", "dst"))
    reached = front = cut(starts.select("start", F.col("start").alias("page"), F.lit(0).alias("depth")))
    for depth in range(1, most + 1):
        following = front.join(edges, front["page"] == edges["src"]).select("start", F.col("dst").alias("page"), F.lit(depth).alias("depth")).distinct()
        front = cut(following.join(reached.select("start", "page"), ["start", "page"], "left_anti"))
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached
