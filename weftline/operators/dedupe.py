"""Keep-first, keep-last and top-k by key. Order is data here: every function takes the columns that give it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

Order = Sequence[str | Column]


def _required(order: Order) -> list:
    if not order:
        raise ValueError("an order is needed: without one, any row could be kept")
    return list(order)


def _ranked(df: DataFrame, order: Order) -> Column:
    """What rows are compared by: the order, then all their columns (of maps, the sorted entries)."""
    at = [F.col(c) if isinstance(c, str) else c for c in _required(order)]
    every = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, MapType) else F.col(f.name) for f in df.schema]
    return F.struct(*(c.alias(f"_o{i}") for i, c in enumerate([*at, *every])))


def keep_first(df: DataFrame, key: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key, by aggregation: rows meet before the shuffle and no group is sorted. Rows that tie in the order are told apart by all their columns."""
    return df.groupBy(*(F.col(k).alias(f"_k_{k}") for k in key)).agg(F.min_by(F.struct(*df.columns), _ranked(df, order)).alias("_row")).select("_row.*")


def keep_last(df: DataFrame, key: Sequence[str], order: Order) -> DataFrame:
    """The last row of each key."""
    return df.groupBy(*(F.col(k).alias(f"_k_{k}") for k in key)).agg(F.max_by(F.struct(*df.columns), _ranked(df, order)).alias("_row")).select("_row.*")


def first_slot_first_value(df: DataFrame, key: Sequence[str], order: str, value: str) -> DataFrame:
    """Of each key, where it first appears, and the first value that isn't blank ('' if there is none)."""
    named = F.coalesce(F.col(value), F.lit("")) != ""
    return df.groupBy(*key).agg(F.min(order).alias(order), F.coalesce(F.min_by(F.when(named, F.col(value)), F.when(named, F.col(order))), F.lit("")).alias(value))


def top_k(df: DataFrame, key: Sequence[str], order: Order, k: int) -> DataFrame:
    """The first k rows of each key, with rank. Spark drops rows beyond k before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*_required(order))))
    return ranked.where(F.col("rank") <= k)


def best_two(df: DataFrame, key: Sequence[str], score: str, ties: Order) -> DataFrame:
    """The best row of each key, with runner_up: the second best score, 0.0 if there is none."""
    order = [F.col(score).desc(), *_required(ties)]
    second = F.lead(score).over(Window.partitionBy(*key).orderBy(*order))
    return top_k(df, key, order, 2).withColumn("runner_up", F.coalesce(second, F.lit(0.0))).where("rank = 1").drop("rank")


def numeric_then_text(col: str) -> list[Column]:
    """Sort keys: numbers by value first (blank is 0), then other text."""
    text = F.coalesce(F.col(col), F.lit(""))
    number = F.when(text == "", F.lit(0)).otherwise(F.expr(f"try_cast({col} as bigint)"))
    digits = text.rlike("^[0-9]*$")
    return [(~digits).cast("int"), F.when(digits, number).otherwise(F.lit(0)), F.when(digits, F.lit("")).otherwise(text)]
