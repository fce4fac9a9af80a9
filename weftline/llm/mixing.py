"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm.common import saved, scratch, text_of

#: Documents that share a cell of a leaf's order, about; only one cell of a leaf is summed document by document.
CELL_ROWS = 4096


def tokens_of(text: Column) -> Column:
    """Words, that is runs without ASCII whitespace."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def weight_of(name: Column, weights: dict[str, int], otherwise: int) -> Column:
    out = F.lit(otherwise)
    for k, w in weights.items():
        out = F.when(name == k, F.lit(w)).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add _got: what each child gets of its parent's _budget by weight _w, at most its _cap.

    Children in the order of cap to weight: the first ones are full as long as their share of what is left is their cap or more, and what they lack goes to their siblings in proportion to weight. Whole tokens that rounding leaves go to the first unfilled siblings, one each. Children of weight 0 get nothing.
    """
    whole = "decimal(19,0)"
    by = Window.partitionBy(*parent)
    order = by.orderBy((F.col("_cap").cast("double") / F.col("_w")).asc_nulls_last(), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    live = children.where("_w > 0 and _cap > 0")
    steps = (
        live.withColumn("_full_before", F.coalesce(F.sum("_cap").over(before), F.lit(0).cast("long")))
        .withColumn("_w_left", F.sum("_w").over(by) - F.coalesce(F.sum("_w").over(before), F.lit(0).cast("long")))
        .withColumn("_full", F.col("_cap").cast(whole) * F.col("_w_left").cast(whole) <= F.col("_w").cast(whole) * (F.col("_budget") - F.col("_full_before")).cast(whole))
        .withColumn("_rest", F.col("_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(by), F.lit(0).cast("long")))
        .withColumn("_w_open", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(by))
        .withColumn("_share", F.when(F.col("_full"), F.col("_cap")).otherwise(F.expr(f"(cast(_w as {whole}) * cast(greatest(_rest, 0) as {whole})) div cast(_w_open as {whole})")))
        .withColumn("_odd", F.col("_rest") - F.sum(F.when(~F.col("_full"), F.col("_share"))).over(by))
        .withColumn("_rank", F.row_number().over(by.orderBy("_full", name)))
    )
    got = F.col("_share") + F.when(~F.col("_full") & (F.col("_rank") <= F.col("_odd")), 1).otherwise(0)
    return steps.withColumn("_got", got).drop("_full_before", "_w_left", "_full", "_rest", "_w_open", "_share", "_odd", "_rank")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: Callable[[Column], Column], default_weight: int = 1) -> DataFrame:
    """The leaves (levels, _cap in tokens) with _got, their part of the budget (given the sum of all caps), propagated from the root.

    A node's capacity is that of its leaves with a weight, so a shortage goes to siblings first; what a whole level lacks goes to the siblings of the ancestors.
    """
    tree = leaves
    for c in levels:
        tree = tree.withColumn(f"_w_{c}", weight_of(F.col(c), weights.get(c, {}), default_weight))
    live = tree.where(" and ".join(f"_w_{c} > 0" for c in levels))
    above: DataFrame | None = None
    for depth, c in enumerate(levels):
        keys = levels[: depth + 1]
        nodes = live.groupBy(*keys).agg(F.sum("_cap").alias("_cap"), F.max(f"_w_{c}").alias("_w"))
        if above is None:
            nodes = nodes.withColumn("_root", F.lit(0))
            total = F.sum("_cap").over(Window.partitionBy("_root"))
            nodes = nodes.withColumn("_budget", F.least(budget(total), total))
        else:
            nodes = nodes.join(above.select(*levels[:depth], F.col("_got").alias("_budget")), levels[:depth])
        above = share_out(nodes, levels[:depth] or ["_root"], c).drop("_root")
    assert above is not None
    return above.select(*levels, "_got")


def mix(
    docs: DataFrame,
    levels: list[tuple[str, Column]],
    weights: dict[str, dict[str, int]],
    budget_share: float = 0.5,
    max_epochs: int = 2,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The selected documents, a row for each epoch that a document is in: _id, the levels, n_tokens, epoch (from 0).

    The budget, `budget_share` of all tokens, goes down the tree of the levels (name, expression) by integer weights; children without a listed weight have weight 1. A leaf holds `max_epochs` times its tokens at most. It gives whole epochs first, then a prefix of one more: documents in the order of an MD5 of seed, epoch and id, until the tokens reach what is left; the document that reaches it is in.

    A leaf with a third of all rows is no hot group: its order is cut into cells by the leading digits of the hash, the cells are summed before the shuffle, and only the one cell in which the prefix ends is summed id by id. Rows that share an id and a number of tokens are counted first, so an id (or null) with a third of all rows isn't a hot cell either. The table of leaves is written and read again, so Spark broadcasts it only where its known size allows.

    Cases: null texts have no tokens; null levels are a leaf named ''. Null ids share one place in the order, ties are broken by the number of tokens, and rows that repeat an id and text are documents of their own. Leaves without tokens or with weight 0 give nothing. Weights without rows have no effect. An empty table gives an empty table; other columns are not touched.
    """
    names = [n for n, _ in levels]
    rows = docs.select(F.col(id_col).alias("_id"), *(F.coalesce(x.cast("string"), F.lit("")).alias(n) for n, x in levels), tokens_of(text_of(text_col)).alias("n_tokens"))
    with scratch(docs.sparkSession) as kept:
        rows = kept(saved(rows, "tokens"))
        leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("_all"), F.count(F.lit(1)).alias("_rows"))
        leaves = saved(leaves, "leaves")
        got = leaf_budgets(leaves.select(*names, (F.col("_all") * max_epochs).alias("_cap")), names, weights, lambda caps: F.floor(caps / max_epochs * F.lit(budget_share)).cast("long"))
        plan = leaves.join(got, names).where("_all > 0")
        plan = plan.select(
            *names,
            F.expr("cast(_got div _all as int)").alias("_whole"),
            (F.col("_got") % F.col("_all")).alias("_left"),
            F.least(F.lit(8), F.greatest(F.lit(0), F.ceil(F.log(F.col("_rows") / F.lit(float(CELL_ROWS))) / F.log(F.lit(16.0))))).cast("int").alias("_digits"),
        )
        plan = kept(saved(plan, "plan"))
        placed = rows.join(plan, names)
        key = F.md5(F.concat_ws(":", F.lit(seed), F.col("_whole").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"))
        partial = placed.where("_left > 0").withColumn("_key", key).withColumn("_cell", F.expr("substring(_key, 1, _digits)"))
        cells = partial.groupBy(*names, "_cell").agg(F.sum("n_tokens").alias("_sum"))
        running = Window.partitionBy(*names).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cells = kept(saved(cells.withColumn("_until", F.sum("_sum").over(running)).withColumn("_from", F.col("_until") - F.col("_sum")), "cells"))
    whole = placed.where("_whole > 0").select("_id", *names, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)).alias("epoch"))
    begun = partial.join(cells.select(*names, "_cell", "_from", "_until"), [*names, "_cell"]).where("_from < _left")
    inside = begun.where("_until <= _left")
    # rows of one id and length are alike, so they are counted before they are ordered: an id with a third of all rows is a few rows here
    alike = begun.where("_until > _left").groupBy(*names, "_whole", "_left", "_from", "_cell", "_key", "_id", "n_tokens").agg(F.count(F.lit(1)).alias("_c"))
    within = Window.partitionBy(*names, "_cell").orderBy("_key", "_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = alike.withColumn("_room", F.col("_left") - F.col("_from") - F.coalesce(F.sum(F.col("n_tokens") * F.col("_c")).over(within), F.lit(0).cast("long"))).where("_room > 0")
    fits = F.when(F.col("n_tokens") == 0, F.col("_c")).otherwise(F.least(F.col("_c"), F.expr("(_room + n_tokens - 1) div n_tokens")))
    edge = edge.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), fits)))
    columns = ["_id", *names, "n_tokens", F.col("_whole").alias("epoch")]
    return whole.unionByName(inside.select(*columns)).unionByName(edge.select(*columns))
