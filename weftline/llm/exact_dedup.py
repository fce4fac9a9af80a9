"""Exact dedup by a tree-merge of sorted digest runs. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import one_of_each, saved, scratch, text_of

#: A digest, and two further values that verify it: texts count as equal when SHA-256, length and xxHash64 all agree.
KEY = ["_sha", "_len", "_xx"]


def rounds_of(runs: int, fan_in: int) -> int:
    """How many rounds merge so many runs into one."""
    n = 0
    while fan_in**n < runs:
        n += 1
    return n


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    runs: int = 4096,
    fan_in: int = 8,
    normalise: Column | None = None,
) -> DataFrame:
    """Every row of docs (its id alone) with the class of its text.

    The documents are read once: id, digest and run of each row are written, and nothing else reads a text. Rows are dealt over `runs` runs, whatever their id and text. In round k, the runs whose k-th digit to the base `fan_in` differs alone are merged into the one whose digit is 0, as in a binomial tree: each run is sorted by digest before it is sent, runs that meet are merged in that order, and equal digests leave their smallest (or largest) identifier and their number. A run's digests are spread over all tasks, so that the last run needs no task that holds all of them. From the root the verdicts go down the same tree: a node has `fan_in` children at most, so no key of a join is hot, however large a group of copies is. Only digests that occur more than once go down. Each round's runs are written, which is what a lost executor falls back to.

    Returns _id, keep_id, group_size, kept, text_sha256.

    Cases: a null text is empty, and empty texts are equal to one another. Null ids never win against others; a group of null ids alone has keep_id null. Rows that repeat an id and text each count in group_size and share `kept`. An empty table gives an empty table. Other columns of docs, whatever their names, are not touched.
    """
    spark = docs.sparkSession
    text = text_of(text_col) if normalise is None else F.coalesce(normalise, F.lit(""))
    hashed = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).select(
        "_id",
        F.sha2("_t", 256).alias("_sha"),
        F.length("_t").alias("_len"),
        F.xxhash64("_t").alias("_xx"),
        # which run a row is in changes nothing; it is written, so it doesn't change either
        F.pmod(F.xxhash64(F.monotonically_increasing_id(), "_id"), F.lit(runs)).alias("_run"),
    )
    # the best of structs is found by sort-merge aggregation; null stands for no identifier
    best = F.max("_best") if keep == "largest" else F.min("_best")

    def merged(level: DataFrame, run: Column) -> DataFrame:
        return level.groupBy(*KEY, run.alias("_run")).agg(best.alias("_best"), F.sum("_n").alias("_n"))

    def receiver(k: int) -> Column:
        return F.col("_run") - F.floor(F.col("_run") / fan_in**k) % fan_in * fan_in**k

    with scratch(spark) as kept:
        rows = kept(saved(hashed, "digests"))
        own = rows.withColumns({"_best": F.when(F.col("_id").isNotNull(), F.struct("_id")), "_n": F.lit(1).cast("long")})
        levels = [saved(merged(own, F.col("_run")), "runs")]
        for k in range(rounds_of(runs, fan_in)):
            levels.append(saved(merged(levels[-1], receiver(k)), "runs"))
        verdict = levels[-1].where("_n > 1")
        for k in reversed(range(len(levels) - 1)):
            children = levels[k].select(*KEY, "_run", receiver(k).alias("_to"))
            verdict = children.join(verdict.withColumnRenamed("_run", "_to"), [*KEY, "_to"]).select(*KEY, "_run", "_best", "_n")
        verdict = kept(saved(verdict, "verdicts"))
    out = rows.join(verdict, [*KEY, "_run"], "left")
    size = F.coalesce("_n", F.lit(1).cast("long"))
    keep_id = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_best._id"))
    return out.select("_id", keep_id.alias("keep_id"), size.alias("group_size"), F.col("_id").eqNullSafe(keep_id).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row of docs for each text, with all its columns; cases as in exact_dedup. It has the smallest (or largest) id of its text, and no id only where no copy has one; of rows that repeat an id and text any one stays."""
    rows = exact_dedup(docs, id_col, text_col, keep).select("_id", F.col("text_sha256").alias("_digest"), F.col("kept").alias("_stays"))
    return one_of_each(docs, rows, id_col, F.sha2(text_of(text_col), 256))
