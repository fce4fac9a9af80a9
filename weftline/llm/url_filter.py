"""URL allow and block rules by a sort-merge range join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.llm.common import saved, scratch

RULE = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("verdict", T.StringType())])

_ON_STACK = "array<struct<size:int,host_size:int,host:string,path:string,verdict:string>>"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z in lower case; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def reversed_key(host: Column) -> Column:
    """Labels from the last to the first, each ended by a dot: a host and its subdomains share a prefix, which is an interval of keys."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def rule_events(rules: DataFrame) -> DataFrame:
    """The boundaries of the rules' intervals in key order, each with the stack of rules that are active from there on.

    Intervals of hosts nest or are disjoint, so the stack after a host's start is the chain of its ancestors, and after its end the stack of its nearest ancestor.
    """
    own = (
        rules.where(F.col("host").isNotNull())
        .select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy(reversed_key(F.col("host")).alias("start"))
        .agg(F.collect_set(F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), "host", "path", "verdict")).alias("own"))
    )
    labels = F.size(F.split("start", "\\.")) - 1
    # each start with its prefixes of whole labels, the nearest first
    up = own.select("start", F.explode(F.expr("transform(sequence(1, size(split(start, '\\\\.')) - 1), n -> concat(substring_index(start, '.', n), '.'))")).alias("prefix"))
    chain = (
        up.join(own.withColumnRenamed("start", "prefix"), "prefix")
        .groupBy("start")
        .agg(F.sort_array(F.collect_list(F.struct(labels.alias("depth"), "prefix", "own"))).alias("chain"))
        .select("start", F.expr("flatten(transform(filter(chain, c -> c.prefix <= start), c -> c.own))").cast(_ON_STACK).alias("stack"), F.expr("flatten(transform(filter(chain, c -> c.prefix < start), c -> c.own))").cast(_ON_STACK).alias("below"))
    )
    end = F.concat(F.expr("substring(start, 1, length(start) - 1)"), F.lit("/"))  # the character after the dot
    return chain.select(F.col("start").alias("key"), "stack").unionByName(chain.select(end.alias("key"), F.col("below").alias("stack")))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """_id, host, path, rule, verdict of every row of pages.

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest rule (host and path) wins, then the longer host, then the larger text. Rows without a fitting rule get `otherwise`.

    Urls and the boundaries of the rules' intervals are dealt over `ranges` ranges of reversed-host keys (one per shuffle partition unless given), together: neither is sent twice. Urls of one host are told apart by a hash, so a host with a third of all rows has many ranges. A range's sweep begins with the stack of the last boundary before it, which is carried from range to range, a row each; from there the last boundary's stack is handed to each url.

    Cases: a null url, or one without ://, has an empty host and path and no rule. Null ids and repeated rows are judged like any other; a null path of a rule fits every path, a null host none. Empty tables give empty results, no rules give `otherwise`. Further columns of pages are not touched.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    url = F.coalesce(F.col("_url"), F.lit(""))
    found = (
        pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
        .select("_id", "_url", host_of(url).alias("host"), path_of(url).alias("path"))
        .select("_id", "host", "path", reversed_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.xxhash64("_id", "_url", F.monotonically_increasing_id()).alias("salt"), F.lit(None).cast(_ON_STACK).alias("stack"))
    )
    marks = rule_events(rules).select(F.lit(None).cast(pages.schema[id_col].dataType).alias("_id"), F.lit("").alias("host"), F.lit("").alias("path"), "key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("salt"), "stack")
    with scratch(spark) as kept:
        order = ["key", "kind", "salt"]
        events = kept(saved(found.unionByName(marks).repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "events"))
        ends = events.groupBy("range").agg(F.max_by(F.when(F.col("kind") == 0, F.col("stack")), F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
        before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
        carried = kept(saved(ends.select("range", F.last("last", ignorenulls=True).over(before).alias("carry")), "carried"))
    sweep = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("own", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1").join(carried, "range").withColumn("active", F.coalesce("own", "carry"))
    best = F.expr("array_max(filter(coalesce(active, array()), r -> startswith(path, r.path)))")
    return swept.withColumn("best", best).select(
        "_id",
        "host",
        "path",
        F.when(F.col("best").isNotNull(), F.concat("best.host", "best.path")).alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) as a DataFrame, made by SQL alone."""
    if not rules:
        return spark.range(0).select(*(F.lit("").alias(c) for c in ("host", "path", "verdict")))
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))
