"""What the operators share: table access, the shared folder, bounded samples."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a Python stage turns into arrays at a time.
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def one_of_each(docs: DataFrame, rows: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """The rows of docs that stay, with all their columns: one for each id and digest of the text of those of rows (_id, _digest, _stays; a row for each of docs) that stay. A verdict is about a row: rows may share an id, and rows that share id and text are told apart by nothing, so any one of them stays."""
    name = "_digest_of_row"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    marked = docs.withColumn(name, digest)
    # only what isn't simply kept is joined: few rows in a corpus of few copies
    judged = rows.groupBy("_id", "_digest").agg(F.max("_stays").alias("_stays"), F.count(F.lit(1)).alias("_n")).where("not _stays or _n > 1")

    def joined(of: DataFrame, how: str) -> DataFrame:
        return marked.join(of, marked[id_col].eqNullSafe(of["_id"]) & (marked[name] == of["_digest"]), how)

    out = joined(judged, "left_anti")
    repeated = judged.where("_stays")
    if repeated.limit(1).count():
        out = out.unionByName(joined(repeated, "left_semi").dropDuplicates([id_col, name]))
    return out.drop(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local one on a local master, as in tests; a cluster must set it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Tables that were saved outside any scratch(), and those saved inside the innermost one of this thread.
_TABLES: list[str] = []
_SCOPE: ContextVar[list[str]] = ContextVar("tables", default=_TABLES)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read it again, so that a lost executor costs no recomputation.

    The table lives until a scratch() around it ends, or until clean_up().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _SCOPE.get().append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that are saved inside, by this thread, when it ends, but for those handed to the function that it gives: these belong to the scratch() around it."""
    made: list[str] = []
    keep: set[str] = set()
    around = _SCOPE.get()
    token = _SCOPE.set(made)

    def kept(df: DataFrame) -> DataFrame:
        keep.add(df._saved_at)
        return df

    try:
        yield kept
    finally:
        _SCOPE.reset(token)
        around += [p for p in made if p in keep]
        _delete(spark, [p for p in made if p not in keep])


def drop_saved(df: DataFrame) -> None:
    """Delete a table that was saved by this thread, once nothing reads it any more."""
    _SCOPE.get().remove(df._saved_at)
    _delete(df.sparkSession, [df._saved_at])


def clean_up(spark: SparkSession) -> None:
    """Delete all tables that operators have saved in this process and that results may still read; these results are gone too."""
    _delete(spark, _TABLES)
    _TABLES.clear()


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more, before the next large one is written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive (start, end) with about `most` characters each, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def crc_of_id(col: str) -> Column:
    """crc32 of the id's decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    eligible: Column,
    per_class: int,
    max_chars: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[tuple[str, int]]:
    """A bounded, deterministic sample of labelled rows: about `per_class` texts of each class, at most twice that, each of `max_chars` or fewer.

    Rows are taken by a hash of the id below a threshold that follows from the counts; ids with null labels are not labelled. Where an id has several labels, the largest counts. The sample is never more than 4 * per_class * max_chars characters.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label).cast("int")).alias("_y"))
        .withColumn(id_col, F.col("_id"))
        .where(eligible)
        .drop(id_col)
    )
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for y in (0, 1):
        share = F.when(F.col("_y") == y, F.lit(min(1.0, 1.25 * per_class / max(1, counts.get(y, 0))))).otherwise(share)
    at = F.pmod(F.xxhash64(F.col("_id"), F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(at < share).limit(4 * per_class)
    rows = (
        docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))
        .where(F.length("_t") <= max_chars)
        .join(F.broadcast(picked), "_id")
        .groupBy(F.sha2("_t", 256).alias("_d"))
        .agg(F.min(F.struct("_id", "_t", "_y")).alias("r"))
        .select("r._id", "r._t", "r._y")
        .limit(4 * per_class)
        .collect()
    )
    return [(r["_t"], int(r["_y"])) for r in sorted(rows, key=lambda r: (r["_id"], r["_t"]))]
