"""The corpus pipeline: five stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm.common import crc_of_id, drop_saved, saved, scratch, table
from weftline.llm.decontaminate import drop_leaks
from weftline.llm.exact_dedup import drop_copies
from weftline.llm.near_dedup import drop_near_copies
from weftline.llm.queries import mixed
from weftline.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7; the model is learnt from the labelled ones among docs that the operator's query learns from."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels"), crc_of_id("doc_id") % 3 != 1), threshold=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id."""
    return drop_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the one with the smallest doc_id."""
    return drop_near_copies(docs, threshold=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover no benchmark item to 0.8."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The selected documents and epochs by the production weights."""
    return mixed(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminate), ("mixing", mixing)]

#: Toxicity, near copies and tiling can't be expressed in SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents; each one's rows are written to the shared folder before the next reads them, and deleted when the next one's are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as kept:
            docs = kept(saved(stage(spark, docs, sf_dir), f"stage-{name}"))
        if before is not None:
            drop_saved(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
