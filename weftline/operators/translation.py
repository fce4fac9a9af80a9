"""Translation of texts around an injected model: lines, sentences, pieces; only what the cache lacks is translated."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weftline.functions.scoring import split_long
from weftline.functions.text import apply_glossary, apply_rules, content_hash, has_tamil, sentences, strip
from weftline.functions.vocabulary import GLOSSARY
from weftline.operators.lineage import cut


class Model(Protocol):
    """A translation model. It is built on the executors, once a worker, by the factory that is given."""

    name: str

    def count_tokens(self, text: str) -> int: ...

    def translate(self, texts: list[str]) -> list[str]: ...


@dataclass(frozen=True)
class Options:
    """Device, batch and beams default by device, as the usual models like them."""

    batch_size: int = 4
    beams: int = 2
    max_tokens: int = 200
    glossary: dict[str, dict[str, str]] = field(default_factory=lambda: GLOSSARY)

    @classmethod
    def on(cls, device: str, **more) -> Options:
        return cls(**({"batch_size": 32, "beams": 4} if device == "cuda" else {}) | more)


def first_available(*factories: Callable[[], Model]) -> Callable[[], Model]:
    """A factory that tries the others in turn."""

    def make() -> Model:
        errors = []
        for factory in factories:
            try:
                return factory()
            except (ImportError, OSError, RuntimeError) as e:
                errors.append(e)
        raise RuntimeError(f"no model could be loaded: {errors}")

    return make


_LOADED: dict[str, Model] = {}


def name_of(factory: Callable[[], Model]) -> str:
    """A stable name: factories that pickle alike make the same model."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def _model(name: str, factory: Callable[[], Model]) -> Model:
    """The worker's model of that name, loaded once."""
    if name not in _LOADED:
        _LOADED[name] = factory()
    return _LOADED[name]


def plan_lines(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, line_no, line, copy): lines without Tamil are copied, trimmed."""
    lines = texts.select(*key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.select(*key, "line_no", F.when(has_tamil(F.col("line")), F.col("line")).otherwise(strip(F.col("line"))).alias("line"), (~has_tamil(F.col("line"))).alias("copy"))


def plan_pieces(lines: DataFrame, key: list[str], factory: Callable[[], Model], options: Options) -> DataFrame:
    """(key, line_no, piece_no, piece, h) of the lines to translate. The glossary is applied to the whole line first; only sentences that may be too long go to Python."""
    found = lines.where("not copy").select(*key, "line_no", F.explode(F.transform(sentences(apply_glossary(F.col("line"), options.glossary["pre"])), lambda s, i: F.struct(i.alias("s_no"), s.alias("s")))).alias("x")).select(*key, "line_no", "x.s_no", "x.s")

    name = name_of(factory)

    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(name, factory)
        counts: dict[str, int] = {}

        def count(text: str) -> int:
            if len(counts) > 100_000:
                counts.clear()
            if text not in counts:
                counts[text] = model.count_tokens(text)
            return counts[text]

        for batch in batches:
            yield batch.map(lambda s: split_long(s, count, options.max_tokens))

    split.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    pieces = found.withColumn("_p", F.pandas_udf(split, T.ArrayType(T.StringType()))("s")).select(*key, "line_no", "s_no", F.posexplode("_p").alias("p_no", "piece"))
    return pieces.select(*key, "line_no", F.struct("s_no", "p_no").alias("piece_no"), "piece", content_hash(F.col("piece")).alias("h"))


def pending_pieces(pieces: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct pieces that the cache lacks (h, piece)."""
    return pieces.select("h", "piece").distinct().join(cache.select("h"), "h", "left_anti")


def translate_pieces(pieces: DataFrame, factory: Callable[[], Model], options: Options) -> DataFrame:
    """(h, en, m) of pieces (h, piece): pieces of like length meet in batches of the model's size."""
    size, name = options.batch_size, name_of(factory)
    ordered = pieces.repartitionByRange(F.length("piece"), "piece").sortWithinPartitions(F.length("piece"), "piece")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(name, factory)
        for batch in batches:
            out: list[str] = []
            texts = batch["piece"].tolist()
            for i in range(0, len(texts), size):
                out += [t.strip() for t in model.translate(texts[i : i + size])]
            yield pd.DataFrame({"h": batch["h"], "en": out, "m": model.name})

    return ordered.mapInPandas(run, "h string, en string, m string")


def reassemble(lines: DataFrame, pieces: DataFrame, cache: DataFrame, key: list[str], options: Options) -> DataFrame:
    """(key, en): pieces joined by spaces in order, lines by line breaks, copied lines included, two blank lines at most, then the rules."""
    done = pieces.join(cache.select("h", "en"), "h")
    joined = done.groupBy(*key, "line_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece_no", "en"))), lambda x: x["en"]), " ").alias("_en"))
    whole = lines.join(joined, [*key, "line_no"], "left").select(*key, "line_no", F.when(F.col("copy"), F.col("line")).otherwise(F.coalesce("_en", F.lit(""))).alias("_line"))
    text = whole.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "_line"))), lambda x: x["_line"]), "\n").alias("en"))
    tidy = strip(F.regexp_replace("en", "\\n{3,}", "\n\n"))
    return text.withColumn("en", apply_rules(tidy, options.glossary["post"]))


@dataclass
class Translated:
    english: DataFrame
    new_entries: DataFrame


def translate(texts: DataFrame, key: list[str], text: str, cache: DataFrame, factory: Callable[[], Model], options: Options | None = None) -> Translated:
    """English of each text, and the entries to append to the cache. Write new_entries before english is used, so that no piece is translated twice; rows of the cache must be one a hash (see latest_entries)."""
    options = options or Options()
    lines = plan_lines(texts, key, text)
    pieces = plan_pieces(lines, key, factory, options)
    new = translate_pieces(pending_pieces(pieces, cache), factory, options)
    return Translated(reassemble(lines, pieces, cache.select("h", "en").unionByName(new.select("h", "en")), key, options), new)


def latest_entries(rows: DataFrame, order: str) -> DataFrame:
    """The cache of an append-only log: the last entry of each hash; rows without a hash or text don't count."""
    return rows.where("h is not null and en is not null").groupBy("h").agg(F.max_by("en", order).alias("en"))


def glossary_of(overrides: dict[str, dict[str, str]] | None) -> dict[str, dict[str, str]]:
    """The default glossary with a file's entries over it, section by section."""
    return {section: {**GLOSSARY[section], **((overrides or {}).get(section) or {})} for section in GLOSSARY}


def load_glossary(path: str | None) -> dict[str, dict[str, str]]:
    """The default glossary with the entries of a JSON file ({"pre": ..., "post": ...}) over it; a missing file changes nothing."""
    return glossary_of(json.loads(Path(path).read_text(encoding="utf-8")) if path and Path(path).exists() else None)


def translation_stats(jobs: DataFrame, key: str) -> DataFrame:
    return jobs.agg(F.count_distinct(key).alias("temples"), F.count(F.lit(1)).alias("fields"))


def batch_number(df: DataFrame, text: str, size: int) -> DataFrame:
    """Number the batches of a length-sorted table. Ranges of (length, text) are sorted apart and written; a row's place is its range's start and its place in the range, so a common length is no hot group."""
    ordered = cut(df.withColumn("_n", F.length(text)).repartitionByRange("_n", text).sortWithinPartitions("_n", text).drop("_n"))
    # what is written keeps its partitions: the identifier counts rows in its lower 33 bits
    placed = ordered.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))  # a row for each range
    starts = sizes.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(starts, "_p").withColumn("batch", F.floor((F.col("_before") + F.col("_i")) / size)).drop("_p", "_i", "_before")
