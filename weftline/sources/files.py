"""Readers and writers of the files that stages hand on."""

from __future__ import annotations

import csv
import io
import json
import os
import zipfile
from collections.abc import Iterable
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import collapse, iso_now
from weftline.operators.records import cells

S = T.StringType()


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


INDEX = strings("district_id", "district_name", "temple_id", "temple_name")
CATEGORY = strings("category_no", "category_name", "temple_id", "temple_name", "source")
CACHE = strings("h", "en", "m")
SPECIALITY = T.ArrayType(strings("kind", "heading"))
SECOND = T.StructType([T.StructField("temple_id", S), T.StructField("tid", T.IntegerType()), *(T.StructField(n, S) for n in ("hrce_title", "hrce_title_ta", "hrce_no", "history_ta")), T.StructField("speciality", SPECIALITY), T.StructField("read_at", S)])


def record_schema() -> T.StructType:
    from weftline.functions.vocabulary import RECORD_COLUMNS

    kinds = {"gallery": T.ArrayType(strings("caption_ta", "caption_en")), "nearby_ta": T.ArrayType(S), "nearby_en": T.ArrayType(S), "extra_ta": T.MapType(S, S), "extra_en": T.MapType(S, S)}
    return T.StructType([T.StructField(c, kinds.get(c, S)) for c in RECORD_COLUMNS])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system is there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = True) -> DataFrame:
    """CSV with a header, with or without a byte order mark; quotes are doubled and fields may hold line breaks. A missing file is an empty table."""
    if missing_ok and not exists(spark, path):
        return empty(spark, schema)
    rows = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', quote='"', enforceSchema=True, encoding="UTF-8", nullValue=None, emptyValue="")
    return rows.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) if rows.schema[c].dataType == S else F.col(c) for c in rows.columns))


def recover(spark: SparkSession, path: str) -> None:
    """Put back what a replacement that died between its two renames has set aside."""
    jvm = spark.sparkContext._jvm
    at, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.old")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at) and fs.exists(aside):
        fs.rename(aside, at)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a JSON-lines file, and what could not be read (_corrupt_record). Lines end at a line feed only. Strict reading fails at the first bad line. With `order`, rows get their place: by the time and path of their file, then within it."""
    recover(spark, path)
    if not exists(spark, path):
        none = empty(spark, schema)
        return none if order is None else none.withColumn(order, F.lit(0)), empty(spark, strings("_corrupt_record"))
    lines = spark.read.option("lineSep", "\n").text(path).where("trim(value) <> ''")
    if order is not None:
        lines = lines.withColumn(order, F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))
    kept = [] if order is None else [order]
    if strict:
        return lines.withColumn("_r", F.from_json("value", schema, {"mode": "FAILFAST"})).select("_r.*", *kept), empty(spark, strings("_corrupt_record"))
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", S)])
    rows = lines.withColumn("_r", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})).select("_r.*", *kept)
    return rows.where("_corrupt_record is null").drop("_corrupt_record"), rows.where("_corrupt_record is not null").select("_corrupt_record")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document: an array of rows, or one row."""
    return spark.read.schema(schema).json(path, multiLine=True) if exists(spark, path) else empty(spark, schema)


def linked(links: DataFrame) -> DataFrame:
    """Links with an id and a number in ASCII digits."""
    return links.where("coalesce(temple_id, '') <> '' and tid rlike '^[0-9]+$'")


def append(rows: DataFrame, path: str) -> None:
    """Append a batch as files of its own: a run that dies leaves no torn line, since files appear when the job commits."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def replace(rows: DataFrame, path: str) -> None:
    """Replace a JSON-lines dataset as a whole: written beside it, the old one set aside, the new one put in its place, the old one deleted. At every moment one of the two is whole, and a reader puts back an old one that was left aside."""
    spark = rows.sparkSession
    staged = f"{path}.new"
    recover(spark, path)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(staged)
    jvm = spark.sparkContext._jvm
    here, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, f"{path}.old"))
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if fs.exists(here) and not fs.rename(here, old):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(new, here):
        raise OSError(f"could not rename {staged} to {path}")
    fs.delete(old, True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a dataset, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def failures(rows: DataFrame, url: str, reason: str) -> DataFrame:
    """Rows of the failure log: time, url, reason on one line."""
    return rows.select(iso_now().alias("time"), F.col(url).alias("url"), collapse(F.col(reason)).alias("reason"))


def log_failures(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").csv(path, sep="\t", quote="", escape="")


def write_atomic(path: str | Path, data: bytes) -> None:
    """A small file of the driver, replaced at once."""
    staged = f"{path}.tmp"
    Path(staged).write_bytes(data)
    os.replace(staged, path)


def write_json(path: str | Path, value: object) -> None:
    write_atomic(path, json.dumps(value, ensure_ascii=False, indent=2).encode())


def export_csv(rows: DataFrame, path: str | Path) -> None:
    """One CSV file with a byte order mark, for spreadsheets. Rows stream through the driver, a partition at a time, and none is collected."""
    staged = f"{path}.tmp"
    with open(staged, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(rows.columns)
        out.writerows(["" if v is None else v for v in r] for r in rows.toLocalIterator(prefetchPartitions=True))
    os.replace(staged, path)


def csv_text(header: list[str], rows: Iterable[Iterable[object]], mark: bool = True) -> str:
    """A small CSV text; the byte order mark comes once, at creation."""
    out = io.StringIO(newline="")
    writer = csv.writer(out)
    writer.writerow(header)
    writer.writerows(rows)
    return ("\ufeff" if mark else "") + out.getvalue()


_SHEET = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
_BOOK = {
    "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


def export_xlsx(rows: DataFrame, path: str | Path, name: str = "records") -> None:
    """One sheet of text cells, without control characters and cut to what a cell may hold. Rows stream through the driver."""
    staged = f"{path}.tmp"
    with zipfile.ZipFile(staged, "w", zipfile.ZIP_DEFLATED) as book:
        for part, text in _BOOK.items():
            book.writestr(part, text.replace("{name}", escape(name)))
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
            sheet.write(_SHEET.encode())
            sheet.write(_row(rows.columns))
            for r in cells(rows).toLocalIterator(prefetchPartitions=True):
                sheet.write(_row(r))
            sheet.write(b"</sheetData></worksheet>")
    os.replace(staged, path)


def _row(values: Iterable[str]) -> bytes:
    return ("<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for v in values) + "</row>").encode("utf-8", "surrogatepass")


def summary_text(rows: DataFrame, columns: list[str]) -> str:
    """An aligned table of a few rows: first columns to the left, numbers to the right; '' for no rows."""
    found = [[str(v) for v in r] for r in rows.select(*columns).collect()]
    if not found:
        return ""
    widths = [max(len(c), *(len(r[i]) for r in found)) for i, c in enumerate(columns)]
    number = [all(r[i].isdigit() for r in found) for i in range(len(columns))]
    lines = [columns, *found]
    return "\n".join("  ".join(v.rjust(w) if n else v.ljust(w) for v, w, n in zip(line, widths, number)).rstrip() for line in lines)
