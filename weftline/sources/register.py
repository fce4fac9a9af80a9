"""The register: lines of a printed list to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions.scoring import repair_all, repair_text
from weftline.functions.text import strip
from weftline.operators.dedupe import keep_first

#: A serial of any length, and a number of six digits, or of more if it has no zero before it and ends at a space: a name may follow six digits at once.
_ROW = "^\\s*([0-9]+)\\s+(TM(?:[1-9][0-9]{6,}(?=\\s)|[0-9]{6}))\\s*(.*)$"


def read_register(lines: DataFrame) -> DataFrame:
    """Rows (tm, tid, raw, page, pincode, rest, name_raw, places_raw, name, places, reg_ord) of lines (page, line_no, line).

    A line with a serial and a TM number begins a row; other lines go on with it unless they are blank, have 'TM0' in them or begin with 'Generated on'. Of repeated numbers the first row counts. A row that goes on over the end of a page is joined: rows are numbered page by page, and a page's first lines belong to the last row of the nearest page that has one, so no page waits for another and no task has all lines.
    """
    line = F.regexp_replace("line", "\\r", "")
    found = lines.select("page", "line_no", line.alias("line")).withColumns({"tm": F.nullif(F.regexp_extract("line", _ROW, 2), F.lit("")), "text": F.regexp_extract("line", _ROW, 3)})
    goes_on = F.col("tm").isNull() & (strip(F.col("line")) != "") & ~F.contains("line", F.lit("TM0")) & ~F.startswith("line", F.lit("Generated on"))
    kept = found.where(F.col("tm").isNotNull() | goes_on).withColumn("text", strip(F.coalesce(F.when(F.col("tm").isNotNull(), F.col("text")), F.col("line"))))
    within = Window.partitionBy("page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = kept.withColumn("k", F.sum(F.when(F.col("tm").isNotNull(), 1).otherwise(0)).over(within))
    # pages in order, one row each: what the lines before a page's first row belong to
    starts = placed.groupBy("page").agg(F.max("k").alias("last"))
    before = Window.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.select("page", F.last(F.when(F.col("last") > 0, F.struct(F.col("page").alias("p"), F.col("last").alias("k"))), ignorenulls=True).over(before).alias("carry"))
    owned = placed.join(carried, "page").withColumn("owner", F.when(F.col("k") > 0, F.struct(F.col("page").alias("p"), F.col("k").alias("k"))).otherwise(F.col("carry"))).where("owner is not null")
    rows = owned.groupBy("owner").agg(
        F.max("tm").alias("tm"),
        F.transform(F.sort_array(F.collect_list(F.struct("page", "line_no", "text"))), lambda x: x["text"]).alias("texts"),
    )
    head = "^(.*?)\\s*-\\s*(6[0-9]{5})\\b(.*)$"
    raw = rows.select("tm", F.col("owner.p").alias("page"), F.col("owner.k").alias("place"), strip(F.array_join(F.filter("texts", lambda t: t != ""), " ")).alias("raw"))
    raw = keep_first(raw, ["tm"], ["page", "place"])
    parts = F.filter(F.transform(F.split(F.when(F.col("raw").rlike(head), F.regexp_extract("raw", head, 1)).otherwise(F.col("raw")), ","), strip), lambda p: p != "")
    cut = raw.withColumn("_parts", parts)
    return cut.select(
        "tm",
        F.substr("tm", F.lit(3)).cast("int").alias("tid"),
        "raw",
        "page",
        F.regexp_extract("raw", head, 2).alias("pincode"),
        strip(F.regexp_extract("raw", head, 3)).alias("rest"),
        F.coalesce(F.get("_parts", F.lit(0)), F.lit("")).alias("name_raw"),
        F.slice("_parts", 2, F.greatest(F.size("_parts") - 1, F.lit(0))).alias("places_raw"),
        (F.col("page").cast("long") * 1_000_000 + F.col("place")).alias("reg_ord"),
    ).withColumns({"name": repair_text("name_raw"), "places": repair_all("places_raw")})


def register_table(register: DataFrame) -> DataFrame:
    """The register as it is published: seven columns, in its order."""
    return register.orderBy("reg_ord").select(
        F.col("tm").alias("hrce_no"),
        "tid",
        "name",
        F.array_join("places", ", ").alias("place"),
        "pincode",
        repair_text("rest").alias("district_and_office"),
        "page",
    )


def pdf_lines(path: str) -> list[tuple[int, int, str]]:
    """(page, line_no, line) of a PDF; needs pypdfium2, which is optional."""
    import pypdfium2

    pdf = pypdfium2.PdfDocument(path)
    return [(p + 1, n, line) for p in range(len(pdf)) for n, line in enumerate(pdf[p].get_textpage().get_text_range().replace("\r", "").split("\n"))]
