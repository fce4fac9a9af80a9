"""Records: two parsed pages to one wide row, with where each English value comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import cell_text, iso_now, strip
from weftline.functions.vocabulary import RECORD_COLUMNS, TEXT_FIELDS
from weftline.operators.dedupe import numeric_then_text


def _blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def aligned_captions(ours: Column, theirs: Column) -> Column:
    """Our photos' captions with those of the same photo file on the other page; of several there the last counts."""

    def pair(g: Column) -> Column:
        same = F.filter(theirs, lambda t: t["photo"] == g["photo"])
        return F.struct(_blank(g["caption"]).alias("caption_ta"), _blank(F.get(same, F.size(same) - 1)["caption"]).alias("caption_en"))

    return F.transform(F.coalesce(ours, F.array().cast("array<struct<photo:string,url:string,thumb:string,caption:string>>")), pair)


def provenance(value: Column) -> Column:
    return F.when(_blank(value) != "", "site").otherwise("")


def assemble(items: DataFrame, tamil: DataFrame, english: DataFrame) -> DataFrame:
    """Wide records of items (temple_id, district_id, district_name) from their parsed pages (temple_id, page): a join with the Tamil page, and a left join with the English one, which counts only if it was found."""
    def side(parsed: DataFrame, name: str, counts: Column) -> DataFrame:
        """What a record has of one page, as columns: what isn't asked for isn't joined."""
        have = {f: F.col("page.fields")[f] for f in TEXT_FIELDS} | {c: F.col(f"page.{c}") for c in ("category_id", "latitude", "longitude", "gallery", "nearby", "extra")}
        return parsed.select("temple_id", counts.alias(f"_{name}"), *(F.when(counts, c).alias(f"_{name}_{k}") for k, c in have.items()))

    pages = items.join(side(tamil, "ta", F.lit(True)), "temple_id").join(side(english, "en", F.coalesce("page.found", F.lit(False))), "temple_id", "left")
    texts = []
    for f in TEXT_FIELDS:
        of_en = _blank(F.col(f"_en_{f}"))
        texts += [_blank(F.col(f"_ta_{f}")).alias(f"{f}_ta"), of_en.alias(f"{f}_en"), provenance(of_en).alias(f"{f}_source_en")]
    list_type, map_type = "array<string>", "map<string,string>"
    return pages.select(
        "temple_id",
        _blank(F.col("district_id")).alias("district_id"),
        _blank(F.col("district_name")).alias("district_name"),
        F.when(F.col("_en"), "yes").otherwise("no").alias("english_page"),
        *texts,
        *(_blank(F.col(f"_ta_{c}")).alias(c) for c in ("category_id", "latitude", "longitude")),
        aligned_captions(F.col("_ta_gallery"), F.col("_en_gallery")).alias("gallery"),
        F.coalesce("_ta_nearby", F.array().cast(list_type)).alias("nearby_ta"),
        F.coalesce("_en_nearby", F.array().cast(list_type)).alias("nearby_en"),
        F.coalesce("_ta_extra", F.create_map().cast(map_type)).alias("extra_ta"),
        F.coalesce("_en_extra", F.create_map().cast(map_type)).alias("extra_en"),
        iso_now().alias("scraped_at"),
    )


def nested_text(x: Column) -> Column:
    """A list or map as compact JSON; '' if it is empty or null."""
    return F.when(F.size(x) > 0, F.to_json(x)).otherwise("")


def flat(records: DataFrame) -> DataFrame:
    """The columns of a record in order of export, all as text."""
    have = dict(records.dtypes)
    out = []
    for c in RECORD_COLUMNS:
        if c not in have:
            out.append(F.lit("").alias(c))
        elif have[c].startswith(("array", "map")):
            out.append(nested_text(F.col(c)).alias(c))
        else:
            out.append(_blank(F.col(c).cast("string")).alias(c))
    return records.select(*out)


def export_order(records: DataFrame) -> DataFrame:
    """By region, then item: numbers by value, then other text."""
    return records.orderBy(*numeric_then_text("district_id"), *numeric_then_text("temple_id"))


def cells(rows: DataFrame) -> DataFrame:
    """All columns as spreadsheet cells."""
    return rows.select(*(cell_text(F.col(c)).alias(c) for c in rows.columns))


def missing_english(records: DataFrame, key: str = "temple_id") -> DataFrame:
    """(key, field, ta) of each text field that has Tamil text and no English; fields are turned to rows in one pass."""
    have = set(records.columns)
    fields = [f for f in TEXT_FIELDS if {f"{f}_ta", f"{f}_en", f"{f}_source_en"} <= have]
    if not fields:
        raise ValueError("records have no text field")
    one = [F.struct(F.lit(f).alias("field"), F.col(f"{f}_ta").alias("ta"), F.col(f"{f}_en").alias("en")) for f in fields]
    return records.select(key, F.inline(F.array(*one))).where((strip(_blank(F.col("ta"))) != "") & (_blank(F.col("en")) == "")).select(key, "field", "ta")


def write_back(records: DataFrame, english: DataFrame, key: str = "temple_id") -> DataFrame:
    """Records with translations (key, field, en) in the fields that lack English, marked 'machine'; other fields stay."""
    have = set(records.columns)
    fields = [f for f in TEXT_FIELDS if {f"{f}_ta", f"{f}_en", f"{f}_source_en"} <= have]
    by_field = english.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", "en"))).alias("_en"))
    joined = records.join(by_field, key, "left")
    for f in fields:
        got = F.col("_en")[f]
        joined = joined.withColumns({f"{f}_source_en": F.when(got.isNotNull(), "machine").otherwise(F.col(f"{f}_source_en")), f"{f}_en": F.coalesce(got, F.col(f"{f}_en"))})
    return joined.select(*records.columns)
