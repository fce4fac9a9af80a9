"""What a second source says beside the first, and whether each link holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scoring import best_ratio, text_ratio
from weftline.functions.text import latin_skeleton, name_skeletons, pincode, skeleton, strip
from weftline.functions.vocabulary import EMPTY_HEADING, PRAYER, REMEDY, THEMES
from weftline.operators.dedupe import keep_last


def _blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _either_holds(a: Column, b: Column) -> Column:
    return F.contains(a, b) | F.contains(b, a)


def verify(rows: DataFrame) -> DataFrame:
    """Add check: confirmed or doubtful, from the other page's own Tamil title.

    Confirmed: the place is the same and a name nearly so, or the pincode is in the title and a name is the same to a letter or two.
    """
    title = _blank(F.col("hrce_title_ta"))
    parts = F.transform(F.split(F.split(title, " - ")[0], ","), strip)
    places = F.slice(F.col("_parts"), 2, F.greatest(F.size("_parts") - 1, F.lit(0)))
    latin_places = F.filter(places, lambda p: p.rlike("[A-Za-z]{3}"))
    rows = rows.withColumn("_parts", parts)
    rows = rows.withColumns(
        {
            "_their_name": skeleton(F.col("_parts")[0]),
            "_their_place": skeleton(F.array_join(places, " ")),
            "_their_latin": latin_skeleton(F.array_join(latin_places, " ")),
            "_names": name_skeletons(F.col("name_ta"), F.col("moolavar_ta")),
            "_town": skeleton(F.col("town_ta")),
            "_latin": latin_skeleton(F.col("town_en")),
            "_pin": pincode(F.col("address_ta"), F.col("address_en")),
        }
    )
    rows = rows.withColumns({"_name": best_ratio("_names", "_their_name"), "_near": text_ratio("_town", "_their_place"), "_near_latin": text_ratio("_latin", "_their_latin")})
    ours, theirs = F.col("_town"), F.col("_their_place")
    same_place = (theirs != "") & (F.length(ours) >= 3) & (_either_holds(ours, theirs) | (F.col("_near") >= 0.75))
    ours, theirs = F.col("_latin"), F.col("_their_latin")
    same_place |= (F.length(ours) >= 3) & (F.length(theirs) >= 3) & (_either_holds(ours, theirs) | (F.col("_near_latin") >= 0.75))
    same_pin = (F.col("_pin") != "") & F.contains(title, F.col("_pin"))
    good = (title != "") & ((same_place & (F.col("_name") >= 0.8)) | (same_pin & (F.col("_name") >= 0.95)))
    return rows.withColumn("check", F.when(good, "confirmed").otherwise("doubtful")).drop(*(c for c in rows.columns if c.startswith("_")))


def theme_state(ours: Column, theirs: Column, has_text: Column, pattern: str) -> Column:
    """'' if we don't name it; '?' if the other has no text; else yes or no."""
    return F.when(~ours.rlike(pattern), "").when(~has_text, "?").when(theirs.rlike(pattern), "yes").otherwise("no")


def headings(speciality: Column, kind: str) -> Column:
    """Headings of a kind that say something, joined."""
    kept = F.filter(speciality, lambda s: F.contains(s["kind"], F.lit(kind)) & ~s["heading"].rlike(EMPTY_HEADING))
    return F.array_join(F.transform(kept, lambda s: s["heading"]), "; ")


def two_source(check: Column, remedy: Column, shared: Column) -> Column:
    return F.when(check != "confirmed", "").when(remedy != "", "pariharam").when(shared != "", "theme").otherwise("")


def compare(records: DataFrame, second: DataFrame, links: DataFrame, themes: dict[str, str] | None = None) -> DataFrame:
    """One row per page of the second source whose record is known. Of repeated records and links the last counts (rec_ord, link_ord give the order)."""
    themes = THEMES if themes is None else themes
    ours = ["name_ta", "moolavar_ta", "town_ta", "town_en", "address_ta", "address_en", "prayers_ta", "speciality_ta", "special_features_ta"]
    rec = records.select("rec_ord", "temple_id", *((_blank(F.col(c)) if c in records.columns else F.lit("")).alias(c) for c in ours))
    rec = keep_last(rec, ["temple_id"], ["rec_ord"]).drop("rec_ord")
    known = keep_last(links.select("link_ord", "temple_id", "confidence"), ["temple_id"], ["link_ord"]).select("temple_id", F.col("confidence").alias("link"))
    empty = F.array().cast("array<struct<kind:string,heading:string>>")
    rows = second.withColumn("speciality", F.coalesce("speciality", empty)).join(rec, "temple_id").join(known, "temple_id", "left")
    said = F.concat(_blank(F.col("history_ta")), F.lit(" "), F.array_join(F.transform("speciality", lambda s: F.concat(s["kind"], F.lit(" "), s["heading"])), " "))
    rows = verify(rows).withColumns({"_said": said, "_ours": F.concat_ws(" ", "prayers_ta", "speciality_ta", "special_features_ta")})
    rows = rows.withColumn("_has", F.length(strip(F.col("_said"))) >= 40)
    rows = rows.withColumns({t: theme_state(F.col("_ours"), F.col("_said"), F.col("_has"), p) for t, p in themes.items()})
    rows = rows.withColumns({"hrce_pariharam": headings(F.col("speciality"), REMEDY), "hrce_prayer": headings(F.col("speciality"), PRAYER), "two_source_themes": F.concat_ws("; ", *(F.when(F.col(t) == "yes", t) for t in themes))})
    return rows.select(
        "temple_id",
        _blank(F.col("hrce_no")).alias("hrce_no"),
        _blank(F.col("link")).alias("link"),
        "check",
        two_source(F.col("check"), F.col("hrce_pariharam"), F.col("two_source_themes")).alias("two_source"),
        "two_source_themes",
        "name_ta",
        "town_ta",
        F.coalesce(F.nullif("hrce_title_ta", F.lit("")), F.col("hrce_title"), F.lit("")).alias("hrce_name_ta"),
        F.when(F.col("_has"), "yes").otherwise("no").alias("hrce_has_text"),
        "hrce_pariharam",
        "hrce_prayer",
        *themes,
    )


def compare_stats(rows: DataFrame) -> DataFrame:
    confirmed = F.col("check") == "confirmed"
    return rows.agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(confirmed).alias("confirmed"),
        F.count_if(~confirmed).alias("doubtful"),
        F.count_if(confirmed & (F.col("hrce_has_text") == "yes")).alias("confirmed_with_text"),
        F.count_if(F.col("two_source") == "pariharam").alias("two_source_pariharam"),
        F.count_if(F.col("two_source") == "theme").alias("two_source_theme"),
    )
