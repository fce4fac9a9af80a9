"""Queries of linkage, comparison and translation over records that are made of the driver's tables.

Names and towns are one consonant four times, so that two of them are either the same or have no letter in common: ratios are 1 or 0, and SQL can score them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scoring import repair_text, split_long
from weftline.functions.text import alternatives, has_tamil, name_skeletons, pincode, skeleton
from weftline.functions.vocabulary import CONSONANTS, PRAYER, REMEDY
from weftline.operators import compare as comparing
from weftline.operators import linkage, translation
from weftline.registry import query

#: Consonants that a skeleton leaves as they are.
LETTERS = CONSONANTS.replace("ழ", "")[:19]
_HEX = "0123456789abcdef"


def _four(key: Column, of: int) -> Column:
    return F.repeat(F.substr(F.lit(LETTERS), (key % of + 1).cast("int"), F.lit(1)), 4)


def _four_sql(key: str, of: int) -> str:
    return f"repeat(substr('{LETTERS}', (({key}) % {of} + 1)::BIGINT, 1), 4)"


def _records(t) -> DataFrame:
    """Customers as records: name, another deity's name for every fifth, a town, and a pincode but for every tenth, half of them written with a space."""
    k = F.col("c_custkey")
    pin = 600000 + k % 50
    written = F.when(k % 2 == 0, pin.cast("string")).otherwise(F.concat(F.substr(pin.cast("string"), F.lit(1), F.lit(3)), F.lit(" "), F.substr(pin.cast("string"), F.lit(4), F.lit(3))))
    return t("customer").select(
        k.alias("rec_ord"),
        k.cast("string").alias("temple_id"),
        F.concat(F.lit("அருள்மிகு "), _four(k, 19), F.lit(" திருக்கோயில்")).alias("name_ta"),
        F.when(k % 5 == 0, F.concat(_four(k + 3, 19), F.lit(", "), _four(k + 7, 19), F.lit(" (x)"))).otherwise("").alias("moolavar_ta"),
        _four(k, 17).alias("town_ta"),
        F.lit("").alias("town_en"),
        F.when(k % 10 == 0, "no code here").otherwise(F.concat(F.lit("12 street 1600045, town - "), written)).alias("address_ta"),
        F.lit("").alias("address_en"),
    )


def _register(t) -> DataFrame:
    k = F.col("s_suppkey")
    return t("supplier").select(
        F.concat(F.lit("TM"), F.lpad(k.cast("string"), 6, "0")).alias("tm"),
        k.cast("int").alias("tid"),
        F.concat(F.lit("அருள்மிகு "), _four(k, 19), F.lit(" திருக்கோயில்")).alias("name"),
        F.array(_four(k, 17)).alias("places"),
        F.array(_four(k, 17)).alias("places_raw"),
        (600000 + k % 50).cast("string").alias("pincode"),
        k.alias("reg_ord"),
    )


_LINKAGE = f"""
WITH rec AS (SELECT c_custkey AS k, c_custkey % 19 AS n0, CASE WHEN c_custkey % 5 = 0 THEN [c_custkey % 19, (c_custkey + 3) % 19, (c_custkey + 7) % 19] ELSE [c_custkey % 19] END AS names, c_custkey % 17 AS town, CASE WHEN c_custkey % 10 = 0 THEN '' ELSE (600000 + c_custkey % 50)::VARCHAR END AS pin FROM customer),
reg AS (SELECT s_suppkey AS r, s_suppkey % 19 AS name, s_suppkey % 17 AS town, (600000 + s_suppkey % 50)::VARCHAR AS pin FROM supplier),
pair AS (SELECT k, r, rec.pin <> '' AND rec.pin = reg.pin AS same_pin, list_contains(names, reg.name) AS name, rec.town = reg.town AS place FROM rec, reg WHERE (rec.pin <> '' AND rec.pin = reg.pin) OR rec.town = reg.town),
scored AS (SELECT *, round(0.6 * name::INT + 0.4 * greatest(place::INT, CASE WHEN same_pin THEN 0.6 ELSE 0 END) + CASE WHEN same_pin THEN 0.03 ELSE 0 END, 3)::DOUBLE AS score FROM pair),
weak AS (SELECT k FROM rec WHERE k NOT IN (SELECT k FROM scored WHERE same_pin AND score >= 0.8)),
pool AS (SELECT * FROM scored WHERE same_pin OR k IN (SELECT k FROM weak)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, NOT same_pin, r) AS place_no FROM pool),
best AS (SELECT a.*, coalesce(b.score, 0) AS runner_up FROM ranked a LEFT JOIN ranked b ON a.k = b.k AND b.place_no = 2 WHERE a.place_no = 1),
judged AS (
  SELECT rec.k, rec.n0, rec.town AS own_town, rec.pin, best.*, CASE WHEN score IS NULL THEN 'none' WHEN score >= 0.86 AND score - runner_up >= 0.06 AND (same_pin OR rec.pin = '') THEN 'exact' WHEN score >= 0.72 AND score - runner_up >= 0.03 THEN 'likely' ELSE 'none' END AS confidence
  FROM rec LEFT JOIN best ON rec.k = best.k)
"""


@query(_LINKAGE + "SELECT k AS rec_ord, r AS reg_ord, score FROM scored WHERE same_pin")
def pincode_candidates(t):
    pairs = linkage.by_pincode(linkage.prepare_records(_records(t)), linkage.prepare_register(_register(t)))
    return pairs.select("rec_ord", "reg_ord", "score")


@query(_LINKAGE + "SELECT k AS rec_ord, r AS reg_ord, 0 AS tie, score FROM scored WHERE place AND NOT same_pin")
def town_candidates(t):
    pairs = linkage.by_town(linkage.prepare_records(_records(t)), linkage.prepare_register(_register(t)))
    return pairs.select("rec_ord", "reg_ord", F.col("tie").cast("int").alias("tie"), "score")


@query(_LINKAGE + f"""SELECT k AS rec_ord, k::VARCHAR AS temple_id, CASE WHEN confidence <> 'none' THEN r::VARCHAR ELSE '' END AS tid, CASE WHEN confidence <> 'none' THEN 'TM' || lpad(r::VARCHAR, 6, '0') ELSE '' END AS hrce_no,
confidence, score, CASE WHEN score IS NULL THEN '' WHEN same_pin THEN 'yes' ELSE 'no' END AS pincode_match, {_four_sql("own_town", 17)} AS town_ta,
coalesce('அருள்மிகு ' || {_four_sql("r", 19)} || ' திருக்கோயில்', '') AS register_name, coalesce({_four_sql("r", 17)}, '') AS register_place, CASE WHEN score IS NOT NULL THEN runner_up END AS runner_up FROM judged""")
def linked_records(t):
    return linkage.link(_records(t), _register(t)).drop("name_ta").withColumn("tid", F.coalesce(F.col("tid").cast("string"), F.lit("")))


@query(_LINKAGE + "SELECT (SELECT count(*) FROM supplier) AS register, count(*) AS records, count(*) FILTER (WHERE confidence = 'exact') AS exact, count(*) FILTER (WHERE confidence = 'likely') AS likely, count(*) FILTER (WHERE confidence = 'none') AS none FROM judged")
def confidence_histogram(t):
    register = _register(t)
    return linkage.link_stats(linkage.link(_records(t), register), register)


def _towns(key: Column, length: Column) -> Column:
    return F.translate(F.substr(F.md5((key % 400).cast("string").cast("binary")), F.lit(1), length), _HEX, LETTERS[:16])


@query("""
WITH a AS (SELECT c_custkey AS k, substr(md5((c_custkey % 400)::VARCHAR), 1, 9) AS s FROM customer),
b AS (SELECT s_suppkey AS r, substr(md5((s_suppkey % 400)::VARCHAR), 1, (9 - s_suppkey % 4)::BIGINT) AS s FROM supplier),
x AS (SELECT k, length(s) - 2 AS n, unnest(range(0, length(s) - 2)) AS p, s FROM a), y AS (SELECT r, unnest(range(0, length(s) - 2)) AS p, s FROM b)
SELECT x.k AS rec_ord, y.r AS reg_ord, count(*) AS hits, min(x.p) AS tie FROM x JOIN y ON substr(x.s, (x.p + 1)::BIGINT, 3) = substr(y.s, (y.p + 1)::BIGINT, 3)
GROUP BY x.k, y.r, x.n HAVING count(*) >= greatest(1, x.n - 1)""")
def trigram_block_pairs(t):
    """Towns of nine letters, some of the register's cut short: those that lack one trigram are candidates, those that lack more are not."""
    ours = t("customer").select(F.col("c_custkey").alias("rec_ord"), _towns(F.col("c_custkey"), F.lit(9)).alias("town"))
    theirs = t("supplier").select(F.col("s_suppkey").alias("reg_ord"), _towns(F.col("s_suppkey"), (9 - F.col("s_suppkey") % 4).cast("int")).alias("reg_places"))
    return linkage.town_pairs(ours, theirs).select("rec_ord", "reg_ord", F.col("hits").cast("long").alias("hits"), F.col("tie").cast("long").alias("tie"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE (600000 + c_custkey % 1000)::VARCHAR END AS pin FROM customer""")
def pin_extract(t):
    k = F.col("c_custkey")
    pin = (600000 + k % 1000).cast("string")
    address = F.when(k % 3 == 0, F.concat(F.lit("house 7"), pin, F.lit(" or 4"), pin)).when(k % 3 == 1, F.concat(F.lit("x - "), pin, F.lit(", 699999"))).otherwise(F.concat(F.left(pin, F.lit(3)), F.lit(" "), F.right(pin, F.lit(3)), F.lit(".")))
    return t("customer").select("c_custkey", pincode(F.when(k % 2 == 0, address), F.when(k % 2 == 1, address)).alias("pin"))


_TO_TAMIL = ("bcdfghjklmnpqrstvwx", LETTERS)


@query(f"""WITH n AS (SELECT p_partkey, translate(regexp_replace(lower(p_name), '[^bcdfghjklmnpqrstvwx]', '', 'g'), '{_TO_TAMIL[0]}', '{_TO_TAMIL[1]}') AS s FROM part)
SELECT p_partkey, s AS skeleton, array_to_string(list_sort(list_distinct(list_filter([s, s || 'க'], lambda x: length(x) >= 3))), ' ') AS names FROM n""")
def tamil_skeletons(t):
    """Names with stock words and vowel signs around their consonants, and a second one among alternatives; ழ counts as க."""
    name = F.translate(F.lower("p_name"), *_TO_TAMIL)
    full = F.concat(F.lit("அருள்மிகு ஸ்ரீ "), name, F.lit("ு திருக்கோயில்"))
    return t("part").select("p_partkey", skeleton(full).alias("skeleton"), F.array_join(F.array_sort(name_skeletons(full, F.concat(F.lit("x, ("), name, F.lit("ழ) / "), name))), " ").alias("names"))


@query("SELECT p_partkey, trim(x) AS part FROM (SELECT p_partkey, unnest([p_name, ' ' || p_brand, p_type]) AS x FROM part)")
def alternative_names(t):
    every = F.concat_ws(",", "p_name", F.concat(F.lit(" "), "p_brand", F.lit("/"), "p_type"))
    return t("part").select("p_partkey", F.explode(alternatives(every)).alias("x")).select("p_partkey", F.trim("x").alias("part"))


#: Letters of a name -> glyphs of the register's font, and what these print.
_PRINTS = {"a": ("௘", "மி"), "e": ("௜", "யி"), "l": ("௧", "லி"), "t": ("௖", "பு"), "r": ("௫", "ரு"), "g": ("ேக", "கே"), "s": ("ெசா", "சொ"), "m": ("ைம", "மை")}
_PRINTED_SQL = "p_name"
for _letter, (_, _prints) in _PRINTS.items():
    _PRINTED_SQL = f"replace({_PRINTED_SQL}, '{_letter}', '{_prints}')"


@query(f"SELECT p_partkey, {_PRINTED_SQL} AS name FROM part")
def repaired_names(t):
    raw = F.col("p_name")
    for letter, (glyph, _) in _PRINTS.items():
        raw = F.replace(raw, F.lit(letter), F.lit(glyph))
    return t("part").select("p_partkey", repair_text(raw).alias("name"))


_COMPARED = {"first": "the|and", "second": "tion", "third": "zzz|qq"}


def _compared(t) -> DataFrame:
    """Documents as records, conversations as their second source. Titles repeat the record's name and town, another town, or nothing; the last of two records and links of an id counts."""
    k = F.col("doc_id")
    docs = t("documents").select(
        k.cast("string").alias("temple_id"), _four(k, 19).alias("name_ta"), F.lit("").alias("moolavar_ta"), _four(k, 17).alias("town_ta"), F.lit("").alias("town_en"),
        F.concat(F.lit("x - "), (600000 + k % 1000).cast("string")).alias("address_ta"), F.lit("").alias("address_en"), F.col("text").alias("prayers_ta"), F.lit("").alias("speciality_ta"), F.lit("").alias("special_features_ta"), k,
    )
    records = docs.withColumn("rec_ord", F.lit(1)).unionByName(docs.withColumns({"rec_ord": F.lit(0), "town_ta": F.lit("x"), "prayers_ta": F.lit("")})).drop("doc_id")
    said = t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["text"]), " ").alias("history_ta"))
    c = F.col("conv_id")
    title = F.when(c % 4 == 0, F.concat(_four(c, 19), F.lit(", "), _four(c, 17), F.lit(" - 999999"))).when(c % 4 == 1, F.concat(_four(c, 19), F.lit(", "), _four(c + 1, 17))).when(c % 4 == 2, F.concat(_four(c, 19), F.lit(", "), _four(c + 1, 17), F.lit(" - "), (600000 + c % 1000).cast("string")))
    rows = [F.struct(F.lit(REMEDY + "ம்").alias("kind"), F.lit("-").alias("heading")), F.struct(F.lit(REMEDY + "ம்").alias("kind"), F.concat(F.lit("r"), c.cast("string")).alias("heading")), F.struct(F.lit(PRAYER + "னை").alias("kind"), F.lit("p1").alias("heading")), F.struct(F.lit(PRAYER + "னை").alias("kind"), F.lit("p2").alias("heading"))]
    speciality = F.when(c % 3 == 0, F.array(*rows)).when(c % 3 == 1, F.array(rows[0]))
    second = said.select(c.cast("string").alias("temple_id"), F.lit("TM1").alias("hrce_no"), F.lit("english title").alias("hrce_title"), title.alias("hrce_title_ta"), "history_ta", speciality.alias("speciality"))
    links = t("documents").select(k.cast("string").alias("temple_id"), F.explode(F.array(F.struct(F.lit(0).alias("link_ord"), F.lit("none").alias("confidence")), F.struct(F.lit(1).alias("link_ord"), F.lit("likely").alias("confidence")))).alias("x")).where(k % 2 == 0).select("temple_id", "x.*")
    return comparing.compare(records, second, links, _COMPARED)


_COMPARISON = f"""
WITH s AS (SELECT conv_id AS c, string_agg(text, ' ' ORDER BY turn, role, text) AS h FROM conversations GROUP BY 1),
j AS (SELECT c, text, h || ' ' || CASE c % 3 WHEN 0 THEN '{REMEDY}ம் - {REMEDY}ம் r' || c || ' {PRAYER}னை p1 {PRAYER}னை p2' WHEN 1 THEN '{REMEDY}ம் -' ELSE '' END AS said,
  c % 4 = 0 OR (c % 4 = 2) AS good, CASE WHEN c % 3 = 0 THEN 'r' || c ELSE '' END AS remedy, CASE WHEN c % 3 = 0 THEN 'p1; p2' ELSE '' END AS prayer FROM s JOIN documents ON doc_id = c),
v AS (SELECT *, length(trim(said)) >= 40 AS has FROM j),
m AS (SELECT *, {", ".join(f"CASE WHEN NOT regexp_matches(text, '{p}') THEN '' WHEN NOT has THEN '?' WHEN regexp_matches(said, '{p}') THEN 'yes' ELSE 'no' END AS {k}" for k, p in _COMPARED.items())} FROM v),
o AS (SELECT *, concat_ws('; ', {", ".join(f"CASE WHEN {k} = 'yes' THEN '{k}' END" for k in _COMPARED)}) AS themes FROM m),
r AS (SELECT *, CASE WHEN NOT good THEN '' WHEN remedy <> '' THEN 'pariharam' WHEN themes <> '' THEN 'theme' ELSE '' END AS two_source FROM o)
"""


@query(_COMPARISON + f"""SELECT c::VARCHAR AS temple_id, 'TM1' AS hrce_no, CASE WHEN c % 2 = 0 THEN 'likely' ELSE '' END AS link, CASE WHEN good THEN 'confirmed' ELSE 'doubtful' END AS check, two_source, themes AS two_source_themes,
{_four_sql("c", 19)} AS name_ta, {_four_sql("c", 17)} AS town_ta,
CASE c % 4 WHEN 0 THEN {_four_sql("c", 19)} || ', ' || {_four_sql("c", 17)} || ' - 999999' WHEN 1 THEN {_four_sql("c", 19)} || ', ' || {_four_sql("c + 1", 17)} WHEN 2 THEN {_four_sql("c", 19)} || ', ' || {_four_sql("c + 1", 17)} || ' - ' || (600000 + c % 1000) ELSE 'english title' END AS hrce_name_ta,
CASE WHEN has THEN 'yes' ELSE 'no' END AS hrce_has_text, remedy AS hrce_pariharam, prayer AS hrce_prayer, first, second, third FROM r""")
def compared_sources(t):
    return _compared(t)


@query(_COMPARISON + """SELECT count(*) AS read, count(*) FILTER (WHERE good) AS confirmed, count(*) FILTER (WHERE NOT good) AS doubtful, count(*) FILTER (WHERE good AND has) AS confirmed_with_text,
count(*) FILTER (WHERE two_source = 'pariharam') AS two_source_pariharam, count(*) FILTER (WHERE two_source = 'theme') AS two_source_theme FROM r""")
def compare_stats(t):
    return comparing.compare_stats(_compared(t))


class _Speller:
    """A model that answers with a 3 for each e; a token is a word."""

    name = "speller"

    def count_tokens(self, text: str) -> int:
        return len(text.split())

    def translate(self, texts: list[str]) -> list[str]:
        return [f" {x.replace('e', '3')} " for x in texts]


_WHOLE = translation.Options(max_tokens=10**6)


def _tamil(t) -> DataFrame:
    """Documents with a Tamil word before their first line; the other lines have none and are copied."""
    return t("documents").select("doc_id", F.concat(F.lit("அருள்மிகு "), F.coalesce("text", F.lit(""))).alias("ta"))


def _no_cache(t) -> DataFrame:
    return t("documents").sparkSession.createDataFrame([], "h string, en string")


def _document_pieces(t) -> DataFrame:
    lines = translation.plan_lines(_tamil(t), ["doc_id"], "ta")
    return translation.plan_pieces(lines, ["doc_id"], _Speller, _WHOLE)


#: The sentences of a document's first line, as pieces of the translation plan.
_FIRST = """
WITH p AS (SELECT doc_id, string_split(regexp_replace(regexp_replace('Arulmigu ' || split_part(coalesce(text, ''), chr(10), 1), '^\\s+|\\s+$', '', 'g'), '([.?!।])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
s AS (SELECT doc_id, string_split(list_reduce(parts, lambda a, x: CASE WHEN length(regexp_extract(a, '[^\\x01]*$')) < 15 OR (ends_with(a, '.') AND contains(rtrim(regexp_extract(a, '[^\\s\\x01]+$'), '.'), '.')) THEN a || ' ' || x ELSE a || chr(1) || x END), chr(1)) AS merged FROM p),
u AS (SELECT doc_id, unnest(list_filter(merged, lambda x: trim(x) <> '')) AS piece FROM s)
"""


@query(_FIRST + "SELECT sha256(piece) AS h, count(*) AS n FROM u GROUP BY 1")
def distinct_pieces_hash(t):
    return _document_pieces(t).groupBy("h").agg(F.count(F.lit(1)).alias("n"))


@query(_FIRST + "SELECT DISTINCT sha256(piece) AS h, length(piece) AS n FROM u WHERE piece NOT IN (SELECT piece FROM u WHERE doc_id % 3 = 0)")
def cache_probe(t):
    pieces = _document_pieces(t)
    cache = pieces.where("doc_id % 3 = 0").select("h", F.lit("known").alias("en"))
    return translation.pending_pieces(pieces, cache).select("h", F.length("piece").cast("long").alias("n"))


@query("""
WITH l AS (SELECT doc_id, unnest(range(1, len(x) + 1)) AS i, x FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
e AS (SELECT doc_id, i, CASE WHEN i = 1 THEN replace(regexp_replace(regexp_replace('Arulmigu ' || x[1], '^\\s+|\\s+$', '', 'g'), '([.?!।])\\s+', '\\1 ', 'g'), 'e', '3') ELSE regexp_replace(x[i], '^\\s+|\\s+$', '', 'g') END AS line FROM l)
SELECT doc_id, sha256(regexp_replace(regexp_replace(string_agg(line, chr(10) ORDER BY i), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS h FROM e GROUP BY doc_id""")
def translated_documents(t):
    """The whole plan: first lines are glossed, cut, translated by a model that spells, and put together again; other lines are copied."""
    out = translation.translate(_tamil(t), ["doc_id"], "ta", _no_cache(t), _Speller, _WHOLE)
    return out.english.select("doc_id", F.sha2("en", 256).alias("h"))


@query(_FIRST + "SELECT sha256(piece) AS h, sha256(replace(piece, 'e', '3')) AS en, 'speller' AS m FROM (SELECT DISTINCT piece FROM u)")
def cache_entries(t):
    new = translation.translate(_tamil(t), ["doc_id"], "ta", _no_cache(t), _Speller, _WHOLE).new_entries
    return new.select("h", F.sha2("en", 256).alias("en"), "m")


@query("""SELECT md5(conv_id::VARCHAR) AS h, arg_max(text, (turn, role, text)) AS en FROM conversations WHERE conv_id % 7 <> 0 AND text IS NOT NULL GROUP BY 1""")
def cache_latest(t):
    log = t("conversations").select(F.when(F.col("conv_id") % 7 != 0, F.md5(F.col("conv_id").cast("string").cast("binary"))).alias("h"), F.col("text").alias("en"), F.struct("turn", "role", "text").alias("ord"))
    return translation.latest_entries(log, "ord")


@query("SELECT count(DISTINCT conv_id) AS temples, count(*) AS fields FROM conversations")
def translation_counts(t):
    return translation.translation_stats(t("conversations"), "conv_id")


@query("""SELECT item_id, line_no, regexp_matches(line, '[\u0B80-\u0BFF]') AS tamil FROM (SELECT item_id, unnest(range(len(x))) AS line_no, unnest(x) AS line FROM (SELECT item_id, string_split('அ' || text, chr(10)) AS x FROM benchmark))""")
def tamil_lines(t):
    lines = t("benchmark").select("item_id", F.posexplode(F.split(F.concat(F.lit("அ"), "text"), "\n")).alias("line_no", "line"))
    return lines.select("item_id", F.col("line_no").cast("long").alias("line_no"), has_tamil(F.col("line")).alias("tamil"))


@query("SELECT doc_id, sum(length(replace(piece, ',', '')))::BIGINT AS chars, max(len(string_split(piece, ' '))) <= 12 AS within FROM (SELECT doc_id, unnest(string_split(regexp_replace(trim(text), '\\s+', ' ', 'g'), ' ')) AS piece FROM documents WHERE trim(text) <> '') GROUP BY doc_id")
def long_pieces(t):
    """Documents as one sentence each, cut into pieces of twelve words at most; no word is lost, only commas where a piece ends."""
    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: split_long(x, lambda s: len(s.split()), 12))

    one = t("documents").select("doc_id", F.trim(F.regexp_replace("text", "[\\s]+", " ")).alias("s")).where("s <> ''")
    pieces = one.select("doc_id", F.explode(cut("s")).alias("piece"))
    words = F.size(F.split("piece", " "))
    return pieces.groupBy("doc_id").agg(F.sum(F.length(F.translate("piece", " ,", ""))).alias("chars"), (F.max(words) <= 12).alias("within"))
