"""The catalogue: a query for each operator over the driver's tables, with the SQL that says the same. This module has those of general operators; records, links and pages are in link_queries and page_queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline import link_queries, page_queries
from weftline.functions.text import (
    apply_glossary,
    apply_rules,
    cell_text,
    clean_lines,
    confidence,
    content_hash,
    latin_skeleton,
    ngrams,
    normalize_label,
    query_param,
    sentences,
)
from weftline.operators.compare import theme_state, two_source
from weftline.operators.dedupe import best_two, first_slot_first_value, keep_first, keep_last, numeric_then_text
from weftline.operators.incremental import coverage, follow, pending, split_rejects, tag_existing, whole_groups, with_total
from weftline.operators.records import nested_text
from weftline.operators.translation import batch_number
from weftline.registry import QUERIES, SQL, query


def _coverage(t) -> DataFrame:
    names = t("nation").select(F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("region_name"))
    return coverage(names, t("customer").select(F.col("c_nationkey").alias("region_id")), t("supplier").select(F.col("s_nationkey").alias("region_id")), "region_id", "region_name")


_COVERAGE = """
WITH a AS (SELECT c_nationkey::VARCHAR AS k, count(*) AS n FROM customer GROUP BY 1),
b AS (SELECT s_nationkey::VARCHAR AS k, count(*) AS n FROM supplier GROUP BY 1),
c AS (SELECT coalesce(a.k, b.k) AS region_id, coalesce(n_name, '') AS region_name, coalesce(a.n, 0) AS listed, coalesce(b.n, 0) AS scraped
      FROM a FULL JOIN b ON a.k = b.k LEFT JOIN nation ON n_nationkey::VARCHAR = coalesce(a.k, b.k))
"""


@query(_COVERAGE + "SELECT * FROM c")
def region_coverage(t):
    return _coverage(t)


@query(_COVERAGE + "SELECT * FROM c UNION ALL SELECT 'TOTAL', '', sum(listed)::BIGINT, sum(scraped)::BIGINT FROM c")
def region_coverage_total(t):
    return with_total(_coverage(t), "region_id", ["listed", "scraped"])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_items(t):
    return pending(t("documents"), t("labels"), ["doc_id"]).select("doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY source, doc_id LIMIT 25")
def pending_limited(t):
    return pending(t("documents").select("doc_id", "source"), t("labels"), ["doc_id"], ["source", "doc_id"], 25)


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'existing' ELSE 'new' END AS source FROM documents")
def tag_existing_new(t):
    return tag_existing(t("documents").select("doc_id"), t("labels"), ["doc_id"])


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def keep_first_by_key(t):
    docs = t("documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("h"))
    return keep_first(docs, ["h"], ["doc_id"]).drop("h")


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS k FROM conversations) WHERE k = 1")
def keep_last_by_key(t):
    return keep_last(t("conversations").select("conv_id", "turn", "role", "text"), ["conv_id"], ["turn"])


@query("""
WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS name FROM events)
SELECT user_id, min(event_id) AS event_id, coalesce(arg_min(name, event_id) FILTER (WHERE name <> ''), '') AS name FROM e GROUP BY user_id""")
def first_slot_first_name(t):
    e = t("events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("name"))
    return first_slot_first_value(e, ["user_id"], "event_id", "name")


@query("""SELECT page_id, regexp_extract(url, '^[^?#]*\\?(?:[^#]*&)?page=([^&#]*)', 1) AS page, regexp_extract(url, '^[^?#]*\\?(?:[^#]*&)?utm_source=([^&#]*)', 1) AS utm_source FROM pages""")
def url_query_params(t):
    return t("pages").select("page_id", query_param(F.col("url"), "page").alias("page"), query_param(F.col("url"), "utm_source").alias("utm_source"))


@query("""SELECT doc_id, sha256(CASE WHEN x IN ('-', '--', '–', '—', '.') THEN '' ELSE x END) AS h FROM (
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(coalesce(text, ''), chr(160) || chr(13), ' '), '[ \\t]+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS x FROM documents)""")
def clean_text_lines(t):
    return t("documents").select("doc_id", F.sha2(clean_lines(F.col("text")), 256).alias("h"))


@query("SELECT lower(regexp_replace(p_type, '[\\s:]+', '', 'g')) AS label, count(*) AS n FROM part GROUP BY 1")
def normalized_labels(t):
    return t("part").groupBy(normalize_label(F.col("p_type")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey AS id, regexp_replace(replace(replace(lower(p_name), 'th', 't'), 'sh', 's'), '[^bcdfghjklmnpqrstvwxyz]', '', 'g') AS skeleton FROM part
UNION ALL SELECT -c_custkey, regexp_replace(replace(replace(lower(c_name), 'th', 't'), 'sh', 's'), '[^bcdfghjklmnpqrstvwxyz]', '', 'g') FROM customer""")
def latin_skeletons(t):
    names = t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("n")).unionByName(t("customer").select((-F.col("c_custkey")).alias("id"), F.col("c_name").alias("n")))
    return names.select("id", latin_skeleton(F.col("n")).alias("skeleton"))


@query("SELECT gram, count(*) AS n FROM (SELECT unnest([substr(p_name, i, 3) for i in range(1, length(p_name) - 1)]) AS gram FROM part) GROUP BY 1")
def trigram_counts(t):
    return t("part").select(F.explode(ngrams(F.col("p_name"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


_TOP2 = """
WITH r AS (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer),
m AS (SELECT c_nationkey, max(c_custkey) FILTER (WHERE k = 1) AS c_custkey, max(c_acctbal) FILTER (WHERE k = 1) AS c_acctbal, coalesce(max(c_acctbal) FILTER (WHERE k = 2), 0.0) AS runner_up FROM r WHERE k <= 2 GROUP BY 1),
j AS (SELECT *, CASE WHEN c_acctbal / 10000 >= 0.86::DOUBLE AND c_acctbal / 10000 - runner_up / 10000 >= 0.06::DOUBLE THEN 'exact'
                     WHEN c_acctbal / 10000 >= 0.72::DOUBLE AND c_acctbal / 10000 - runner_up / 10000 >= 0.03::DOUBLE THEN 'likely' ELSE 'none' END AS confidence FROM m)
"""


def _judged(t) -> DataFrame:
    best = best_two(t("customer").select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "c_acctbal", ["c_custkey"])
    return best.withColumn("confidence", confidence(F.col("c_acctbal") / 10000, F.col("runner_up") / 10000, F.lit(True), F.lit(True)))


@query(_TOP2 + "SELECT c_nationkey, c_custkey, c_acctbal, runner_up FROM j")
def top2_margin(t):
    return _judged(t).drop("confidence")


@query(_TOP2 + "SELECT c_nationkey, confidence FROM j")
def margin_confidence(t):
    return _judged(t).select("c_nationkey", "confidence")


_THEMES = {"first": "the|and", "second": "tion", "third": "zzz|qq"}
_MATRIX = f"""
WITH c AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn, role, text) AS said FROM conversations GROUP BY 1),
m AS (SELECT doc_id, c.conv_id IS NOT NULL AND length(c.said) >= 40 AS has_text, {", ".join(f"CASE WHEN NOT regexp_matches(text, '{p}') THEN '' WHEN NOT (c.conv_id IS NOT NULL AND length(c.said) >= 40) THEN '?' WHEN regexp_matches(c.said, '{p}') THEN 'yes' ELSE 'no' END AS {k}" for k, p in _THEMES.items())}
      FROM documents LEFT JOIN c ON doc_id = conv_id),
f AS (SELECT m.doc_id, has_text, CASE WHEN coalesce(l.quality, 0) <> 1 THEN '' WHEN l.toxic = 1 THEN 'pariharam' WHEN 'yes' IN (first, second, third) THEN 'theme' ELSE '' END AS two_source, coalesce(l.quality, 0) = 1 AS good
      FROM m LEFT JOIN labels l ON m.doc_id = l.doc_id)
"""


def _matrix(t) -> DataFrame:
    said = t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["text"]), " ").alias("said"))
    rows = t("documents").join(said, F.col("doc_id") == F.col("conv_id"), "left").withColumn("has_text", F.coalesce(F.length("said") >= 40, F.lit(False)))
    return rows.withColumns({k: theme_state(F.col("text"), F.coalesce("said", F.lit("")), F.col("has_text"), p) for k, p in _THEMES.items()}).select("doc_id", "has_text", *_THEMES)


def _flagged(t) -> DataFrame:
    rows = _matrix(t).join(t("labels").select("doc_id", "quality", "toxic"), "doc_id", "left").withColumn("good", F.coalesce(F.col("quality") == 1, F.lit(False)))
    shared = F.concat_ws("; ", *(F.when(F.col(k) == "yes", k) for k in _THEMES))
    check = F.when(F.col("good"), "confirmed").otherwise("doubtful")
    return rows.withColumn("two_source", two_source(check, F.when(F.col("toxic") == 1, "x").otherwise(""), shared)).select("doc_id", "has_text", "two_source", "good")


@query(_MATRIX + "SELECT doc_id, first, second, third FROM m")
def theme_matrix(t):
    return _matrix(t).drop("has_text")


@query(_MATRIX + "SELECT doc_id, two_source FROM f")
def two_source_flag(t):
    return _flagged(t).select("doc_id", "two_source")


_PARTS = """
WITH p AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g'), '([.?!।])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
s AS (SELECT doc_id, string_split(list_reduce(parts, lambda a, x: CASE WHEN length(regexp_extract(a, '[^\\x01]*$')) < 15 OR (ends_with(a, '.') AND contains(rtrim(regexp_extract(a, '[^\\s\\x01]+$'), '.'), '.')) THEN a || ' ' || x ELSE a || chr(1) || x END), chr(1)) AS merged FROM p),
u AS (SELECT doc_id, unnest(list_filter(merged, lambda x: trim(x) <> '')) AS piece FROM s)
"""


def _pieces(t) -> DataFrame:
    return t("documents").select("doc_id", "source", F.explode(sentences(F.col("text"))).alias("piece"))


@query(_PARTS + "SELECT doc_id, count(*) AS n, sha256(string_agg(piece, '|' ORDER BY piece)) AS h FROM u GROUP BY doc_id")
def sentence_merge(t):
    merged = F.array_sort(sentences(F.col("text")))
    return t("documents").select("doc_id", F.size(merged).cast("long").alias("n"), F.sha2(F.array_join(merged, "|"), 256).alias("h")).where("n > 0")


@query(_PARTS + "SELECT sha256(piece) AS h, ((row_number() OVER (ORDER BY length(piece), piece) - 1) // 32)::BIGINT AS batch FROM (SELECT DISTINCT piece FROM u)")
def length_batches(t):
    return batch_number(_pieces(t).select("piece").distinct(), "piece", 32).select(content_hash(F.col("piece")).alias("h"), F.col("batch").cast("long").alias("batch"))


@query("SELECT user_id, '[' || string_agg('{\"id\":' || event_id || ',\"kind\":\"' || event_type || '\"}', ',' ORDER BY event_id) || ']' AS nested FROM events GROUP BY user_id")
def nested_to_text(t):
    rows = t("events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))).alias("x"))
    return rows.select("user_id", nested_text(F.col("x")).alias("nested"))


@query("""WITH o AS (SELECT o_orderpriority, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN 'D' || o_orderkey ELSE o_orderkey::VARCHAR END AS id, o_orderkey FROM orders)
SELECT o_orderkey, id, row_number() OVER (PARTITION BY o_orderpriority ORDER BY NOT regexp_full_match(id, '[0-9]*'), CASE WHEN regexp_full_match(id, '[0-9]+') THEN id::BIGINT ELSE 0 END, CASE WHEN regexp_full_match(id, '[0-9]*') THEN '' ELSE id END, o_orderkey) AS place FROM o""")
def numeric_then_text_rank(t):
    key = F.col("o_orderkey")
    rows = t("orders").select("o_orderpriority", "o_orderkey", F.when(key % 11 == 0, "").when(key % 7 == 0, F.concat(F.lit("D"), key.cast("string"))).otherwise(key.cast("string")).alias("id"))
    place = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(*numeric_then_text("id"), "o_orderkey"))
    return rows.select("o_orderkey", "id", place.cast("long").alias("place"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_quantity > 10))")
def whole_group_or_nothing(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") > 10).alias("ok"))
    return whole_groups(rows, ["l_orderkey"], "ok").drop("ok")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT conv_id, turn FROM conversations),
w AS (SELECT conv_id, turn, 0 AS depth FROM e WHERE turn = 0 UNION ALL SELECT e.conv_id, e.turn, depth + 1 FROM w JOIN e ON e.conv_id = w.conv_id AND e.turn = w.turn + 1)
SELECT conv_id || ':0' AS start, conv_id || ':' || turn AS page, depth::INTEGER AS depth FROM w""")
def follow_next_chain(t):
    turns = t("conversations").select("conv_id", "turn").distinct()
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    following = turns.join(turns.select("conv_id", (F.col("turn") - 1).alias("turn")), ["conv_id", "turn"])
    edges = following.select(name(F.col("turn")).alias("src"), name(F.col("turn") + 1).alias("dst"))
    return follow(edges, turns.where("turn = 0").select(name(F.col("turn")).alias("start")), most=1_000_000)


@query("SELECT DISTINCT event_id, user_id, event_type FROM events")
def resume_idempotent(t):
    """A first pass that stopped half-way, then one over everything that is pending, then a third one that finds nothing."""
    events = t("events").select("event_id", "user_id", "event_type").distinct()
    first = events.where("event_id % 2 = 0")
    second = first.unionByName(pending(events, first, ["event_id"]))
    return second.unionByName(pending(events, second, ["event_id"]))


@query("SELECT doc_id, sha256(regexp_replace(replace(replace(text, 'there', 'DORT'), 'the', 'DER'), '([0-9]+)', '<\\1>', 'g')) AS h FROM documents")
def glossary_words(t):
    text = apply_rules(apply_glossary(F.col("text"), {"the": "DER", "there": "DORT"}), {"([0-9]+)": "<\\1>"})
    return t("documents").select("doc_id", F.sha2(text, 256).alias("h"))


@query("SELECT doc_id, length(left(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), 32767)) AS n, sha256(left(regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), 32767)) AS h FROM documents")
def cell_truncate(t):
    cell = cell_text(F.col("text"))
    return t("documents").select("doc_id", F.length(cell).cast("long").alias("n"), F.sha2(cell, 256).alias("h"))


@query("SELECT CASE WHEN length(html) >= 1500 THEN 'ok' ELSE 'failed' END AS state, count(*) AS n FROM pages GROUP BY 1")
def reject_split(t):
    good, bad = split_rejects(t("pages").select("page_id", F.length("html").alias("n")), F.col("n") >= 1500)
    both = good.select(F.lit("ok").alias("state")).unionByName(bad.select(F.lit("failed").alias("state")))
    return both.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["QUERIES", "SQL", "link_queries", "page_queries"]
