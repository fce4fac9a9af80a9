"""The operators' queries over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import crc_of_id, table
from weftline.llm.decontaminate import find_leaks
from weftline.llm.exact_dedup import exact_dedup
from weftline.llm.license_scan import scan_licenses
from weftline.llm.mixing import mix
from weftline.llm.near_dedup import near_classes
from weftline.llm.quality import fit_quality, score_quality
from weftline.llm.secret_scan import BASE, find_secrets
from weftline.llm.substring_dedup import find_repeats
from weftline.llm.toxicity import fit_toxicity, score_toxicity
from weftline.llm.url_filter import judge_urls, rules_frame

#: (verdict, host, path) of the fixed rule list.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


#: Integer weights of the nodes that have one other than 1, the budget as a share of all tokens, epochs at most, and the seed of the order.
MIX_WEIGHTS = {"domain": {"d0": 2, "d1": 5, "d2": 2}, "lang": {"en": 3, "de": 2, "fr": 2}, "source": {"src0": 3, "src1": 4}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, "mix-1"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return out.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_urls(table(spark, sf_dir, "pages"), rules_frame(spark, URL_RULES))
    return out.select(F.col("_id").alias("page_id"), "host", "path", "rule", "verdict")


OP2_SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS k
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_item").alias("item_id"), "coverage", "n_tiles", "tiles")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = fit_toxicity(docs, table(spark, sf_dir, "labels"), crc_of_id("doc_id") % 3 != 1)
    out = score_toxicity(docs, tagger, threshold=0.7)
    return out.select(
        F.col("_id").alias("doc_id"),
        F.coalesce(crc_of_id("_id") % 3 == 1, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
        F.col("_spans").alias("spans"),
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_classes(table(spark, sf_dir, "documents"))
    return out.select(F.col("_id").alias("doc_id"), "class_id", "class_size", "kept")


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select(F.col("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP6_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
u AS (SELECT r, unnest(range(len(w))) AS p, unnest(w) AS x FROM d),
k AS (SELECT r, p, CASE WHEN count(*) OVER f = 35 THEN sha256(string_agg(x, ' ') OVER f) END AS h FROM u WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
again AS (SELECT h FROM k WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, p + j AS p FROM (SELECT r, p, unnest(range(35)) AS j FROM k WHERE h IN (SELECT h FROM again))),
n AS (SELECT u.r, count(*) AS n_words, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY u.p) FILTER (WHERE gone.p IS NULL) AS kept FROM u LEFT JOIN gone ON u.r = gone.r AND u.p = gone.p GROUP BY u.r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN n ON d.r = n.r
"""


def mixed(docs: DataFrame) -> DataFrame:
    """Documents mixed by the production weights; domains are the source numbers modulo 4."""
    number = F.coalesce(F.expr("try_cast(regexp_extract(source, '[0-9]+', 0) as int)"), F.lit(0))
    levels = [("domain", F.concat(F.lit("d"), (number % 4).cast("string"))), ("lang", F.col("lang")), ("source", F.col("source"))]
    out = mix(docs, levels, MIX_WEIGHTS, budget_share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    return out.select(F.col("_id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "epoch")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def _weight_sql(column: str) -> str:
    listed = MIX_WEIGHTS.get(column, {})
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in listed.items()) + " ELSE 1 END" if listed else "1"


def _share_sql(name: str, source: str, parent: str, child: str) -> str:
    """Common table expressions that divide _budget among the rows of `source`, as `name`."""
    return f"""
{name}_a AS (
  SELECT *, coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY cap::DOUBLE / w, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS full_before,
         (sum(w) OVER (PARTITION BY {parent}) - coalesce(sum(w) OVER (PARTITION BY {parent} ORDER BY cap::DOUBLE / w, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS w_left
  FROM {source} WHERE w > 0 AND cap > 0),
{name}_b AS (SELECT *, cap::HUGEINT * w_left <= w::HUGEINT * (budget - full_before) AS is_full FROM {name}_a),
{name}_c AS (
  SELECT *, (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {parent}), 0))::HUGEINT AS rest,
         (sum(CASE WHEN NOT is_full THEN w END) OVER (PARTITION BY {parent}))::HUGEINT AS w_open
  FROM {name}_b),
{name}_d AS (SELECT *, CASE WHEN is_full THEN cap ELSE (w::HUGEINT * greatest(rest, 0)) // w_open END AS part FROM {name}_c),
{name}_e AS (
  SELECT *, rest - sum(CASE WHEN NOT is_full THEN part END) OVER (PARTITION BY {parent}) AS odd,
         row_number() OVER (PARTITION BY {parent} ORDER BY is_full, {child}) AS place
  FROM {name}_d),
{name} AS (SELECT *, (part + CASE WHEN NOT is_full AND place <= odd THEN 1 ELSE 0 END)::BIGINT AS got FROM {name}_e)"""


def op7_sql(documents: str = "documents") -> str:
    return f"""
WITH docs AS (
  SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(source, '[0-9]+') AS INTEGER), 0) % 4)::VARCHAR AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
  FROM {documents}),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS total, (sum(n_tokens) * {MIX_EPOCHS})::BIGINT AS cap,
         {_weight_sql("domain")} AS w_domain, {_weight_sql("lang")} AS w_lang, {_weight_sql("source")} AS w_source
  FROM docs GROUP BY 1, 2, 3),
live AS (SELECT * FROM leaves WHERE w_domain > 0 AND w_lang > 0 AND w_source > 0),
top AS (SELECT least(floor(sum(cap) / {MIX_EPOCHS} * {MIX_SHARE}::DOUBLE), sum(cap))::BIGINT AS budget FROM live),
n1 AS (SELECT 0 AS root, domain, sum(cap)::BIGINT AS cap, max(w_domain) AS w, any_value(budget) AS budget FROM live, top GROUP BY domain),
{_share_sql("s1", "n1", "root", "domain")},
n2 AS (SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, max(l.w_lang) AS w, any_value(s.got) AS budget FROM live l JOIN s1 s ON l.domain = s.domain GROUP BY 1, 2),
{_share_sql("s2", "n2", "domain", "lang")},
n3 AS (SELECT l.domain, l.lang, l.source, l.cap, l.w_source AS w, s.got AS budget FROM live l JOIN s2 s ON l.domain = s.domain AND l.lang = s.lang),
{_share_sql("s3", "n3", "domain, lang", "source")},
plan AS (SELECT s.domain, s.lang, s.source, s.got // l.total AS whole, s.got % l.total AS rest FROM s3 s JOIN leaves l ON s.domain = l.domain AND s.lang = l.lang AND s.source = l.source WHERE l.total > 0),
placed AS (
  SELECT d.*, p.whole, p.rest, md5('{MIX_SEED}:' || p.whole::VARCHAR || ':' || coalesce(d.doc_id::VARCHAR, '')) AS k
  FROM docs d JOIN plan p ON d.domain = p.domain AND d.lang = p.lang AND d.source = p.source),
runs AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, epoch::INTEGER AS epoch FROM (
  SELECT doc_id, domain, lang, source, n_tokens, unnest(range(0, whole)) AS epoch FROM placed
  UNION ALL
  SELECT doc_id, domain, lang, source, n_tokens, whole AS epoch FROM runs WHERE before < rest)
"""


def op8_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["chance"].alias("chance"), x["family"].alias("family"))))
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"),
        F.coalesce(best["family"], F.lit("none")).alias("license"),
        best["chance"].alias("chance"),
        F.size("licenses").cast("long").alias("n_paragraphs"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ",").alias("paragraphs"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.array(*(F.lit(r.kind) for r in BASE))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = find_secrets(table(spark, sf_dir, "documents")).withColumn("base", F.filter("spans", lambda s: F.array_contains(base, s["kind"])))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{r.kind}')) as bigint) AS n_{r.kind}") for r in BASE]
    return found.select(F.col("_id").alias("doc_id"), *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


#: (kind, regex, group that is measured, least length) of the rules, for SQL.
_SECRETS = [
    ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("github", "gh[opsur]_[A-Za-z0-9]+", 0, 24),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
]
#: A match starts after what lies between the matches so far and after these matches.
OP9_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
m AS ({" UNION ALL ".join(f"SELECT r, {k} AS rule, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits, regexp_extract_all(t, '{p}', {g}) AS part FROM d WHERE regexp_matches(t, '{p}')" for k, (kind, p, g, least) in enumerate(_SECRETS))}),
x AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS (
  SELECT r, rule, kind, (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0))::BIGINT AS a, length(hits[i]) AS n
  FROM x WHERE length(part[i]) >= least),
z AS (SELECT *, kind || ':' || a || ':' || (a + n) AS span FROM s)
SELECT any_value(d.doc_id) AS doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY a, rule) FILTER (WHERE rule < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, rule), '') AS spans
FROM d LEFT JOIN z ON d.r = z.r GROUP BY d.r
"""


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = fit_quality(docs, table(spark, sf_dir, "labels"), crc_of_id("doc_id") % 5 != 0)
    out = score_quality(docs, tagger, threshold=0.3)
    return out.select(
        F.col("_id").alias("doc_id"),
        F.coalesce(crc_of_id("_id") % 5 == 0, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_url_filter": op2_url_filter,
        "op3_decontamination": op3_decontamination,
        "op4_toxicity": op4_toxicity,
        "op5_minhash": op5_minhash,
        "op6_substring": op6_substring,
        "op7_mixing": op7_mixing,
        "op8_license": op8_license,
        "op9_secret_scan": op9_secret_scan,
        "op10_quality": op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op2_url_filter": OP2_SQL, "op6_substring": OP6_SQL, "op7_mixing": op7_sql(), "op9_secret_scan": OP9_SQL}
