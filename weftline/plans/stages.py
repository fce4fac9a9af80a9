"""The stages of a run. Each reads tables, makes one lazy plan, and appends or replaces one table; a run that dies is resumed by an anti-join with what is there.

Lists of pages are followed on the driver, because politeness is global and each page names the next; what the pages hold is parsed and joined as DataFrames.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import islice
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.vocabulary import CATEGORIES
from weftline.operators import compare as comparing
from weftline.operators import incremental, linkage, records, translation
from weftline.operators.dedupe import first_slot_first_value, keep_first, keep_last, numeric_then_text
from weftline.operators.lineage import cut
from weftline.plans.settings import Settings
from weftline.sources import files
from weftline.sources.fetch import Fetcher, fetch_pages
from weftline.sources.pages import detail_of, list_page_of, parse_detail, parse_headings, parse_history, parse_title, regions_of, sub_lists_of
from weftline.sources.register import read_register, register_table


class Store:
    """The tables of an output folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        Path(self.root).mkdir(parents=True, exist_ok=True)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _rows(self, name: str, schema) -> DataFrame:
        return files.read_jsonl(self.spark, self.at(name), schema)[0]

    def regions(self) -> DataFrame:
        return files.read_json(self.spark, self.at("regions.json"), files.strings("district_id", "district_name"))

    def index(self) -> DataFrame:
        """One row per item: the first by region, page and place, whichever was written first."""
        rows = files.read_jsonl(self.spark, self.at("index"), files.T.StructType([*files.INDEX.fields, *(files.T.StructField(n, files.T.LongType()) for n in ("region_ord", "page", "ord"))]))[0]
        return keep_first(rows, ["temple_id"], ["region_ord", "page", "ord"])

    def progress(self) -> dict[str, dict]:
        at = Path(self.at("progress.json"))
        return json.loads(at.read_text()) if at.exists() else {}

    def categories(self) -> DataFrame:
        return self._rows("categories", files.CATEGORY)

    def records(self) -> DataFrame:
        return self._rows("records", files.record_schema())

    def ordered_records(self) -> DataFrame:
        """Records with their place in the files (rec_ord), which doesn't change from one reading to the next."""
        return files.read_jsonl(self.spark, self.at("records"), files.record_schema(), order="rec_ord")[0]

    def english(self) -> DataFrame:
        """Translations that are not in the records yet."""
        return files.read_jsonl(self.spark, self.at("english"), files.strings("temple_id", "field", "en"), order="ord")[0]

    def second(self) -> DataFrame:
        return self._rows("second", files.SECOND)

    def cache(self) -> DataFrame:
        rows = files.read_jsonl(self.spark, self.at("cache"), files.CACHE, order="ord")[0]
        return translation.latest_entries(rows, "ord")

    def reject(self, rows: DataFrame) -> int:
        """Log failures (url, error) and count them."""
        n = rows.count()
        if n:
            files.log_failures(files.failures(rows, "url", "error"), self.at("failed"))
        return n


def regions(store: Store, fetcher: Fetcher, settings: Settings, refresh: bool = False) -> int:
    """Stage 1: the list of regions; an existing one is used unless refresh. No region at all is an error."""
    have = store.regions().count()
    if have and not refresh:
        return have
    pages = fetch_pages(store.spark, [settings.regions_url], fetcher)
    page = pages.first()
    found = regions_of(page["html"])
    if not found:
        store.reject(pages.select("url", F.coalesce("error", F.lit("no region links found")).alias("error")))
        raise RuntimeError("no regions found")
    files.write_json(store.at("regions.json"), found)
    return len(found)


def index(store: Store, fetcher: Fetcher, settings: Settings, limit: int | None = None) -> int:
    """Stage 2: the items of each region's list, page by page. Rows are written before progress, and rows are told apart by key when read, so a crash in between only repeats a page. Returns the number of failures; a region that reaches the page cap is one."""
    known = [(r["district_id"], r["district_name"]) for r in store.regions().collect()]
    state = store.progress()
    failed = 0
    todo = [(k, *r) for k, r in enumerate(known) if not state.get(r[0], {}).get("complete")]
    for place, region, name in todo[:limit]:
        progress = state.setdefault(region, {"last_page": 0, "complete": False, "temples": 0})
        while not progress["complete"]:
            page = progress["last_page"] + 1
            if page > settings.most_pages:
                failed += store.reject(store.spark.createDataFrame([(region, f"more than {settings.most_pages} pages")], "url string, error string"))
                break
            url = f"{settings.base_url}/district_temple.php?id={region}" + (f"&Page={page}" if page > 1 else "")
            got = fetch_pages(store.spark, [url], fetcher)
            row = got.first()
            if row["error"]:
                failed += store.reject(got.select("url", "error"))
                break
            listed = list_page_of(row["html"])
            rows = [(region, name, e["temple_id"], e["temple_name"], place, page, k) for k, e in enumerate(listed["entries"]) if e["temple_name"]]
            new = store.spark.createDataFrame(rows, "district_id string, district_name string, temple_id string, temple_name string, region_ord long, page long, ord long")
            files.append(new.join(store.index().select("temple_id"), "temple_id", "left_anti"), store.at("index"))
            progress |= {"last_page": page, "complete": listed["next_href"] is None, "temples": progress["temples"] + len(rows)}
            files.write_json(store.at("progress.json"), state)
    return failed


def build(store: Store, items: DataFrame, fetcher: Fetcher, settings: Settings, chunk: int = 200) -> tuple[int, int]:
    """Fetch, parse and append records of items, a bounded chunk at a time. Returns how many are new and how many failed."""
    rows = (r.asDict() for r in cut(items).toLocalIterator())  # as they were when the stage began
    ok = failed = 0
    while todo := list(islice(rows, chunk)):
        part = store.spark.createDataFrame([(r["temple_id"], r.get("district_id") or "", r.get("district_name") or "") for r in todo], "temple_id string, district_id string, district_name string")
        tamil_urls = {f"{settings.base_url}/new.php?id={r['temple_id']}": r["temple_id"] for r in todo}
        pages = fetch_pages(store.spark, tamil_urls, fetcher, settings.slots)
        have = [r for r in pages.collect() if r["error"] is None]
        english_urls = [f"{settings.base_url}/en/new_en.php?id={tamil_urls[r['url']]}" for r in have if (d := detail_of(r["html"]))["found"] and d["has_english_page"]]
        english = fetch_pages(store.spark, english_urls, fetcher, settings.slots)
        read = parse_detail(settings.image_base_url)
        tid = F.regexp_extract("url", "id=([^&]*)$", 1).alias("temple_id")
        ta = pages.where("error is null").select(tid, "url", read("html").alias("page"))
        en = english.where("error is null").select(tid, read("html").alias("page"))
        bad_english = english.where("error is not null").select(tid, "url", "error")
        good = ta.where("page.found").join(bad_english.select("temple_id"), "temple_id", "left_anti")
        new = records.assemble(part, good.select("temple_id", "page"), en)
        rejects = pages.where("error is not null").select("url", "error").unionByName(ta.where("not page.found").select("url", F.lit("page has no details (empty template)").alias("error"))).unionByName(bad_english.select("url", "error"))
        bad = store.reject(rejects)
        files.append(new, store.at("records"))
        ok, failed = ok + part.count() - bad, failed + bad
    return ok, failed


def record_stage(store: Store, fetcher: Fetcher, settings: Settings, region: str | None = None, limit: int | None = None) -> tuple[int, int]:
    """Stage 3: the records of listed items that are not there yet; region and limit hold before anything is fetched."""
    items = store.index()
    if region:
        if not store.regions().where(F.col("district_id") == region).count():
            raise ValueError(f"unknown region {region}")
        items = items.where(F.col("district_id") == region)
    return build(store, incremental.pending(items, store.records(), ["temple_id"], ["region_ord", "page", "ord"], limit), fetcher, settings)


def _list(fetcher: Fetcher, settings: Settings, href: str) -> list[dict]:
    """All items of a list, following its next pages until there is none, one comes again, or the cap."""
    found: list[dict] = []
    seen: set[str] = set()
    following: str | None = href
    while following and following not in seen and len(seen) < settings.most_pages:
        seen.add(following)
        page = list_page_of(fetcher.get_text(f"{settings.base_url}/{following.lstrip('/')}"))
        found += page["entries"]
        following = page["next_href"]
    return found


def categories(store: Store, fetcher: Fetcher, settings: Settings, number: int | None = None, limit: int | None = None) -> tuple[int, int]:
    """The items of each menu list, whole lists only, then the records that lack. Returns new records and failures."""
    listed = {r["category_no"] for r in store.categories().select("category_no").distinct().collect()}
    failed = 0
    for no, name, path, marker in CATEGORIES:
        if (number and no != number) or str(no) in listed:
            continue
        try:
            hrefs = sub_lists_of(fetcher.get_text(f"{settings.base_url}/{path}"), marker) if marker else [path]
            every = [(k, e["temple_id"], e["temple_name"]) for k, e in enumerate(e for h in hrefs for e in _list(fetcher, settings, h))]
        except Exception as e:  # noqa: BLE001 - the list is tried again next run
            failed += store.reject(store.spark.createDataFrame([(path, f"{type(e).__name__}: {e}")], "url string, error string"))
            continue
        rows = store.spark.createDataFrame(every, "ord long, temple_id string, temple_name string")
        one = first_slot_first_value(rows, ["temple_id"], "ord", "temple_name").orderBy("ord")
        tagged = incremental.tag_existing(one.select(F.lit(str(no)).alias("category_no"), F.lit(name).alias("category_name"), "temple_id", "temple_name"), store.records(), ["temple_id"])
        files.append(tagged.select(*files.CATEGORY.names), store.at("categories"))
    wanted = store.categories() if number is None else store.categories().where(F.col("category_no") == str(number))
    ids = wanted.select("temple_id").distinct()
    ok, bad = build(store, incremental.pending(ids, store.records(), ["temple_id"], numeric_then_text("temple_id"), limit), fetcher, settings)
    return ok, failed + bad


def link(store: Store, lines: DataFrame) -> DataFrame:
    """The register, its table, and the links of all records. Returns the counts."""
    register = cut(read_register(lines))
    found = linkage.link(store.ordered_records(), register).orderBy("rec_ord").drop("rec_ord")
    files.replace(found, store.at("links"))
    links = files.read_jsonl(store.spark, store.at("links"), found.schema, order="ord")[0]  # computed once
    files.export_csv(register_table(register), store.at("register.csv"))
    files.export_csv(links.orderBy("ord").drop("ord"), store.at("links.csv"))
    return linkage.link_stats(links, register)


def second(store: Store, fetcher: Fetcher, settings: Settings, limit: int | None = None) -> tuple[int, int]:
    """Two pages of the second source for each linked item that is not read yet; one that fails rejects the item."""
    links = files.linked(files.read_jsonl(store.spark, store.at("links"), files.strings("temple_id", "tid"))[0])
    todo = incremental.pending(links, store.second(), ["temple_id"], numeric_then_text("temple_id"), limit).collect()
    if not todo:
        return 0, 0
    wanted = store.spark.createDataFrame([(r["temple_id"], int(r["tid"])) for r in todo], "temple_id string, tid int")
    got = {p: fetch_pages(store.spark, [settings.second_url(p, int(r["tid"])) for r in todo], fetcher, settings.slots) for p in ("history", "speciality")}
    tid = F.regexp_extract("url", "tid=([0-9]+)$", 1).cast("int").alias("tid")
    history, speciality = (got[p].where("error is null").select(tid, F.col("html").alias(p)).distinct() for p in ("history", "speciality"))
    both = wanted.join(history, "tid").join(speciality, "tid")
    rows = both.withColumn("_t", parse_title("history")).select("temple_id", "tid", "_t.*", parse_history("history").alias("history_ta"), parse_headings("speciality").alias("speciality"), records.iso_now().alias("read_at"))
    files.append(rows, store.at("second"))
    failed = store.reject(got["history"].unionByName(got["speciality"]).where("error is not null").select("url", "error"))
    return len(todo) - failed, failed


def compare(store: Store) -> DataFrame:
    """The comparison of both sources as a table and a CSV file. Returns the counts."""
    for needed in ("links", "records", "second"):
        if not files.exists(store.spark, store.at(needed)):
            raise FileNotFoundError(store.at(needed))
    links = files.read_jsonl(store.spark, store.at("links"), files.strings("temple_id", "confidence"), order="link_ord")[0]
    found = comparing.compare(store.ordered_records(), store.second(), links)
    files.replace(found, store.at("compare"))
    rows = files.read_jsonl(store.spark, store.at("compare"), found.schema)[0]  # computed once
    files.export_csv(rows, store.at("compare.csv"))
    return comparing.compare_stats(rows)


def translate(store: Store, factory: Callable[[], translation.Model], options: translation.Options | None = None, region: str | None = None, limit: int | None = None, checkpoint: int = 50) -> dict[str, int]:
    """Fill English fields that lack. After each `checkpoint` records their translations are appended, the cache first; at the end, or when the next run begins, they are written into the records in one pass."""
    write_english(store)
    stats = {"temples": 0, "fields": 0}
    rows = store.records()
    jobs = records.missing_english(rows if region is None else rows.where(F.col("district_id") == region))
    while limit is None or stats["temples"] < limit:
        left = checkpoint if limit is None else min(checkpoint, limit - stats["temples"])
        pending = incremental.pending(jobs, store.english(), ["temple_id", "field"])
        some = pending.select("temple_id").distinct().orderBy(*numeric_then_text("temple_id")).limit(left)
        mine = cut(pending.join(some, "temple_id", "left_semi"))
        counts = translation.translation_stats(mine, "temple_id").first()
        if not counts["fields"]:
            break
        files.append(translation.translate(mine, ["temple_id", "field"], "ta", store.cache(), factory, options).new_entries, store.at("cache"))
        files.append(translation.translate(mine, ["temple_id", "field"], "ta", store.cache(), factory, options).english, store.at("english"))
        stats = {k: v + counts[k] for k, v in stats.items()}
    write_english(store)
    return stats


def write_english(store: Store) -> None:
    """The records with the translations that were appended; doing it twice changes nothing."""
    if not files.exists(store.spark, store.at("english")):
        return
    last = keep_last(store.english(), ["temple_id", "field"], ["ord"]).drop("ord")
    files.replace(records.write_back(store.records(), last), store.at("records"))
    files.remove(store.spark, store.at("english"))


def export(store: Store) -> None:
    """All records as one CSV and one XLSX file, by region and item."""
    rows = records.flat(records.export_order(store.records()))
    files.export_csv(rows, store.at("records.csv"))
    files.export_xlsx(rows, store.at("records.xlsx"))


def summary(store: Store, region: str | None = None) -> DataFrame:
    """Listed and scraped items by region, in order, with a total."""
    rows = incremental.coverage(store.regions(), store.index(), keep_last(store.records().select("temple_id", "district_id"), ["temple_id"], ["district_id"]), "district_id", "district_name")
    if region is not None:
        rows = rows.where(F.col("district_id") == region)
    return rows.orderBy(*numeric_then_text("district_id"))
