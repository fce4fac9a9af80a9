import pytest
from pyspark.sql import functions as F

from weftline import cli
from weftline.operators import translation
from weftline.plans import stages
from weftline.plans.settings import Settings
from weftline.sources import files
from weftline.streaming.pages import stream_records

BASE = "https://site.example"
SETTINGS = Settings(base_url=BASE, second_base_url="https://second.example/")


class Pages:
    """A fetcher over a dict; unknown urls fail."""

    def __init__(self, pages):
        self.pages, self.asked = dict(pages), []

    def get_text(self, url):
        self.asked.append(url)
        if url not in self.pages:
            raise OSError("no route")
        return self.pages[url]


def listing(ids, following=None):
    return "".join(f'<a href="new.php?id={i}">{i}. Name {i}</a>' for i in ids) + (f'<a href="{following}">Next &gt;&gt;</a>' if following else "")


def detail(town, english=False, tid=""):
    return f'<div class="TabbedPanelsContent"><span class="topic">கோயில் {tid}</span><table><tr><td class="style8">ஊர்</td><td>:</td><td>{town}</td></tr></table>' + (f'<a href="en/new_en.php?id={tid}">E</a>' if english else "") + "</div>"


@pytest.fixture
def store(spark, tmp_path):
    return stages.Store(spark, str(tmp_path / "out"))


def region_pages():
    return {
        f"{BASE}/district_temple_list.php": '<a href="district_temple.php?id=1">One</a><a href="district_temple.php?id=2">Two</a>',
        f"{BASE}/district_temple.php?id=1": listing([1, 2], "district_temple.php?id=1&Page=2"),
        f"{BASE}/district_temple.php?id=1&Page=3": listing([4]),
        f"{BASE}/district_temple.php?id=2": listing([5]),
    }


def test_regions_and_index_resume(store):
    pages = Pages(region_pages())
    assert stages.regions(store, pages, SETTINGS) == 2
    assert stages.regions(store, pages, SETTINGS) == 2 and len(pages.asked) == 1
    pages.asked.clear()
    assert stages.index(store, pages, SETTINGS) == 1  # page 2 of region 1 fails
    assert store.progress()["1"] == {"last_page": 1, "complete": False, "temples": 2} and store.progress()["2"]["complete"]
    pages.pages[f"{BASE}/district_temple.php?id=1&Page=2"] = listing([2, 3], "district_temple.php?id=1&Page=3")
    pages.asked.clear()
    assert stages.index(store, pages, SETTINGS) == 0
    assert pages.asked == [f"{BASE}/district_temple.php?id=1&Page=2", f"{BASE}/district_temple.php?id=1&Page=3"]
    assert {(r.temple_id, r.district_id) for r in store.index().collect()} == {("1", "1"), ("2", "1"), ("3", "1"), ("4", "1"), ("5", "2")}
    pages.asked.clear()
    assert stages.index(store, pages, SETTINGS) == 0 and pages.asked == []
    assert {tuple(r) for r in stages.summary(store).collect()} == {("1", "One", 4, 0), ("2", "Two", 1, 0)}


def test_no_regions_is_an_error(store):
    with pytest.raises(RuntimeError):
        stages.regions(store, Pages({f"{BASE}/district_temple_list.php": "<p>"}), SETTINGS)
    assert store.spark.read.text(store.at("failed")).count() == 1


def records_of(store):
    return {r.temple_id: r for r in store.records().collect()}


def filled(store):
    pages = Pages(region_pages() | {f"{BASE}/district_temple.php?id=1": listing([1, 2, 3])})
    stages.regions(store, pages, SETTINGS)
    stages.index(store, pages, SETTINGS)
    pages.pages |= {f"{BASE}/new.php?id=1": detail("ஊர்", True, "1"), f"{BASE}/en/new_en.php?id=1": detail("Town"), f"{BASE}/new.php?id=2": "<p>empty", f"{BASE}/new.php?id=3": detail("ஊர் மூன்று")}
    return pages


def test_records_rejects_provenance_and_resume(store):
    pages = filled(store)
    pages.asked.clear()
    with pytest.raises(ValueError):
        stages.record_stage(store, pages, SETTINGS, region="9")
    assert stages.record_stage(store, pages, SETTINGS, region="1", limit=2) == (1, 1)
    assert pages.asked[:2] == [f"{BASE}/new.php?id=1", f"{BASE}/new.php?id=2"] or set(pages.asked) == {f"{BASE}/new.php?id=1", f"{BASE}/new.php?id=2", f"{BASE}/en/new_en.php?id=1"}
    assert stages.record_stage(store, pages, SETTINGS) == (1, 2)  # 2 is empty again, 5 has no page
    rows = records_of(store)
    assert set(rows) == {"1", "3"}
    assert (rows["1"].english_page, rows["1"].town_en, rows["1"].town_source_en, rows["1"].town_ta, rows["1"].district_name) == ("yes", "Town", "site", "ஊர்", "One")
    assert (rows["3"].english_page, rows["3"].town_en, rows["3"].town_source_en) == ("no", "", "")
    pages.pages[f"{BASE}/new.php?id=2"] = detail("ஊர் இரண்டு")
    pages.asked.clear()
    assert stages.record_stage(store, pages, SETTINGS, region="1") == (1, 0)
    assert pages.asked == [f"{BASE}/new.php?id=2"]


def test_categories_whole_lists_only(store, monkeypatch):
    pages = filled(store)
    stages.record_stage(store, pages, SETTINGS)
    monkeypatch.setattr(stages, "CATEGORIES", [(2, "A", "a.php", None), (24, "B", "hub.php", "l.php?"), (5, "C", "c.php", None)])
    pages.pages |= {
        f"{BASE}/a.php": listing([3, 7], "a.php?Page=2"),
        f"{BASE}/a.php?Page=2": listing([7, 8], "a.php?Page=2"),
        f"{BASE}/hub.php": '<a href="l.php?x=1">1</a><a href="l.php?x=1">1</a><a href="o.php">2</a>',
        f"{BASE}/l.php?x=1": listing([8]),
        f"{BASE}/c.php": listing([9], "c.php?Page=2"),
        f"{BASE}/new.php?id=7": detail("ஏழு"),
        f"{BASE}/new.php?id=8": detail("எட்டு"),
    }
    assert stages.categories(store, pages, SETTINGS) == (2, 1)  # C fails on its second page
    rows = {(r.category_no, r.temple_id): r.source for r in store.categories().collect()}
    assert rows == {("2", "3"): "existing", ("2", "7"): "new", ("2", "8"): "new", ("24", "8"): "new"}
    assert {"7", "8"} <= set(records_of(store)) and records_of(store)["7"].district_id == ""
    pages.asked.clear()
    pages.pages[f"{BASE}/c.php?Page=2"] = listing([3])
    assert stages.categories(store, pages, SETTINGS, number=5)[1] == 1  # 9 has no page
    assert set(pages.asked) == {f"{BASE}/c.php", f"{BASE}/c.php?Page=2", f"{BASE}/new.php?id=9"}
    assert [r.district_id for r in stages.summary(store).collect()][0] == ""


def test_link_second_and_compare(store):
    pages = filled(store)
    name = "அருள்மிகு கபாலர் திருக்கோயில்"
    pages.pages[f"{BASE}/new.php?id=1"] = f'<div class="TabbedPanelsContent"><span class="topic">{name}</span><table><tr><td class="style8">ஊர்</td><td>:</td><td>மணிமங்கலம்</td></tr></table><table><tr><td><img src="/l.gif">முகவரி</td></tr><tr><td class="newsdetails">x - 601 301</td></tr></table></div>'
    stages.record_stage(store, pages, SETTINGS)
    with pytest.raises(FileNotFoundError):
        stages.compare(store)
    lines = store.spark.createDataFrame([(1, 0, "1 TM000077 அ௠ள்௘ஶ கபாலர், மணிமங்கலம் - 601301 x")], "page int, line_no int, line string")
    assert tuple(stages.link(store, lines).first())[:3] == (1, 2, 1)
    assert (store.at("links.csv") and open(store.at("register.csv"), encoding="utf-8-sig").read().startswith("hrce_no,tid,name"))
    second = Pages({"https://second.example/history.php?tid=77": f'<title>A [TM000077]</title>{name}, மணிமங்கலம் - 601301, காஞ்சிபுரம் மாவட்டம்<div class="history-con"><p class="pgh_text">{"வரலாறு " * 20}</p></div>'})
    assert stages.second(store, second, SETTINGS) == (0, 1)
    second.pages["https://second.example/speciality.php?tid=77"] = "<table><tr><td>1<td>பரிகாரம்<td>ராகு</table>"
    assert stages.second(store, second, SETTINGS) == (1, 0)
    second.asked.clear()
    assert stages.second(store, second, SETTINGS) == (0, 0) and second.asked == []
    stats = stages.compare(store).first()
    assert (stats.read, stats.confirmed, stats.two_source_pariharam) == (1, 1, 1)


def test_translate_and_export(store):
    from .test_operators import Words

    pages = filled(store)
    stages.record_stage(store, pages, SETTINGS)
    assert stages.translate(store, Words, translation.Options(), checkpoint=1) == {"temples": 1, "fields": 2}
    rows = records_of(store)
    assert (rows["1"].town_en, rows["1"].town_source_en, rows["3"].town_source_en, rows["3"].town_en) == ("Town", "site", "machine", "ஊர் மூன்று")
    assert stages.translate(store, Words) == {"temples": 0, "fields": 0}
    stages.export(store)
    assert open(store.at("records.csv"), encoding="utf-8-sig").read().count("machine") == 2


def test_streamed_pages_append_once(spark, tmp_path):
    index = spark.createDataFrame([("1", "9", "Nine"), ("2", "9", "Nine")], "temple_id string, district_id string, district_name string")
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    page = lambda rows: spark.createDataFrame(rows, "url string, html string").write.mode("append").parquet(src)
    page([("x/new.php?id=1", detail("ஊர்")), ("x/new.php?id=1", detail("ஊர்")), ("x/new.php?id=2", "<p>"), ("x/other.php", detail("ஊர்"))])
    stream_records(spark, src, index, out, check).awaitTermination()
    page([("x/new.php?id=1", detail("again")), ("x/new.php?id=2", detail("இரண்டு"))])
    stream_records(spark, src, index, out, check).awaitTermination()
    rows = {r.temple_id: r.town_ta for r in files.read_jsonl(spark, out, files.record_schema())[0].collect()}
    assert rows == {"1": "ஊர்", "2": "இரண்டு"} and files.read_jsonl(spark, out, files.record_schema())[0].agg(F.count("*")).first()[0] == 2


def test_arguments(monkeypatch):
    assert cli.parse_args([]).stage == "all" and cli.parse_args(["--stage", "3", "--district", "4", "--limit", "2"]).limit == 2
    assert (cli.parse_args(["--stage", "categories", "--category", "24"]).category, cli.parse_args(["--stage", "translate"]).model) == (24, None)
    for bad in (["--stage", "9"], ["--limit", "0"], ["--stage", "link"], ["--district", "north"], ["--category", "23"], ["--category", "x"]):
        with pytest.raises(SystemExit) as e:
            cli.parse_args(bad)
        assert e.value.code == 2
    monkeypatch.setenv("CONCURRENCY", "50")
    assert Settings().slots == 3


def test_log_of_the_day(tmp_path):
    import logging

    at = cli.start_log(str(tmp_path))
    cli.start_log(str(tmp_path), verbose=True)
    logging.getLogger("x").debug("said once")
    logging.shutdown()
    assert at.parent == tmp_path / "logs" and at.read_text().count("said once") == 1
    logging.basicConfig(force=True)


def test_translations_survive_a_run_that_dies(store, monkeypatch):
    """What was appended before the run died is written into the records by the next one, and not translated again."""
    from .test_operators import Words

    pages = filled(store)
    stages.record_stage(store, pages, SETTINGS)
    monkeypatch.setattr(stages.records, "write_back", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        stages.translate(store, Words)
    assert records_of(store)["3"].town_en == "" and store.english().count() == 2
    monkeypatch.undo()
    assert stages.translate(store, Words) == {"temples": 0, "fields": 0} and records_of(store)["3"].town_en == "ஊர் மூன்று"
    assert not files.exists(store.spark, store.at("english"))


def test_replacing_never_loses_the_old_rows(spark, tmp_path):
    at = str(tmp_path / "rows")
    schema = files.strings("a")
    files.replace(spark.createDataFrame([("1",)], schema), at)
    files.replace(spark.createDataFrame([("2",)], schema), at)
    assert [r.a for r in files.read_jsonl(spark, at, schema)[0].collect()] == ["2"]
    (tmp_path / "rows").rename(tmp_path / "rows.old")  # a run died between the two renames
    assert [r.a for r in files.read_jsonl(spark, at, schema)[0].collect()] == ["2"] and not (tmp_path / "rows.old").exists()
