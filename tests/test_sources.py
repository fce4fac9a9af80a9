import csv
import threading
import zipfile
from email.utils import formatdate

import pytest

from weftline.operators.records import export_order, flat
from weftline.sources import files
from weftline.sources.fetch import FetchError, PoliteClient, Reply, fetch_pages, from_table, retry_after


def client(replies, **how):
    calls, sleeps = [], []

    def transport(url):
        calls.append(url)
        r = replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    return PoliteClient(transport, pause=(0, 0), backoff=0.5, sleep=sleeps.append, **how), calls, sleeps


def test_retries_pauses_and_decoding():
    c, calls, sleeps = client([Reply(503), Reply(429, headers={"retry-after": "7"}), Reply(200, "தமிழ்".encode() + b"\xff", {"content-type": "text/html; charset=latin-1"})])
    assert c.get_text("u") == "தமிழ்�" and len(calls) == 3 and any(6 < s <= 7 for s in sleeps)
    c, calls, _ = client([TimeoutError("slow")] * 3, attempts=3)
    with pytest.raises(FetchError, match="after 3 attempts"):
        c.get_text("u")
    assert len(calls) == 3
    c, calls, _ = client([Reply(404)])
    with pytest.raises(FetchError, match="404"):
        c.get_text("u")
    assert len(calls) == 1
    c, calls, sleeps = client([Reply(429, headers={"retry-after": "0"}), Reply(200, b"x")])
    assert c.get_text("u") == "x" and max(sleeps) > 0.1  # zero seconds: the usual pause


def test_at_most_three_in_flight(spark):
    lock, now, most = threading.Lock(), [0], [0]

    def transport(url):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        threading.Event().wait(0.01)
        with lock:
            now[0] -= 1
        return Reply(404 if url == "u5" else 200, url.encode())

    c = PoliteClient(transport, slots=50, pause=(0, 0), sleep=lambda s: None)
    rows = fetch_pages(spark, [f"u{i}" for i in range(12)], c, 50).collect()
    assert most[0] <= 3 and [r.url for r in rows if r.error] == ["u5"] and rows[0].html == "u0"


def test_retry_after():
    assert retry_after("12") == 12.0 and retry_after("-3") == 0.0 and retry_after(None) is None and retry_after("soon") is None
    assert retry_after(formatdate(1_000_010, usegmt=True), now=1_000_000) == 10.0


def test_pages_table(spark):
    pages = spark.createDataFrame([("a", "1"), ("a", "0")], "url string, html string")
    got = {r.url: (r.html, r.error) for r in from_table(spark.createDataFrame([("a",), ("b",)], "url string"), pages).collect()}
    assert got["a"] == ("0", None) and got["b"][1]


def test_csv_with_mark_quotes_and_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(files.csv_text(files.INDEX.names, [["1", 'a "q", b', "7", "two\nlines"], ["", "", "8", ""]]), encoding="utf-8")
    rows = files.read_csv(spark, str(path), files.INDEX)
    assert {tuple(r) for r in rows.collect()} == {("1", 'a "q", b', "7", "two\nlines"), ("", "", "8", "")}
    assert files.read_csv(spark, str(tmp_path / "none.csv"), files.INDEX).count() == 0


def test_jsonl_tolerant_strict_and_odd_line_breaks(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"h":"a","en":"one two\x85three","m":"m"}\n{"h":"b","en":"cu\n\n{"h":"c","en":"z"}\n', encoding="utf-8")
    good, bad = files.read_jsonl(spark, str(path), files.CACHE)
    assert {r.h: r.en for r in good.collect()} == {"a": "one two\x85three", "c": "z"}
    assert [r._corrupt_record for r in bad.collect()] == ['{"h":"b","en":"cu']
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_jsonl(spark, str(path), files.CACHE, strict=True)[0].collect()
    assert files.read_jsonl(spark, str(tmp_path / "none"), files.CACHE)[0].count() == 0


def test_append_replace_and_links(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = spark.createDataFrame([("a", None, "m")], files.CACHE)
    files.append(rows, path)
    files.append(rows, path)
    assert files.read_jsonl(spark, path, files.CACHE)[0].count() == 2
    files.replace(files.read_jsonl(spark, path, files.CACHE)[0].limit(1), path)
    assert [tuple(r) for r in files.read_jsonl(spark, path, files.CACHE)[0].collect()] == [("a", None, "m")]
    links = spark.createDataFrame([("1", "7"), ("2", ""), ("", "8"), ("3", "²"), ("4", None)], "temple_id string, tid string")
    assert [r.temple_id for r in files.linked(links).collect()] == ["1"]


def test_failures(spark, tmp_path):
    rows = files.failures(spark.createDataFrame([("u", "a\n b\t c")], "url string, error string"), "url", "error")
    assert rows.first().reason == "a b c"
    files.log_failures(rows, str(tmp_path / "failed"))
    line = spark.read.text(str(tmp_path / "failed")).first().value
    assert line.endswith("\tu\ta b c")


def test_export(spark, tmp_path):
    schema = files.record_schema()
    base = {c: None for c in schema.names}
    rows = [base | {"temple_id": "10", "district_id": "2", "history_ta": "x" * 40_000 + "\x01", "gallery": [("a", 'q"')], "extra_ta": {"k": "v"}}, base | {"temple_id": "9", "district_id": "2"}, base | {"temple_id": "1", "district_id": "D1"}, base | {"temple_id": "2", "district_id": ""}]
    frame = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
    out = flat(export_order(frame))
    files.export_csv(out, tmp_path / "r.csv")
    files.export_xlsx(out, tmp_path / "r.xlsx")
    raw = (tmp_path / "r.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf") and raw.count(b"\xef\xbb\xbf") == 1
    with open(tmp_path / "r.csv", encoding="utf-8-sig", newline="") as f:
        found = list(csv.DictReader(f))
    assert [r["temple_id"] for r in found] == ["2", "9", "10", "1"] and list(found[0]) == schema.names
    assert len(found[2]["history_ta"]) == 40_001 and found[2]["gallery"] == '[{"caption_ta":"a","caption_en":"q\\""}]' and found[2]["extra_ta"] == '{"k":"v"}' and found[1]["gallery"] == ""
    with zipfile.ZipFile(tmp_path / "r.xlsx") as book:
        sheet = book.read("xl/worksheets/sheet1.xml").decode()
    assert sheet.count("<row>") == 5 and "x" * 32_767 + "</t>" in sheet and "x" * 32_768 not in sheet


def test_summary_text(spark):
    rows = spark.createDataFrame([("1", "One", 12), ("TOTAL", "", 12)], "id string, name string, n long")
    assert files.summary_text(rows, ["id", "name", "n"]) == "id     name   n\n1      One   12\nTOTAL        12"
    assert files.summary_text(rows.where("false"), ["id"]) == ""
