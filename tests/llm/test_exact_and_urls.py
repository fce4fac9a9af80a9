import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.exact_dedup import drop_copies, exact_dedup
from weftline.llm.queries import URL_RULES
from weftline.llm.url_filter import judge_urls, rules_frame


def brute(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = (max if largest else min)(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_on_odd_rows(odd_docs, keep):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted((tuple(r) for r in exact_dedup(odd_docs, keep=keep, runs=16, fan_in=4).collect()), key=str)
    assert got == brute(rows, keep == "largest")


def test_levels_merge_hot_groups(bare):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(600)]
    got = sorted((tuple(r) for r in exact_dedup(bare(rows), keep="largest", runs=64, fan_in=4).collect()), key=str)
    assert got == brute(rows, True)


def test_drop_copies_keeps_columns(odd_docs, no_docs):
    kept = drop_copies(odd_docs, keep="largest")
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "6", "7", "8", "9"]
    assert drop_copies(no_docs).count() == 0 and exact_dedup(no_docs).count() == 0


def test_a_copy_takes_no_other_row_of_its_id(bare):
    rows = [(None, "a"), (1, "a"), (None, "b"), (5, "c"), (5, "d"), (9, "c"), (9, "c"), (None, "e"), (None, "e")]
    for keep, want in (("largest", [(1, "a"), (5, "d"), (9, "c"), (None, "b"), (None, "e")]), ("smallest", [(1, "a"), (5, "c"), (5, "d"), (None, "b"), (None, "e")])):
        assert sorted((tuple(r) for r in drop_copies(bare(rows), keep=keep).collect()), key=str) == sorted(want, key=str)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "", "a", "b", "c"])), min_size=1, max_size=12), st.sampled_from(["smallest", "largest"]))
def test_every_text_has_one_row(spark, rows, keep):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in exact_dedup(docs, keep=keep, runs=4, fan_in=2).collect()), key=str) == brute(rows, keep == "largest")
    ids = defaultdict(list)
    for i, t in rows:
        ids[t or ""].append(i)
    want = {t: (max if keep == "largest" else min)([i for i in v if i is not None], default=None) for t, v in ids.items()}
    got = [(r.text or "", r.doc_id) for r in drop_copies(docs, keep=keep).collect()]
    assert len(got) == len(want) and dict(got) == want


def verdict(url, rules, otherwise="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h) + len(p), len(h), h, p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] + best[3] if best else None, best[4] if best else otherwise


URLS = [
    None, "", "no scheme", "http://", "https://COM/", "http://a.example.com/en/x?y#z", "http://www.example.com/en/", "http://x.www.example.com/en/1",
    "http://example.com", "http://notexample.com/en/1", "https://t.example.net/es/1", "https://t.example.net/en/es/", "http://net/fr/", "http://fooNET/fr/1",
    "ftp://a.b://c.com/en/", "http://.com/x", "http://com./x", "http://example.com:80/en/", "http://ünï.com/é", "http://www.example.com/EN/", "http://a..example.com/en/q", "http://x.net?/es/", "http://x.net#/es/",
]


def test_urls_against_brute_force(spark):
    rules = [*URL_RULES, ("block", "example.com", "/en/deep/"), ("block", "b.com", "/"), ("allow", "a.b.com", "/x"), ("block", "com", "/x")]
    urls = [*URLS, "http://a.b.com/x/y", "http://a.b.com/q", "http://z.a.b.com/x", "http://example.com/en/deep/1"]
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)] + [(None, "http://a.com/", "h", "k"), (0, None, "h", "k")], "page_id long, url string, host string, key string")
    want = sorted(((r.page_id, *verdict(r.url, rules)) for r in pages.collect()), key=str)
    for ranges in (1, 3, 20):
        assert sorted((tuple(r) for r in judge_urls(pages, rules_frame(spark, rules), ranges=ranges).collect()), key=str) == want


def test_a_hot_host_is_in_many_ranges(spark):
    """Most urls have one host; stacks are carried over ranges without a boundary."""
    urls = [f"http://hot.example.com/en/{i}" if i % 3 else f"http://h{i % 7}.net/{'es' if i % 2 else 'x'}/" for i in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = sorted((tuple(r) for r in judge_urls(pages, rules_frame(spark, URL_RULES), ranges=16).collect()), key=str)
    assert got == sorted(((i, *verdict(u, URL_RULES)) for i, u in enumerate(urls)), key=str)


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(pages, rules_frame(spark, []), otherwise="block").collect()] == ["block"]
    assert judge_urls(pages.where("false"), rules_frame(spark, URL_RULES)).count() == 0
