import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from weftline.llm import near_dedup
from weftline.llm.near_dedup import banded_distance, components, drop_near_copies, keys_of, near_classes
from weftline.llm.words import gram_hashes, word_hashes

from .conftest import prose


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("block", [3, 2048])
def test_banded_distance(block, monkeypatch):
    monkeypatch.setattr(near_dedup, "_BLOCK", block)
    rng = random.Random(block)
    for _ in range(3000):
        k = rng.randint(1, 4)
        a = [rng.randint(0, k) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, k) for _ in range(rng.randint(0, 14))] if rng.random() < 0.5 else [x for x in a if rng.random() > 0.1]
        most, d = rng.randint(0, 14), levenshtein(a, b)
        assert banded_distance(np.array(a, dtype=int), np.array(b, dtype=int), most) == (d if d <= most else most + 1)


@given(st.lists(st.text(alphabet="ab \t\n\x0bé ", max_size=20), max_size=5))
def test_word_hashes_follow_words(texts):
    hashes, first = word_hashes(texts)
    words = [t.encode().split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    same = defaultdict(set)
    for w, h in zip(flat, hashes.tolist()):
        same[w].add(h)
    assert all(len(v) == 1 for v in same.values()) and len({h for v in same.values() for h in v}) == len(same)
    assert len(gram_hashes(hashes, 3)) == max(0, len(flat) - 2)


def linked(a, b, threshold=0.8):
    """Whether two lists of words are a link, by the definition alone."""
    longer = max(len(a), len(b))
    most = (1 - threshold) * longer + 1e-9
    if longer - sum((Counter(a) & Counter(b)).values()) > most:
        return False  # each word that one lacks is an edit
    return levenshtein(a, b) <= most


def brute(rows, threshold=0.8):
    """All pairs, compared; of a class the smallest id stays, of its texts the one that `kept` says (None: any)."""
    words = [re.sub("[!-/:-@\\[-`{-~]", " ", (t or "").lower()).split() for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and ((rows[i][1] or "") == (rows[j][1] or "") or (words[i] and words[j] and linked(words[i], words[j], threshold))):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        ids[find(i)].append(k)
    out = []
    for i, (k, _) in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        cls = min(known) if known else None
        out.append((k, cls, len(ids[find(i)]), k == cls))
    return sorted(out, key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = prose(rng, 1)
        elif kind == 1 and len(words) > 10:
            del words[at]
        else:
            words.insert(at, prose(rng, 1))
    return words


def families(seed, groups, size, most=9):
    """Families of near copies at all distances from their base, some copies of copies, a shared passage, and singles."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    rows = []
    for _ in range(groups):
        base = prose(rng, rng.randint(30, 90)).split(" ")
        members = [base]
        for _ in range(size):
            members.append(edited(rng, rng.choice(members[:4]), rng.randint(0, most)))
        rows += [" ".join(m) for m in members]
    rows += [prose(rng, 20) + " " + shared + " " + prose(rng, 20) for _ in range(15)]
    rows += [prose(rng, rng.randint(1, 12)) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def judged(df):
    return sorted((tuple(r) for r in near_classes(df).collect()), key=str)


def test_classes_equal_brute_force(bare):
    rows = families(1, 3, 40)
    assert judged(bare(rows)) == brute(rows)


def test_one_large_family_loses_no_link(bare):
    rows = families(9, 1, 110)
    assert judged(bare(rows)) == brute(rows)


def test_links_that_stars_miss_are_found(bare):
    """Many copies of the first text of each chain make it the pivot; the later ones are links of their neighbours alone."""
    rng = random.Random(21)
    rows = []
    for _ in range(4):
        base = prose(rng, 60).split(" ")
        rows += [" ".join([*base[:k], prose(rng, 1), *base[k + 1 :]]) for k in range(0, 60, 2)]
        text = base
        for step in range(5):
            text = list(text)
            for at in range(step, 60, 6):  # ten of sixty words
                text[at] = prose(rng, 1)
            rows.append(" ".join(text))
    rows = list(enumerate(rows))
    want = brute(rows)
    assert {x[2] for x in want} == {35}
    assert judged(bare(rows)) == want


def test_links_in_large_buckets_that_no_pivot_shows(bare):
    """All texts share a passage, and so buckets; a text has one link, which differs from it in all but a few of its other words."""
    rng = random.Random(33)
    passage, rows = prose(rng, 70).split(" "), []
    for _ in range(200):
        own = prose(rng, 30).split(" ")
        for words in (own, own[:10] + prose(rng, 20).split(" ")):
            rows.append(" ".join(words[:6] + passage + words[6:]))
    rows = list(enumerate(rows))
    want = brute(rows)
    assert {x[2] for x in want} == {2}
    assert judged(bare(rows)) == want


@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.data())
def test_a_link_has_a_part_of_the_longer_text(words, data):
    other = list(words)
    for _ in range(data.draw(st.integers(0, near_dedup.most_edits(len(words), 0.8)))):
        at = data.draw(st.integers(0, len(other) - 1))
        if data.draw(st.booleans()) and len(other) > 1:
            del other[at]
        else:
            other[at] = data.draw(st.integers(0, 3))
    a, b = (np.array(x, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x in (words, other))
    counts = np.array([1 + data.draw(st.integers(0, 9)) for _ in range(4)])
    known = np.sort(gram_hashes(np.arange(4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1))
    parts = near_dedup.parts_of(a, 0.8, known, counts)
    assert set(parts.tolist()) & {h for k in (1, 2) for h in gram_hashes(b, k).tolist()}


@given(st.lists(st.integers(0, 30), min_size=1, max_size=120), st.data())
def test_a_link_has_all_parts_but_its_edits(words, data):
    most, other = near_dedup.most_edits(len(words), 0.8), list(words)
    for _ in range(most):
        at = data.draw(st.integers(0, len(other) - 1))
        if data.draw(st.booleans()) and len(other) > 1:
            del other[at]
        else:
            other[at] = data.draw(st.integers(0, 30))
    a, b = (np.array(x, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x in (words, other))
    counts = np.array([1 + data.draw(st.integers(0, 5)) for _ in range(31)])
    known = np.sort(gram_hashes(np.arange(31, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1))
    parts = near_dedup.parts_of(a, 0.8, known, counts).tolist()
    there = {h for k in (1, 2) for h in gram_hashes(b, k).tolist()}
    assert most < len(parts) <= most + 1 + len(words) // near_dedup.SPARE_WORDS
    assert sum(h in there for h in parts) >= len(parts) - most


def test_texts_that_share_a_rare_word_by_chance_are_not_sent(spark, monkeypatch):
    """Each two texts share a word that no other has; two pairs are links."""
    rng = random.Random(5)
    shared, texts = {}, []
    for i in range(60):
        words = [shared.setdefault((min(i, j), max(i, j)), prose(rng, 1) + f"q{i}z{j}") for j in range(60) if j != i]
        words += [f"{prose(rng, 1)}r{i}" for _ in range(41)]
        rng.shuffle(words)
        texts.append(words)
    texts += [edited(rng, texts[i], 18) for i in (3, 40)]
    node = "cast(_k as decimal(38,0))"
    rows = spark.createDataFrame([(k, " ".join(t), len(t)) for k, t in enumerate(texts)], "_k long, _t string, _words long")
    left = rows.selectExpr("1L as _bucket", f"{node} as _node", "_words", f"{node} as _its")
    sizes, saved = {}, near_dedup.saved

    def counted(df, label):
        out = saved(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "saved", counted)
    monkeypatch.setattr(near_dedup, "KNOWN_HASHES", 0)  # nothing is known to be frequent
    tried = left.selectExpr("_node as _a", "_node as _b").limit(0)
    found = near_dedup.rest_of_links(left, tried, rows.selectExpr(f"{node} as _node", "_t"), 0.8)
    assert sorted((int(r._a), int(r._b)) for r in found.collect()) == [(3, 60), (40, 61)]
    assert sizes["rest"] <= 10


@given(st.lists(st.integers(0, 30), min_size=1, max_size=120), st.data())
def test_a_link_has_its_parts_about_where_they_were(words, data):
    most, other = near_dedup.most_edits(len(words), 0.8), list(words)
    for _ in range(most):
        at = data.draw(st.integers(0, len(other) - 1))
        if data.draw(st.booleans()) and len(other) > 1:
            del other[at]
        else:
            other[at] = data.draw(st.integers(0, 30))
    a, b = (np.array(x, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x in (words, other))
    counts = np.array([1 + data.draw(st.integers(0, 5)) for _ in range(31)])
    known = np.sort(gram_hashes(np.arange(31, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1))
    parts, places = near_dedup.parts_at(a, 0.8, known, counts)
    where, more = defaultdict(list), len(words) - len(other)
    for k in (1, 2):
        for j, h in enumerate(gram_hashes(b, k).tolist()):
            where[h].append(j)
    fit = sum(any(abs(i - j) + abs(more - (i - j)) <= most for j in where[h]) for h, i in zip(parts.tolist(), places.tolist()))
    assert len(set(places.tolist())) == len(places) and fit >= len(parts) - most
    bands = np.array([1 << 3 if h in set(parts.tolist()) else 0 for h in known.tolist()], dtype=np.uint64)
    there = near_dedup.askable(b, 3, known, counts, bands)[0].tolist()
    assert all(h in there for h in parts.tolist() if where[h])


def rest_of_links(spark, monkeypatch, texts, buckets):
    """The links that the exact search finds between texts (lists of words) in buckets (a number for each text), and how many pairs it compares."""
    node = "cast(_k as decimal(38,0))"
    rows = spark.createDataFrame([(k, " ".join(t), len(t), b) for k, (t, b) in enumerate(zip(texts, buckets))], "_k long, _t string, _words long, _bucket long")
    left = rows.selectExpr("_bucket", f"{node} as _node", "_words", f"{node} as _its")
    sizes, saved = {}, near_dedup.saved

    def counted(df, label):
        out = saved(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "saved", counted)
    found = near_dedup.rest_of_links(left, left.selectExpr("_node as _a", "_node as _b").limit(0), rows.selectExpr(f"{node} as _node", "_t"), 0.8)
    return sorted((int(r._a), int(r._b)) for r in found.collect()), sizes["rest"]


def test_texts_with_the_same_parts_elsewhere_are_not_compared(spark, monkeypatch):
    """All in one large bucket; of each text there is one with its halves swapped, and of two there is a link."""
    rng = random.Random(11)
    texts = [prose(rng, 100).split(" ") for _ in range(30)]
    texts += [t[50:] + t[:50] for t in texts]
    texts += [edited(rng, texts[i], 18) for i in (4, 50)]
    links, compared = rest_of_links(spark, monkeypatch, texts, [1] * len(texts))
    assert links == [(4, 60), (50, 61)] and compared == 2


@pytest.mark.parametrize("spread", [False, True])
def test_recall_at_all_rates_and_lengths(bare, spread):
    """Pairs of 5 to 500 words with 2 to 20 % of the words edited, end to end; recall of the links that the definition gives."""
    rng = random.Random(30 + spread)
    rows, links = [], []
    for n in (5, 9, 10, 14, 25, 39, 45, 60, 120, 300, 500):
        for rate in (0.02, 0.05, 0.1, 0.15, 0.2):
            for _ in range(4):
                a = prose(rng, n).split(" ")
                if spread:
                    b = [prose(rng, 1) if k % round(1 / rate) == 1 else w for k, w in enumerate(a)]
                else:
                    b = edited(rng, a, int(rate * n))
                rows += [" ".join(a), " ".join(b)]
                if linked(a, b):
                    links.append((len(rows) - 2, len(rows) - 1))
    cls = {r._id: r.class_id for r in near_classes(bare(list(enumerate(rows)))).collect()}
    found = sum(cls[a] == cls[b] for a, b in links)
    assert len(links) > 150 and found >= 0.97 * len(links)
    assert len(set(cls.values())) >= len(rows) - len(links)  # nothing else is linked


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = {(r._id, r.class_id, r.class_size, r.kept) for r in near_classes(odd_docs).collect()}
    assert {x for x in got if x[1] == 1} == {(1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False)}
    assert {x for x in got if x[1] == 3} == {(3, 3, 3, True), (4, 3, 3, False), (None, 3, 3, False)}
    assert {x[0] for x in got if x[1] == 6} == {6, 7}
    assert len(rows) == near_classes(odd_docs).count()
    kept = drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 8, 9]
    assert near_classes(no_docs).count() == 0 and drop_near_copies(no_docs).count() == 0


def test_every_class_keeps_one_row(bare):
    rng = random.Random(14)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    rows = [(None, a), (1, a + " end"), (None, b), (5, c + " end"), (5, d), (3, c), (7, e), (7, e), (7, e + " end"), (None, b)]
    kept = [tuple(r) for r in drop_near_copies(bare(rows)).collect()]
    assert sorted((i, t.removesuffix(" end")) for i, t in kept if i) == [(1, a), (3, c), (5, d), (7, e)]
    assert [t for i, t in kept if i is None] == [b]


def test_case_and_punctuation_do_not_matter(bare):
    words = prose(random.Random(6), 40)
    rows = [(1, words), (2, words.replace(" ", ", ").upper()), (3, words.replace(" ", ". ", 20).title()), (4, "!!!"), (5, "???"), (6, "!!!")]
    assert {r._id: r.class_id for r in near_classes(bare(rows)).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 4}


def test_repetitive_texts_are_found(bare):
    rng = random.Random(16)
    rows = []
    for k in range(6):
        head, line = prose(rng, 100), prose(rng, 20).split(" ")
        other = [*line[:9], "xx", "yy", *line[11:]]
        rows += [head + (" " + " ".join(line)) * 10, head + (" " + " ".join(other)) * 10]
        rows += [" ".join([f"w{k}"] * n) for n in (5, 6)]  # one word, repeated
    rows = list(enumerate(rows))
    want = brute(rows)
    assert {x[2] for x in want} == {2}
    assert judged(bare(rows)) == want


def test_order_decides(bare):
    """The same passages in another order are no near copy, those in the same other order are."""
    rng = random.Random(8)
    parts = [prose(rng, 30) for _ in range(4)]
    rows = [(k, " ".join(parts) + f" end{k}") for k in range(6)] + [(10 + k, " ".join(parts[::-1]) + f" end{k}") for k in range(6)]
    assert {r._id: r.class_id for r in near_classes(bare(rows)).collect()} == {k: 0 if k < 10 else 10 for k, _ in rows}
    a, b = (word_hashes([t])[0] for t in (" ".join(parts), " ".join(parts[::-1])))
    assert len(set(keys_of(a, 0.8).tolist()) & set(keys_of(b, 0.8).tolist())) < 20


def test_components_of_a_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 20], "_a long, _b long")
    got = {r._node: r._class for r in components(edges).collect()}
    assert got == {i: (0 if i <= 20 else 21) for i in range(n + 1)}
