import random
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.llm.decontaminate import drop_leaks, find_leaks, tile
from weftline.llm.mixing import mix
from weftline.llm.queries import mixed, op7_sql
from weftline.llm.words import normal

from .conftest import prose


def plain_tiles(text, item, least):
    """Greedy string tiling as it is defined: again and again, mark a longest match of unmarked words."""
    free_t, free_i, tiles = [True] * len(text), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] and free_t[i + n] and free_i[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return tiles
        tiles.append(n)
        free_t[i : i + n] = [False] * n
        free_i[j : j + n] = [False] * n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=22), st.lists(st.integers(0, 3), max_size=14), st.integers(2, 4))
def test_tiles(text, item, least):
    got = tile(np.array(text, dtype=np.uint64), np.array(item, dtype=np.uint64), least)
    used_t, used_i = set(), set()
    for i, j, n in got:
        assert n >= least and text[i : i + n] == item[j : j + n]
        a, b = set(range(i, i + n)), set(range(j, j + n))
        assert not a & used_t and not b & used_i
        used_t |= a
        used_i |= b
    want = plain_tiles(text, item, least)
    assert (max((n for *_, n in got), default=0)) == max(want, default=0)  # ties may be broken otherwise later on
    # nothing of the least length is left unmarked
    free = [(i, j) for i in range(len(text) - least + 1) for j in range(len(item) - least + 1) if text[i : i + least] == item[j : j + least] and not set(range(i, i + least)) & used_t and not set(range(j, j + least)) & used_i]
    assert not free


def test_leaks_whole_reordered_partial_and_clean(spark, odd_docs, no_docs):
    rng = random.Random(8)
    items = [prose(rng, n) for n in (30, 50, 14, 4, 0)]
    w = items[1].split(" ")
    docs = [
        prose(rng, 50) + " " + items[0].upper() + ", " + prose(rng, 30),
        " ".join([*w[30:], *prose(rng, 3).split(" "), *w[:30]]),  # reordered
        " ".join(w[:20]) + " " + prose(rng, 60),  # a part only
        ", ".join(items[2].split(" ")) + "!",
        items[3] + " " + prose(rng, 10),  # too short an item
        prose(rng, 300),
        " ".join(w[:24] + ["x"] + w[25:]),
    ]
    frame = spark.createDataFrame(list(enumerate(docs)) + [(None, items[0]), (99, None)], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (10, items[0]), (11, None), (None, items[2])], "item_id long, text string")
    want = {(0, 0), (0, 10), (1, 1), (3, 2), (3, None), (6, 1), (None, 0), (None, 10)}
    for block_words in (10**6, 40):  # one block, and many
        got = find_leaks(frame, bench, block_words=block_words).collect()
        assert {(r._id, r._item) for r in got} == want and len(got) == len(want)
    by = {(r._id, r._item): r for r in got}
    assert by[(1, 1)].n_tiles == 2 and by[(1, 1)].coverage == 1.0
    assert sorted(r.doc_id for r in drop_leaks(frame, bench, block_words=40).collect()) == [2, 4, 5, 99]
    assert drop_leaks(odd_docs, bench).columns == odd_docs.columns and drop_leaks(odd_docs, bench).count() == odd_docs.count()
    assert find_leaks(no_docs, bench).count() == 0 and find_leaks(frame, bench.where("false")).count() == 0


def test_copies_of_repetitive_items_are_leaks(spark):
    rng = random.Random(12)
    phrases = [(5, 10), (6, 8), (8, 10), (1, 40)]
    items = [" ".join([prose(rng, n)] * times) for n, times in phrases]
    part = " ".join([*items[0].split(" ")[:30], *prose(rng, 20).split(" ")])  # 0.6 of the item
    docs = [*items, *(prose(rng, 20) + " " + x + " " + prose(rng, 20) for x in items), part, " ".join([items[3]] * 50)]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r._id, r._item): r.coverage for r in find_leaks(frame, bench).collect()}
    assert got == {(i, i % 4): 1.0 for i in range(8)} | {(9, 3): 1.0}
    assert [r.doc_id for r in drop_leaks(frame, bench).collect()] == [8]


def test_leaks_equal_plain_tiling_on_repetitive_texts(spark):
    rng = random.Random(17)
    docs = [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 30))) for _ in range(120)]
    items = [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 14))) for _ in range(12)]
    want = {(i, k): sum(plain_tiles(t.split(), x.split(), 5)) / len(x.split()) for i, t in enumerate(docs) for k, x in enumerate(items)}
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r._id, r._item): r.coverage for r in find_leaks(frame, bench).collect()}
    assert got == {k: share for k, share in want.items() if share >= 0.8} and len(got) > 50


def test_normal_words():
    assert normal("A, b’s “C”…d").split() == ["a", "b", "s", "c", "d"]


def water(children, budget):
    """Shares by weight under caps, exactly: fill until someone is full, again and again."""
    got = {k: Fraction(0) for k in children}
    live = {k for k, (w, c) in children.items() if w and c}
    left = Fraction(min(budget, sum(children[k][1] for k in live)))
    while live and left:
        total = sum(children[k][0] for k in live)
        step = min([(children[k][1] - got[k]) / Fraction(children[k][0]) for k in live] + [left / total])
        for k in live:
            got[k] += step * children[k][0]
        left -= step * total
        live = {k for k in live if got[k] < children[k][1]}
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_budgets_against_water_filling(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        rows.append((i, " ".join(["w"] * rng.randint(0, 40)), rng.choice("ab") if i % 3 else "a", rng.choice("xyz") if i % 5 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weights = {"lang": {"a": 1, "b": 5}, "source": {"x": 3, "y": 0}}
    out = mix(docs, [("lang", F.col("lang")), ("source", F.col("source"))], weights, budget_share=0.6, max_epochs=2).collect()
    size = {i: len(t.split()) for i, t, _, _ in rows}
    leaf = {i: (a, b or "") for i, _, a, b in rows}
    have = defaultdict(int)
    for i, k in leaf.items():
        have[k] += size[i]
    w_lang, w_src = {"a": 1, "b": 5}, {"x": 3, "y": 0}
    caps = {k: 2 * n if w_src.get(k[1], 1) else 0 for k, n in have.items()}
    budget = int(sum(caps.values()) / 2 * 0.6)
    langs = water({a: (w_lang[a], sum(c for k, c in caps.items() if k[0] == a)) for a in "ab"}, budget)
    got = defaultdict(int)
    for r in out:
        got[(r.lang, r.source)] += r.n_tokens
        assert (r.lang, r.source) == leaf[r._id] and r.n_tokens == size[r._id]
    for a in "ab":
        want = water({k: (w_src.get(k[1], 1), c) for k, c in caps.items() if k[0] == a}, int(langs[a]))
        for k, n in want.items():
            assert float(n) - 3 <= got[k] <= float(n) + 43, (k, float(n), got[k])
    seen = defaultdict(set)
    for r in out:
        assert r.epoch not in seen[r._id]
        seen[r._id].add(r.epoch)


def test_cells_and_oracle(spark, odd_docs, no_docs, monkeypatch):
    """The same rows as SQL, with cells so small that leaves have many."""
    import weftline.llm.mixing as mixing

    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(0, 30)), rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "src1", "src2", "src3", "other", None])) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = docs.toPandas()  # noqa: F841 - read by duckdb
    con = duckdb.connect()
    con.register("frame", frame)
    want = sorted(con.sql(op7_sql("frame")).fetchall(), key=str)
    for rows_per_cell in (4096, 4):
        monkeypatch.setattr(mixing, "CELL_ROWS", rows_per_cell)
        assert sorted((tuple(r) for r in mixed(docs).collect()), key=str) == want
    odd = odd_docs.select("doc_id", "text", "lang", "source").toPandas()
    odd["doc_id"] = odd["doc_id"].astype("Int64")
    con.register("odd", odd)
    assert sorted((tuple(r) for r in mixed(odd_docs).collect()), key=str) == sorted(con.sql(op7_sql("odd")).fetchall(), key=str)
    assert mixed(no_docs).count() == 0


def test_a_hot_id_is_counted_not_sorted(spark):
    """Most rows have no id: the same rows as SQL, which sorts them one by one."""
    rng = random.Random(9)
    rows = [(i if i % 4 == 0 else None, " ".join(["w"] * rng.choice([0, 1, 2, 7])), "en", "src0") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    con = duckdb.connect()
    frame = docs.toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("frame", frame)
    assert sorted((tuple(r) for r in mixed(docs).collect()), key=str) == sorted(con.sql(op7_sql("frame")).fetchall(), key=str)
