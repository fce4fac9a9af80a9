import hashlib
import random
from collections import Counter

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weftline.llm import substring_dedup
from weftline.llm.substring_dedup import find_repeats, without_spans

from .conftest import prose


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        marked = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                marked[i : i + window] = [True] * window
        kept = b" ".join(x for x, m in zip(w, marked) if not m)
        out.append((len(w), sum(marked), hashlib.sha256(kept).hexdigest()))
    return out


def check(bare, texts, window):
    got = {r._id: r for r in find_repeats(bare(list(enumerate(texts))), window=window).collect()}
    want = brute(texts, window)
    assert [(got[i].n_words, got[i].n_removed, got[i].kept_sha256) for i in range(len(texts))] == want
    for i, t in enumerate(texts):
        assert hashlib.sha256(without_spans(t, got[i].spans).encode()).hexdigest() == want[i][2]


def test_passages_copies_and_repeats(bare):
    rng = random.Random(4)
    passages = [prose(rng, n) for n in (34, 35, 36, 60, 400)]
    texts = []
    for k in range(60):
        parts = [prose(rng, rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split(" ")
            a = rng.randrange(max(1, len(p) - 30))
            parts += [" ".join(p[a : a + rng.choice([20, 35, 50, 400])]), prose(rng, rng.randint(0, 40))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    whole = prose(rng, 90)
    texts += [whole, whole, whole + " x", "ab " * 100, "ab " * 34, "ab " * 35, "a b " * 40, None, "", "  ", prose(rng, 34), passages[1]]
    check(bare, texts, 35)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40).map(" ".join), min_size=1, max_size=6))
def test_small_alphabets(bare, texts):
    check(bare, texts, 12)


def test_equal_windows_are_told_by_words_not_by_one_hash(bare, monkeypatch):
    """Half of the window's hash forced to collide: nothing that differs is removed."""
    monkeypatch.setattr(substring_dedup, "_windows", colliding(substring_dedup._windows))
    rng = random.Random(11)
    shared = prose(rng, 50)
    check(bare, [prose(rng, 80) for _ in range(20)] + [prose(rng, 30) + " " + shared, shared + " " + prose(rng, 30)], 35)


def colliding(windows):
    def run(batches, window):
        for b in windows(batches, window):
            yield b.set_column(0, "_w", pa.array([0] * b.num_rows, pa.int64()))

    return run


def test_common_phrases_with_other_words_around(bare):
    """A phrase of an anchor's length in all texts, and passages around it in some."""
    rng = random.Random(13)
    phrase = prose(rng, 12)
    texts = [f"{prose(rng, 30)} {phrase} {prose(rng, 30)}" for _ in range(25)]
    texts += [t for t in texts[:5]] + [" ".join(t.split(" ")[5:50]) for t in texts[5:9]]
    check(bare, texts, 35)


def test_odd_rows(odd_docs, no_docs):
    got = find_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r._id for r in got if r.n_removed} == {6, 7}
    assert find_repeats(no_docs).count() == 0
    # rows that repeat an id and a text are occurrences of their own
    twice = odd_docs.where("doc_id = 6").unionByName(odd_docs.where("doc_id = 6"))
    assert [r.n_removed for r in find_repeats(twice).collect()] == [30_000, 30_000]
