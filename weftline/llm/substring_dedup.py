"""Substring dedup by repeated-phrase automata.

1. Every window of `window` words has an anchor: its smallest-hash phrase of ANCHOR words (leftmost among equals). Equal windows have equal anchors, and neighbouring windows mostly share theirs, so a text has an anchor for about one word in fifteen.
2. Only windows whose anchor recurs can recur; their hashes are counted, and those that occur twice are confirmed.
3. Of each confirmed window one occurrence is kept; neighbouring ones are joined to passages.
4. Texts with recurring anchors are dealt over shards. A window has half of its other words, or more, before its anchor or after it: a passage is sent to the shards that have one of its anchors with these words on one side. Each shard compiles the anchors of its passages into an Aho-Corasick automaton and streams its texts through it; around each hit, windows that are in a passage are extended word by word, and stretches of `window` words or more are marked.

Windows are told apart by 128 bits of hash when they are counted, rows by 124; what is marked is compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import drop_saved, release, saved, scratch, slices, text_of
from weftline.llm.near_dedup import _NODE, node_of
from weftline.llm.words import gram_hashes, word_hashes

#: Words of an anchor.
ANCHOR = 8
#: Confirmed windows that a passage has at most; longer runs are cut, with whole windows in each part.
RUN = 256
#: Characters of text in a shard, about, and tasks that stream shards at most.
SHARD_CHARS, MOST_TASKS = 2_000_000, 100_000
#: A second hash of words, for windows.
_OTHER = 0xC2B2AE3D27D4EB4F

_POSITION = np.uint64((1 << 28) - 1)


def words_of(text: str) -> str:
    """The text's words, joined by one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split()).decode("utf-8", "surrogatepass")


def anchors_of(texts: list[str], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of many texts at once: word hashes, where each text's words begin, the phrase hashes, and for each word the position of its window's anchor (-1 where no whole window begins)."""
    words, first = word_hashes(texts)
    grams = gram_hashes(words, ANCHOR)
    where = np.full(len(words), -1, dtype=np.int64)
    span = window - ANCHOR + 1
    n = len(grams) - span + 1
    if n > 0:
        low = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        have = 1
        while have < span:  # the minimum of `have` neighbours, doubled
            step = min(have, span - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        ends = np.repeat(first[1:], np.diff(first))
        whole = np.flatnonzero(np.arange(n) + window <= ends[:n])
        where[whole] = (low[whole] & _POSITION).astype(np.int64)
    return words, first, grams, where


def _lists(values: np.ndarray, owner_first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(owner_first, pa.int32()), pa.array(values, kind))


def _phrases(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """uid, text -> uid, words, characters, digest of the joined words, anchors' hashes and positions."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in slices(texts):
            words, first, grams, where = anchors_of(texts[a:b], window)
            at = np.unique(where[where >= 0])
            cut = np.searchsorted(at, first)
            owner = np.repeat(first[:-1], np.diff(cut))
            digests = [hashlib.sha256(words_of(t).encode("utf-8", "surrogatepass")).hexdigest() for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(first), pa.int64()), pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array(digests), _lists(grams[at].view(np.int64), cut, pa.int64()), _lists((at - owner).astype(np.int32), cut, pa.int32())],
                ["_id", "_uid", "n_words", "_chars", "_all", "_h", "_at"],
            )


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """uid, text, recurring positions, weight -> a row for each window with a recurring anchor."""
    for batch in batches:
        texts = batch.column("_t").to_pylist()
        uid, weight, at = (batch.column(c) for c in ("_row", "_weight", "_at"))
        for a, b in slices(texts):
            words, first, _, where = anchors_of(texts[a:b], window)
            if len(words) < window:
                continue
            recurs = np.zeros(len(words), dtype=bool)
            for k in range(a, b):
                recurs[first[k - a] + at[k].values.to_numpy()] = True
            found = np.flatnonzero((where >= 0) & recurs[where])
            owner = np.searchsorted(first, found, side="right") - 1
            hashes = gram_hashes(words, window)[found]
            others = gram_hashes(word_hashes(texts[a:b], _OTHER)[0], window)[found]
            row = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(others.view(np.int64)), uid.slice(a, b - a).take(row), pa.array((found - first[owner]).astype(np.int32)), weight.slice(a, b - a).take(row)], ["_w", "_w2", "_row", "_pos", "_weight"])


def sides_of(words: np.ndarray, anchors: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the anchors (places in the words of one text) with the words before, and those with the words after them, that the half of a window has; where the text has so many."""
    more = (window - ANCHOR) // 2
    grams = gram_hashes(words, ANCHOR + more)
    before, after = anchors - more, anchors
    return np.unique(np.concatenate([grams[before[(before >= 0) & (before < len(grams))]], ~grams[after[after < len(grams)]]]))


def _sides(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """uid, text, recurring positions -> what passages are sent by."""
    for batch in batches:
        texts = batch.column("_t").to_pylist()
        for a, b in slices(texts):
            words, first = word_hashes(texts[a:b])
            out = [sides_of(words[first[k] : first[k + 1]], np.unique(batch.column("_at")[a + k].values.to_numpy()), window).view(np.int64) for k in range(b - a)]
            yield pa.RecordBatch.from_arrays([batch.column("_uid").slice(a, b - a), pa.array(out, pa.list_(pa.int64()))], ["_uid", "_side"])


def _passages(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """uid, text, confirmed windows' positions -> passages with their anchors."""
    for batch in batches:
        texts = batch.column("_t").to_pylist()
        for a, b in slices(texts):
            hashes, first, _, where = anchors_of(texts[a:b], window)
            out: list[tuple] = []
            for k in range(a, b):
                words = words_of(texts[k]).split(" ")
                at = np.unique(batch.column("_pos")[k].values.to_numpy())
                breaks = np.flatnonzero(np.diff(at) > 1) + 1
                for run in np.split(at, breaks):
                    for start in range(int(run[0]), int(run[-1]) + 1, RUN):
                        end = min(int(run[-1]) + 1, start + RUN)  # of window starts
                        base = int(first[k - a])
                        own = np.unique(where[base + start : base + end]) - base - start
                        sides = sides_of(hashes[base + start : base + end + window - 1], own, window)
                        out.append((" ".join(words[start : end + window - 1]), sides.view(np.int64), own.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _, _ in out], pa.string()), pa.array([h for _, h, _ in out], pa.list_(pa.int64())), pa.array([o for _, _, o in out], pa.list_(pa.int32()))], ["_passage", "_side", "_offset"])


class Phrases:
    """An automaton of the passages' anchor phrases, and where in the passages each of their windows is."""

    def __init__(self, passages: list[tuple[str, list[int]]], window: int) -> None:
        self.window = window
        self.passages = [words.split(" ") for words, _ in passages]
        self.automaton = ahocorasick.Automaton()
        for words, (_, offsets) in zip(self.passages, passages):
            for o in offsets:
                self.automaton.add_word(f" {' '.join(words[o : o + ANCHOR])} ", True)
        if passages:
            self.automaton.make_automaton()
        hashes, first = word_hashes([words for words, _ in passages])
        windows = gram_hashes(hashes, window)
        owner = np.repeat(np.arange(len(passages)), np.diff(first))[: len(windows)]
        whole = np.flatnonzero(np.arange(len(windows)) + window <= first[owner + 1]) if len(windows) else np.empty(0, dtype=np.int64)
        order = whole[np.argsort(windows[whole], kind="stable")]
        self.windows, self.owner, self.offset = windows[order], owner[order], (order - first[owner[order]])

    def cover(self, texts: list[str]) -> Iterator[tuple[list[str], bytearray]]:
        """Of each text the words, and 1 for each that lies in a stretch of `window` words or more of a passage.

        The automaton locates the anchors. A window whose anchor is there is looked up among the passages' windows; where it is found, the text is compared with that passage word by word, both ways, as far as they agree.
        """
        hashes, first, _, where = anchors_of(texts, self.window)
        windows = gram_hashes(hashes, self.window)
        for k, text in enumerate(texts):
            joined = words_of(text)
            words = joined.split(" ") if joined else []
            marked = bytearray(len(words))
            if len(words) >= self.window and len(self.windows):
                ends = np.fromiter((e for e, _ in self.automaton.iter(f" {joined} ")), dtype=np.int64)
                if len(ends):
                    self.mark(words, marked, ends, windows[first[k] : first[k + 1]], where[first[k] : first[k + 1]] - first[k])
            yield words, marked

    def mark(self, words: list[str], marked: bytearray, ends: np.ndarray, windows: np.ndarray, where: np.ndarray) -> None:
        starts = np.cumsum(np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))) + 1
        hit = np.zeros(len(words) + 1, dtype=bool)
        hit[np.searchsorted(starts, ends + 1) + 1 - ANCHOR] = True
        at = np.flatnonzero(where >= 0)
        at = at[hit[where[at]]]
        place = np.minimum(np.searchsorted(self.windows, windows[at]), len(self.windows) - 1)
        found = self.windows[place] == windows[at]
        until = -1  # windows that begin before this are marked
        for i, p in zip(at[found].tolist(), place[found].tolist()):
            if i >= until:
                left, right = self.extend(words, i, self.passages[self.owner[p]], int(self.offset[p]))
                if left + right >= self.window:
                    marked[i - left : i + right] = b"\1" * (left + right)
                    until = i + right - self.window + 1

    @staticmethod
    def extend(words: list[str], i: int, other: list[str], o: int) -> tuple[int, int]:
        """How many words are equal before, and from, places i and o."""
        left = most = min(i, o)
        if words[i - most : i] != other[o - most : o]:
            left = 0
            while words[i - left - 1] == other[o - left - 1]:
                left += 1
        right = most = min(len(words) - i, len(other) - o)
        if words[i : i + most] != other[o : o + most]:
            right = 0
            while words[i + right] == other[o + right]:
                right += 1
        return left, right


def _stream(docs: pa.Table, passages: pa.Table, window: int) -> pa.Table:
    """A shard's texts, marked by a shard's passages; a row for each text with marked words."""
    phrases = Phrases(list(zip(passages.column("_passage").to_pylist(), passages.column("_offset").to_pylist())), window)
    uids, spans, digests, removed = [], [], [], []
    every, texts = docs.column("_uid").to_pylist(), docs.column("_t").to_pylist()
    for a, b in slices(texts):
        for uid, (words, marked) in zip(every[a:b], phrases.cover(texts[a:b])):
            if n := marked.count(1):
                uids.append(uid)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(marked), dtype=np.int8), [0]))))
                spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
                removed.append(n)
                digests.append(hashlib.sha256(" ".join(w for w, m in zip(words, marked) if not m).encode("utf-8", "surrogatepass")).hexdigest())
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"_uid": pa.array(uids, docs.schema.field("_uid").type), "n_removed": pa.array(removed, pa.int64()), "_kept": pa.array(digests, pa.string()), "spans": pa.array(spans, span)})


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """_id, n_words, n_removed, spans (word ranges that recur, end exclusive) and kept_sha256 (of the other words, joined by one space) of every row.

    A word is in a span if a window of `window` words that covers it also starts anywhere else, in the same text or another. Windows are judged on the input.

    Hot passages: their windows are counted before the shuffle, one occurrence of each is kept, and a shard gets a passage once however many of its texts have it. Whole copies of a text send their windows once, with weight two. Joins on hot anchors and copies are between small rows, which Spark splits.

    Cases: null and empty texts, and texts of fewer words than a window, have no span. Very long texts are read whole. Rows that repeat an id and text are occurrences of their own, and null ids are rows like others. An empty table gives an empty table; other columns are not touched.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    # a row's identity: its id and text; rows that share both have the same result
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t")).withColumn("_uid", node_of("_id", "_t"))
    with scratch(spark) as kept:
        schema = f"_id {kind}, _uid {_NODE}, n_words bigint, _chars bigint, _all string, _h array<bigint>, _at array<int>"
        phrases = kept(saved(rows.select("_id", "_t", "_uid").mapInArrow(lambda b: _phrases(b, window), schema), "phrases"))
        release(spark)

        each = phrases.select("_uid", F.explode(F.arrays_zip("_h", "_at")).alias("x")).select("_uid", "x._h", "x._at")
        # written first, so that both sides of the join are plain shuffles, which Spark can split at a hot anchor
        recurring = saved(each.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"), "recurring")
        release(spark)
        again = saved(each.join(recurring, "_h"), "anchors")
        release(spark)

        # whole copies: the first of them stands for all
        copies = saved(phrases.where(F.col("n_words") >= window).groupBy("_all", "n_words").agg(F.min("_uid").alias("_one"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "copies")
        weight = (
            phrases.select("_uid", "_all", "n_words")
            .join(copies, ["_all", "n_words"])
            .select("_uid", F.when(F.col("_uid") == F.col("_one"), 2).otherwise(0).alias("_weight"))
            .distinct()
        )
        info = again.groupBy("_uid").agg(F.collect_set("_at").alias("_at")).join(weight, "_uid", "left").withColumn("_weight", F.coalesce("_weight", F.lit(1)))
        # a number for each row of what is written: half as long as its identity, and exact
        texts = kept(saved(rows.select("_uid", "_t").join(info, "_uid").withColumns({"_chars": F.length("_t"), "_row": F.monotonically_increasing_id()}), "texts"))
        for done in (again, recurring, copies):
            drop_saved(done)
        release(spark)

        counted = texts.where("_weight > 0").mapInArrow(lambda b: _windows(b, window), "_w bigint, _w2 bigint, _row bigint, _pos int, _weight int")
        confirmed = counted.groupBy("_w", "_w2").agg(F.sum("_weight").alias("_n"), F.min_by("_pos", "_row").alias("_pos"), F.min("_row").alias("_row")).where("_n > 1")
        starts = confirmed.groupBy("_row").agg(F.collect_set("_pos").alias("_pos"))
        found = texts.select("_row", "_t").join(starts, "_row").mapInArrow(lambda b: _passages(b, window), "_passage string, _side array<bigint>, _offset array<int>")
        passages = kept(saved(found.withColumn("_pid", node_of("_passage")), "passages"))
        release(spark)

        shards = max(1, -(-(texts.agg(F.sum("_chars")).first()[0] or 0) // SHARD_CHARS))
        shard = F.pmod(F.xxhash64("_uid", F.lit(1)), F.lit(shards)).alias("_shard")
        has = texts.select("_uid", "_t", "_at").mapInArrow(lambda b: _sides(b, window), f"_uid {_NODE}, _side array<bigint>").select(shard, F.explode("_side").alias("_side")).distinct()
        sent = kept(saved(passages.select("_pid", F.explode("_side").alias("_side")).join(has, "_side").select("_pid", "_shard").distinct(), "sent"))
        release(spark)

    tasks = min(shards, MOST_TASKS)
    dealt = sent.join(passages.select("_pid", "_passage", "_offset"), "_pid").select("_shard", "_passage", "_offset")
    # as many tasks as shards, so that a task doesn't grow with the corpus
    marked = (
        texts.select("_uid", "_t", shard)
        .repartition(tasks, "_shard")
        .groupBy("_shard")
        .cogroup(dealt.repartition(tasks, "_shard").groupBy("_shard"))
        .applyInArrow(lambda a, b: _stream(a, b, window), f"_uid {_NODE}, n_removed bigint, _kept string, spans array<struct<start:bigint,end:bigint>>")
        .dropDuplicates(["_uid"])
    )
    return phrases.join(marked, "_uid", "left").select(
        "_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("_kept", "_all").alias("kept_sha256"),
    )


def without_spans(text: str | None, spans: list) -> str:
    """The text's words outside the word ranges, joined by one space."""
    words = words_of(text or "").split(" ")
    keep = bytearray(b"\1" * len(words))
    for s, e in spans:
        keep[s:e] = bytes(e - s)
    return " ".join(w for w, k in zip(words, keep) if k)
