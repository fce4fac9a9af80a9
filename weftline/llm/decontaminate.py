"""Benchmark decontamination by greedy string tiling.

Texts are compared as words in lower case without punctuation. Shared phrases of `least` words are the seeds that join a document with an item; items whose seeds could cover enough of them are tiled: the longest matches that overlap no earlier tile are marked again and again, found by Karp-Rabin hashes of shrinking length. Tiles may come in any order, so reordered passages count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from weftline.llm.common import slices, text_of
from weftline.llm.words import gram_hashes, normal, word_hashes

#: Shortest tile, and the share of an item's words that tiles must cover.
LEAST, COVERAGE = 5, 0.8
#: Words of a block of the benchmark, which is indexed and sent as a whole, and blocks that one scan of the documents is compared with (some 60 MB each in a worker).
BLOCK_WORDS, BLOCKS_A_SCAN = 1_000_000, 8

@dataclass
class Block:
    """Items (id, word hashes) and an index of their seeds: sorted hashes, and for each the items that have it and at how many places."""

    items: list[tuple[object, np.ndarray]]
    seeds: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    sieve: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[object, str]], least: int) -> Block:
        items = [(i, word_hashes([normal(t)])[0]) for i, t in rows]
        items = [(i, w) for i, w in items if len(w) >= least]
        grams = [np.unique(gram_hashes(w, least), return_counts=True) for _, w in items]
        every = np.concatenate([*(g for g, _ in grams), np.empty(0, dtype=np.uint64)])
        places = np.concatenate([*(n for _, n in grams), np.empty(0, dtype=np.int64)])
        owner = np.repeat(np.arange(len(items)), [len(g) for g, _ in grams])
        order = np.argsort(every, kind="stable")
        seeds, first = np.unique(every[order], return_index=True)
        size = 1 << max(16, int(16 * len(seeds)).bit_length())
        sieve = np.zeros(size, dtype=bool)
        sieve[seeds & np.uint64(size - 1)] = True
        return cls(items, seeds, np.append(first, len(every)), owner[order], places[order], sieve)

    def candidates(self, words: np.ndarray, first: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
        """(text, item, number of the item's places that have a shared seed) of the pairs that share any."""
        grams = gram_hashes(words, least)
        at = np.flatnonzero(self.sieve[grams & np.uint64(len(self.sieve) - 1)])
        if not len(at) or not len(self.seeds):
            return
        place = np.minimum(np.searchsorted(self.seeds, grams[at]), len(self.seeds) - 1)
        found = self.seeds[place] == grams[at]
        at, place = at[found], place[found]
        text = np.searchsorted(first, at, side="right") - 1
        whole = at + least <= first[text + 1]
        pairs = np.unique(np.stack([text[whole], place[whole]]), axis=1)
        if not pairs.shape[1]:
            return
        many = self.first[pairs[1] + 1] - self.first[pairs[1]]
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        entry = np.repeat(self.first[pairs[1]], many) + offset
        both, which = np.unique(np.stack([np.repeat(pairs[0], many), self.owners[entry]]), axis=1, return_inverse=True)
        seen = np.bincount(which.ravel(), weights=self.places[entry]).astype(np.int64)
        for (t, k), n in zip(both.T.tolist(), seen.tolist()):
            yield t, k, n


def tile(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in the text, start in the item, words), longest first."""
    free_t, free_i = np.ones(len(text), dtype=bool), np.ones(len(item), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    words_t, words_i = text.tolist(), item.tolist()
    size = min(len(text), len(item))
    while size >= least:
        queue: list[tuple[int, int, int]] = []
        ours, theirs = gram_hashes(item, size), gram_hashes(text, size)
        # a run that is long enough begins at a place from which `size` words are free
        ours_at, theirs_at = free_places(free_i, size), free_places(free_t, size)
        shared = theirs_at[np.isin(theirs[theirs_at], ours[ours_at])]
        places: dict[int, list[int]] = {}
        for j, h in zip(ours_at.tolist(), ours[ours_at].tolist()):
            places.setdefault(h, []).append(j)
        open_t, open_i = free_t.tolist(), free_i.tolist()
        for i, h in zip(shared.tolist(), theirs[shared].tolist()):
            for j in places[h]:
                # only where a run begins: the places within it are the same run
                if i and j and open_t[i - 1] and open_i[j - 1] and words_t[i - 1] == words_i[j - 1]:
                    continue
                for m in free_run(text, item, free_t, free_i, i, j):
                    if m[2] >= size:
                        heapq.heappush(queue, (-m[2], m[0], m[1]))
        while queue:
            n, i, j = heapq.heappop(queue)
            n = -n
            if free_t[i : i + n].all() and free_i[j : j + n].all():
                free_t[i : i + n] = free_i[j : j + n] = False
                tiles.append((i, j, n))
                continue
            # partly taken meanwhile: what is left of it may still be long enough
            open_ = free_t[i : i + n] & free_i[j : j + n]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], open_.view(np.int8), [0]))))
            for a, b in edges.reshape(-1, 2).tolist():
                if b - a >= size:
                    heapq.heappush(queue, (a - b, i + a, j + a))
        size = least if least < size < 2 * least else size // 2
    return tiles


def free_places(free: np.ndarray, size: int) -> np.ndarray:
    """The places from which `size` words are free."""
    taken = np.concatenate(([0], np.cumsum(~free)))
    return np.flatnonzero(taken[size:] == taken[:-size])


def free_run(text: np.ndarray, item: np.ndarray, free_t: np.ndarray, free_i: np.ndarray, i: int, j: int) -> list[tuple[int, int, int]]:
    """The longest run of equal free words through places i and j, if these are free."""
    back = min(i, j)
    ahead = min(len(text) - i, len(item) - j)
    a, b = slice(i - back, i + ahead), slice(j - back, j + ahead)
    good = (text[a] == item[b]) & free_t[a] & free_i[b]
    if not good[back]:
        return []
    stops = np.flatnonzero(~good)
    low = stops[stops < back].max(initial=-1) + 1
    high = stops[stops > back].min(initial=len(good))
    return [(i - back + int(low), j - back + int(low), int(high - low))]


def matches(texts: list[str], block: Block, least: int, coverage: float) -> Iterator[tuple[int, object, float, list[tuple[int, int, int]]]]:
    """(text, item id, share of the item's words in tiles, tiles) of the pairs that reach the coverage."""
    words, first = word_hashes([normal(t) for t in texts])
    for t, k, seeds in block.candidates(words, first, least):
        name, item = block.items[k]
        if seeds * least < coverage * len(item):
            continue  # even apart, the places of seeds cover too little
        text = words[first[t] : first[t + 1]]
        grams = gram_hashes(item, least)
        covered = np.zeros(len(item), dtype=bool)
        for j in np.flatnonzero(np.isin(grams, gram_hashes(text, least))).tolist():
            covered[j : j + least] = True
        if covered.sum() < coverage * len(item):
            continue
        tiles = tile(text, item, least)
        share = sum(n for _, _, n in tiles) / len(item)
        if share >= coverage:
            yield t, name, share, tiles


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, least: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of about `block_words` words; the driver holds one at a time."""
    rows = benchmark.select(F.col(item_col).alias("_item"), text_of(text_col).alias("_t"))
    total = rows.agg(F.sum(F.size(F.split("_t", "\\s+")))).first()[0] or 0
    n = -(-total // block_words)
    for k in range(n):
        yield Block.of([(r["_item"], r["_t"]) for r in rows.where(F.pmod(F.xxhash64("_item", "_t"), F.lit(n)) == k).collect()], least)


def sent_together(docs: DataFrame, blocks: Iterator[Block]) -> Iterator[list]:
    """The blocks, broadcast, as many together as one scan is compared with."""
    sent = (docs.sparkSession.sparkContext.broadcast(b) for b in blocks)
    while some := list(islice(sent, BLOCKS_A_SCAN)):
        yield some


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row for each document and benchmark item whose words lie in tiles to the share `coverage` or more: _id, _item, coverage, n_tiles, tiles (starts in words of the text and the item, and length).

    Documents stay where they are: no shuffle. Blocks of the benchmark, of bounded size, are sent to the executors; one scan of the documents is compared with BLOCKS_A_SCAN of them.

    Cases: null and empty texts match nothing; items of fewer than `least` words have no seed and match nothing; a tie at the threshold is a match. Very long texts are read whole. Repeated documents and items each give their rows; null ids pass through. Empty tables give an empty table; other columns are not touched.
    """
    spark = docs.sparkSession
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    schema = f"_id {id_kind}, _item {item_kind}, coverage double, n_tiles int, tiles array<struct<text:int,item:int,words:int>>"
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))
    out = spark.createDataFrame([], schema)
    for sent in sent_together(docs, blocks_of(benchmark, item_col, item_text_col, least, block_words)):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in slices(texts):
                    got = [m for block in sent for m in matches(texts[a:b], block.value, least, coverage)]
                    ids = batch.column(0).slice(a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([t for t, *_ in got], pa.int64())),
                            pa.array([name for _, name, _, _ in got], item_type),
                            pa.array([s for _, _, s, _ in got], pa.float64()),
                            pa.array([len(x) for *_, x in got], pa.int32()),
                            pa.array([[{"text": i, "item": j, "words": n} for i, j, n in sorted(x)] for *_, x in got], pa.list_(pa.struct([("text", pa.int32()), ("item", pa.int32()), ("words", pa.int32())]))),
                        ],
                        ["_id", "_item", "coverage", "n_tiles", "tiles"],
                    )

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of docs that match no item of the benchmark, with all their columns; cases as in find_leaks."""
    at, schema = docs.columns.index(text_col), docs.schema
    for sent in sent_together(docs, blocks_of(benchmark, item_col, item_text_col, least, block_words)):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                keep = np.ones(len(texts), dtype=bool)
                for a, b in slices(texts):
                    for block in sent:
                        for t, *_ in matches(texts[a:b], block.value, least, coverage):
                            keep[a + t] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs
