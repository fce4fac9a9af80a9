"""MinHash near-dedup by Order MinHash and banded alignment.

Texts are compared as words in lower case without punctuation. Two texts are a link if their edit similarity, 1 - (edits of words) / (words of the longer one), reaches the threshold; alignment within the band of that many edits decides it, and nothing else does. Classes are the connected components of links.

Candidates: a sketch samples the few smallest of a text's k-mers of words, labelled by occurrence, under one of several hash orders and keeps them in the order of the text; texts that agree on a sketch are candidates. At an edit similarity of 0.8 no five-word shingle need survive (edits of every fifth word touch them all), so k-mers are shorter: two words, and one word for texts of few. Texts of fewer than ten words are looked up exactly, with each word left out in turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import one_of_each, release, saved, scratch, slices, text_of
from weftline.llm.words import gram_hashes, mix, normal, word_hashes

#: Words of a k-mer, k-mers of a sketch, and sketches, of texts of LONG words or more.
KMER, SAMPLE, SKETCHES = 2, 3, 40
#: The same of texts of fewer words. Texts of LONG words to LONG / threshold have both, since a link joins texts of like length.
SHORT_KMER, SHORT_SAMPLE, SHORT_SKETCHES = 1, 4, 28
LONG = 40
#: How often buckets of several classes are searched again, and with how many pivots each.
TURNS, PIVOTS = 2, 4
#: Texts from which the exact search learns which words and pairs of words are frequent, hashes that it keeps, and characters of a block of texts that are verified together.
KNOWN_TEXTS, KNOWN_HASHES, BLOCK_CHARS = 2000, 200_000, 2_000_000
#: The exact search looks up one part more for so many words, if it is as rare as the others or the sample has it so often at most.
SPARE_WORDS, SPARE_COUNT = 16, 2
#: Lookups of rare parts, of which about one finds the part where it may be, for one of a part that is all over the text.
ASTRAY = 3

_SEEDS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_NODE = "decimal(38,0)"
#: Rows of the longer sequence whose places are kept in one number.
_BLOCK = 2048


def node_of(*values: str | F.Column) -> F.Column:
    """124 bits of hash as one number, which Spark can group, order and join by."""
    high = F.xxhash64(*values).cast("decimal(20,0)") * F.lit(10**18).cast("decimal(19,0)")
    return (high + F.pmod(F.xxhash64(*values, F.lit(1)), F.lit(10**18)).cast("decimal(18,0)")).cast(_NODE)


def most_edits(words: int, threshold: float) -> int:
    """The edits that a link may have if its longer text has so many words."""
    return int((1 - threshold) * words + 1e-9)


def labelled(grams: np.ndarray) -> np.ndarray:
    """The hashes with the number of their occurrence: a multiset as a set."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    label = np.arange(len(grams)) - np.searchsorted(ranked, ranked, side="left")
    out = np.empty(len(grams), dtype=np.uint64)
    out[order] = mix(ranked + label.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return out


def order_sketches(grams: np.ndarray, sample: int, seeds: np.ndarray) -> np.ndarray:
    """One hash per seed, of the sampled k-mers in the order of the text."""
    n = len(grams)
    if not n:
        return np.empty(0, dtype=np.uint64)
    marked = labelled(grams)
    out = np.empty(len(seeds), dtype=np.uint64)
    step = max(1, 2_000_000 // n)
    for a in range(0, len(seeds), step):
        some = seeds[a : a + step, None]
        ranks = (marked[None, :] ^ some) * np.uint64(0xBF58476D1CE4E5B9)
        ranks ^= ranks >> np.uint64(29)
        ranks *= np.uint64(0x94D049BB133111EB)
        at = np.sort(np.argpartition(ranks, sample - 1, axis=1)[:, :sample], axis=1) if n > sample else np.broadcast_to(np.arange(n), (len(some), n))
        h = some[:, 0].copy()
        for k in range(at.shape[1]):
            h = mix(h * np.uint64(31) + grams[at[:, k]])
        out[a : a + len(some)] = h
    return out


def keys_of(words: np.ndarray, threshold: float) -> np.ndarray:
    """Hashes by which a text (hashes of its words) meets its candidates."""
    n = len(words)
    few = next(k for k in range(1, 11) if k == 10 or most_edits(k + 1, threshold) > 1)  # no link up to so many words has two edits
    out = []
    if 0 < n <= few:
        every = [words] + ([np.delete(words, i) for i in range(n)] if most_edits(n, threshold) else [])
        out.append(np.array([mix(gram_hashes(w, len(w)) ^ _SEEDS[255])[0] for w in every if len(w)], dtype=np.uint64))
    if threshold * (few + 1) <= n <= LONG / threshold:
        out.append(order_sketches(gram_hashes(words, SHORT_KMER), SHORT_SAMPLE, _SEEDS[128 : 128 + SHORT_SKETCHES]))
    if n >= LONG:
        out.append(order_sketches(gram_hashes(words, KMER), SAMPLE, _SEEDS[:SKETCHES]))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def places(words: list[int]) -> dict[tuple[int, int], int]:
    """For each word and block of _BLOCK places, the places that have it, a bit each."""
    out: dict[tuple[int, int], int] = {}
    for i, w in enumerate(words):
        key = (w, i // _BLOCK)
        out[key] = out.get(key, 0) | 1 << i % _BLOCK
    return out


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two sequences if it is `most` or less, else most + 1.

    Only the band of 2 * most + 1 diagonals is followed. A column's cells in the band are two numbers whose bits say where the distance grows and falls from one row to the next, so that a column costs a few operations on whole numbers; the band moves down one row a column.
    """
    same = min(len(a), len(b))
    differ = np.flatnonzero(a[:same] != b[:same])
    head = int(differ[0]) if len(differ) else same
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - same :][::-1] != b[len(b) - same :][::-1])
    tail = int(differ[0]) if len(differ) else same
    x, y = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    m, n = len(x), len(y)
    if abs(m - n) > most:
        return most + 1
    if not m or not n:
        return max(m, n)
    if not most:
        return 1
    where = places(x)
    last_block = (m - 1) // _BLOCK
    full = (1 << 2 * most + 1) - 1
    top = 1 << 2 * most
    up, down = full ^ (1 << most) - 1, 0  # rows that are one more, and one less, than the row before
    distance = min(m, most)
    limit = most + n - m + most
    for j in range(1, n + 1):
        low = j - most - 1  # the first place in the band
        word, match = y[j - 1], 0
        for block in range(max(0, low) // _BLOCK, min(last_block, (low + 2 * most) // _BLOCK) + 1):
            if bits := where.get((word, block)):
                shift = block * _BLOCK - low
                match |= bits << shift if shift >= 0 else bits >> -shift
        match &= full
        diagonal = (((match & up) + up) ^ up | match | down) & full  # cells equal to their diagonal neighbour
        right_up = (down | ~(diagonal | up)) & full
        right_down = diagonal & up
        if j <= m - most:  # along the lower edge of the band to the last row, then along that row
            distance += not diagonal & top
            if distance > limit:
                return most + 1
        else:
            bit = 1 << m - j + most
            distance += bool(right_up & bit) - bool(right_down & bit)
        on = diagonal >> 1
        up, down = right_down | ~(on | right_up) & full, on & right_up
    return min(distance, most + 1)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two multisets share."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two sequences of word hashes are a link. Words that are missing are edits, so bags of words that differ too much need no alignment."""
    longer = max(len(a), len(b))
    most = most_edits(longer, threshold)
    if abs(len(a) - len(b)) > most or longer - common(a, b) > most:
        return False
    return banded_distance(a, b, most) <= most


def _sketch(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("_t").to_pylist()
        for s, e in slices(texts):
            words, first = word_hashes([normal(t) for t in texts[s:e]])
            out = [keys_of(words[first[k] : first[k + 1]], threshold).view(np.int64) for k in range(e - s)]
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(s, e - s) for c in ("_id", "_node", "_row")] + [pa.array(np.diff(first), pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["_id", "_node", "_row", "_words", "_keys"])


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs (with their texts _ta, _tb) that are links."""
    ends = ["_a", "_b", "_ia", "_ib"]
    for batch in batches:
        left, right = batch.column("_ta").to_pylist(), batch.column("_tb").to_pylist()
        for s, e in slices([a + b for a, b in zip(left, right)]):
            wa, fa = word_hashes([normal(t) for t in left[s:e]])
            wb, fb = word_hashes([normal(t) for t in right[s:e]])
            links = pa.array([similar(wa[fa[k] : fa[k + 1]], wb[fb[k] : fb[k + 1]], threshold) for k in range(e - s)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(s, e - s).filter(links) for c in ends], ends)


def components(edges: DataFrame) -> DataFrame:
    """_node, _class (its component's smallest node) of all nodes of the edges (_a, _b). Nothing is gathered on the driver but a count per step.

    Each round every node points to its smallest neighbour if that is smaller, pointers are followed to their roots by doubling, and the roots take the place of their nodes in the edges: what is left are the few edges between different roots.
    """
    spark = edges.sparkSession
    with scratch(spark) as kept:
        left = saved(edges.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).where("_a <> _b").distinct(), "links")
        classes = None
        while left.limit(1).count():
            both = left.unionByName(left.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
            to = saved(both.groupBy("_a").agg(F.min("_b").alias("_b")).select(F.col("_a").alias("_node"), F.least("_a", "_b").alias("_to")), "pointers")
            moved = True
            while moved:
                up = to.select(F.col("_node").alias("_to"), F.col("_to").alias("_up"))
                new = saved(to.select("_node", "_to").join(up, "_to").select("_node", F.col("_up").alias("_to"), (F.col("_up") < F.col("_to")).alias("_moved")), "pointers")
                moved, to = bool(new.where("_moved").limit(1).count()), new.select("_node", "_to")
            step = to.select(F.col("_node").alias("_class"), F.col("_to").alias("_up"))
            classes = to.withColumnRenamed("_to", "_class") if classes is None else saved(classes.join(step, "_class", "left").select("_node", F.coalesce("_up", "_class").alias("_class")), "classes")
            ends = [to.select(F.col("_node").alias(c), F.col("_to").alias(f"{c}_to")) for c in ("_a", "_b")]
            across = left.join(ends[0], "_a").join(ends[1], "_b").where("_a_to <> _b_to")
            left = saved(across.select(F.least("_a_to", "_b_to").alias("_a"), F.greatest("_a_to", "_b_to").alias("_b")).distinct(), "links")
            release(spark)
        if classes is None:
            classes = spark.createDataFrame([], f"_node {edges.schema['_a'].dataType.simpleString()}, _class {edges.schema['_a'].dataType.simpleString()}")
        return kept(saved(classes, "classes"))


def pairs_with(members: DataFrame, pivots: DataFrame, threshold: float) -> DataFrame:
    """(_a, _b, their classes _ia, _ib), each pair once, of the pivots (_bucket, _p: _node, _words, _its) and the members (_bucket, _node, _words, _its) of other classes that are long enough to be links: words that one text has more are edits."""
    longer, shorter = F.greatest("_words", "_p._words"), F.least("_words", "_p._words")
    met = members.join(pivots.hint("merge"), "_bucket").where((F.col("_its") != F.col("_p._its")) & (longer - shorter <= (1 - threshold) * longer + 1e-9))
    first = F.col("_node") < F.col("_p._node")
    ends = [F.least("_node", "_p._node").alias("_a"), F.greatest("_node", "_p._node").alias("_b")]
    return met.select(*ends, F.when(first, F.col("_its")).otherwise(F.col("_p._its")).alias("_ia"), F.when(first, F.col("_p._its")).otherwise(F.col("_its")).alias("_ib")).distinct()


def pairs_between(single: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The most disjoint pairs of neighbours, of those that may be parts, between the words that are parts alone: with these they are the most disjoint parts there are."""
    at = np.flatnonzero(pair & ~single[:-1] & ~single[1:])
    if not len(at):
        return at
    new = np.concatenate(([True], np.diff(at) > 1))
    return at[(at - at[new][np.cumsum(new) - 1]) % 2 == 0]


def prices(grams: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The known count of each gram, 0 if there is none (counts are of the sorted hashes)."""
    if not len(hashes):
        return np.zeros(len(grams), dtype=np.int64)
    at = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
    return np.where(hashes[at] == grams, counts[at], 0)


def parts_at(words: np.ndarray, threshold: float, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of most_edits + 1 disjoint parts or more, words or pairs of neighbours, those that are rarest by the known counts (of the sorted hashes). A part that occurs twice may be there twice. No pair has a word that is known SPARE_COUNT times or less (see askable).

    An edit touches one of them at most, so a link that is no longer has all of them whole but most_edits, whichever they are: the counts decide the cost alone. The spare ones (see SPARE_WORDS) make more than one necessary, which few texts have by chance. Where one part occurs often enough to be all of them and is found less often than the rare ones together, it is: one lookup in place of many.
    """
    least = most_edits(len(words), threshold) + 1
    limit = least + len(words) // SPARE_WORDS
    grams = [gram_hashes(words, size) for size in (1, 2)]
    price = [prices(g, hashes, counts) for g in grams]

    def chosen(level: int) -> tuple[np.ndarray, np.ndarray]:
        single = price[0] <= level
        return np.flatnonzero(single), pairs_between(single, price[1] <= level)

    levels = np.unique(np.concatenate(price))
    low, high = 0, len(levels) - 1  # at the highest, every word is a part
    while low < high:
        middle = (low + high) // 2
        if sum(map(len, chosen(levels[middle]))) >= least:
            high = middle
        else:
            low = middle + 1
    ones, twos = chosen(max(levels[low], SPARE_COUNT))
    some, at, cost = np.concatenate([grams[0][ones], grams[1][twos]]), np.concatenate([ones, twos]), np.concatenate([price[0][ones], price[1][twos]])
    first = np.lexsort((some, cost))[:limit]
    _, each = np.unique(some[first[:least]], return_index=True)
    whole = cost[first[:least]][each].sum()
    frequent = np.flatnonzero((price[0][:-1] > SPARE_COUNT) & (price[0][1:] > SPARE_COUNT))
    for k, may in ((0, np.arange(len(words))), (1, frequent[frequent % 2 == 0]), (1, frequent[frequent % 2 == 1])):
        values, times = np.unique(grams[k][may], return_counts=True)
        if len(values) and times.max() >= least:
            often = may[grams[k][may] == values[times.argmax()]]
            if ASTRAY * price[k][often[0]] < whole:
                return grams[k][often[:limit]], often[:limit]
    return some[first], at[first]


def askable(words: np.ndarray, band: int, hashes: np.ndarray, counts: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words and pairs that parts_at can have chosen in a text of like length; of the known ones those that it did choose in one (a bit of `bands` for each band)."""
    grams = [gram_hashes(words, size) for size in (1, 2)]
    frequent = prices(grams[0], hashes, counts) > SPARE_COUNT
    out = []
    for g, may in zip(grams, (np.full(len(words), True), frequent[:-1] & frequent[1:])):
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, g), len(hashes) - 1)
            may = may & ((hashes[at] != g) | (bands[at] >> np.uint64(min(band, 63)) & np.uint64(1)).astype(bool))
        out.append((g[may], np.flatnonzero(may)))
    return np.concatenate([g for g, _ in out]), np.concatenate([i for _, i in out])


def parts_of(words: np.ndarray, threshold: float, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hashes of parts_at."""
    return parts_at(words, threshold, hashes, counts)[0]


def _spans(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once, how often it is there, and its first and last place."""
    order = np.lexsort((at, grams))
    grams, at = grams[order], at[order]
    begin = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))[: len(grams)])
    end = np.append(begin[1:], len(grams))[: len(begin)]
    return grams[begin], end - begin, at[begin], at[end - 1]


def _parts(batches: Iterator[pa.RecordBatch], threshold: float, hashes: np.ndarray | None = None, counts: np.ndarray | None = None, bands: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Texts (_node, _its, _words, _t) with their parts, how often each is among them, its first place and how far on the last is, and how many a link must have (_need); with bands, with their words and pairs that may be asked for; without hashes, with all. _band puts texts of like length together; the shorter text of a link has the band of the longer one or its _lower, mostly the same."""
    width = max(-np.log(threshold), 0.01) * 4
    names = ["_node", "_its", "_words"]
    none = np.empty(0, dtype=np.uint64)
    for batch in batches:
        texts = batch.column("_t").to_pylist()
        for s, e in slices(texts):
            words, first = word_hashes([normal(t) for t in texts[s:e]])
            each = [words[first[k] : first[k + 1]] for k in range(e - s)]
            length = np.diff(first)
            band, lower = (np.floor(np.log(np.maximum(n, 1)) / width).astype(np.int32) for n in (length, [n - most_edits(int(n), threshold) for n in length]))
            need = [0] * len(each)
            if hashes is None:
                chosen = [(np.concatenate([gram_hashes(w, 1), gram_hashes(w, 2)]), np.concatenate([np.arange(len(w)), np.arange(max(0, len(w) - 1))])) for w in each]
            elif bands is not None:
                chosen = [askable(w, int(b), hashes, counts, bands) if len(w) else (none, np.arange(0)) for w, b in zip(each, band)]
            else:
                chosen = [parts_at(w, threshold, hashes, counts) if len(w) else (none, np.arange(0)) for w in each]
                need = [len(c) - most_edits(len(w), threshold) for (c, _), w in zip(chosen, each)]
            spans = [_spans(*c) for c in chosen]
            rest = [pa.array([x.astype(np.int32) for x in some], pa.list_(pa.int32())) for some in ([x[1] for x in spans], [x[2] for x in spans], [x[3] - x[2] for x in spans])]
            more = [pa.array(band), pa.array(lower), pa.array(need, pa.int32()), pa.array([x[0].view(np.int64) for x in spans], pa.list_(pa.int64())), *rest]
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(s, e - s) for c in names] + more, [*names, "_band", "_lower", "_need", "_parts", "_times", "_low", "_span"])


def _asked(batches: Iterator[pa.RecordBatch], threshold: float, hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The known hashes that are parts of the texts, with a bit for each band in which they are looked up (64 and more as 63)."""
    bands, one = np.zeros(len(hashes), dtype=np.uint64), np.uint64(1)
    for batch in _parts(batches, threshold, hashes, counts):
        parts = batch.column("_parts")
        grams = parts.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        at = np.minimum(np.searchsorted(hashes, grams), max(0, len(hashes) - 1))
        known = np.flatnonzero(hashes[at] == grams) if len(hashes) else np.arange(0)
        for c in ("_band", "_lower"):
            band = np.repeat(batch.column(c).to_numpy(), np.diff(parts.offsets.to_numpy()))
            np.bitwise_or.at(bands, at[known], one << np.minimum(band[known], 63).astype(np.uint64))
    there = np.flatnonzero(bands)
    yield pa.RecordBatch.from_arrays([pa.array(hashes[there].view(np.int64)), pa.array(bands[there].view(np.int64))], ["_h", "_bands"])


def _verify_block(pairs: pa.Table, texts: pa.Table, threshold: float) -> pa.Table:
    """The pairs that are links; the texts are those of two blocks, each once."""
    nodes, content = texts.column("_node").to_pylist(), texts.column("_t").to_pylist()
    words, bags = {}, {}
    for s, e in slices(content):
        w, first = word_hashes([normal(t) for t in content[s:e]])
        for k in range(e - s):
            words[nodes[s + k]] = own = w[first[k] : first[k + 1]].copy()
            bags[nodes[s + k]] = np.sort(labelled(own))
    links = []
    for a, b in zip(pairs.column("_a").to_pylist(), pairs.column("_b").to_pylist()):
        x, y = words[a], words[b]
        longer = max(len(x), len(y))
        most = most_edits(longer, threshold)
        links.append(longer - len(np.intersect1d(bags[a], bags[b], assume_unique=True)) <= most and banded_distance(x, y, most) <= most)
    return pairs.select(["_a", "_b", "_ia", "_ib"]).filter(pa.array(links, pa.bool_()))


def rest_of_links(left: DataFrame, tried: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The links (_a, _b, their classes _ia, _ib) between texts of different classes in the buckets that are left (_bucket, _node, _words, _its), without the pairs tried before. Exact: no pair is left out, however large a bucket is.

    Of each text the rarest disjoint parts, more than a link may have edits, are looked up among the words and pairs of words of the texts that are no longer; a link has all of them but as many as it may have edits, and each about where it was: the words before a part that is whole, and those after it, differ in number by the edits there, which together are as many as a link may have at most. Only pairs that do have their texts sent: they are compared by their bags of words and by alignment, in blocks of texts, so that a text in many pairs is sent once for each other block. The lookup is between texts, not within buckets: texts that share many buckets meet once, and some links without a bucket are found as well. What no text of like length asks for isn't sent to the lookup, as far as the sample's hashes can say.
    """
    spark = left.sparkSession
    nodes = saved(left.select("_node", "_its", "_words").where("_words > 0").distinct(), "open")
    some = saved(texts.join(nodes.hint("merge"), "_node").select("_node", "_its", "_words", "_t"), "some")
    size = some.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("_t")).alias("chars")).first()
    arrays = ["_parts", "_times", "_low", "_span"]
    schema = f"_node {_NODE}, _its {_NODE}, _words bigint, _band int, _lower int, _need int, _parts array<bigint>, _times array<int>, _low array<int>, _span array<int>"

    def parts(of: DataFrame, *known: np.ndarray) -> DataFrame:
        return of.mapInArrow(lambda x: _parts(x, threshold, *known), schema)

    share = F.lit(min(1.0, KNOWN_TEXTS / max(1, size["n"])))
    sample = some.where(F.pmod(F.xxhash64("_node", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share).withColumn("_t", F.substring("_t", 1, 20_000)).limit(2 * KNOWN_TEXTS)
    known = parts(sample).select(F.explode("_parts").alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").orderBy(F.desc("_n"), "_h").limit(KNOWN_HASHES).collect()
    hashes, counts = np.array([r["_h"] for r in known], dtype=np.int64).view(np.uint64), np.array([r["_n"] for r in known], dtype=np.int64)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    bands = np.zeros(len(hashes), dtype=np.int64)
    for r in some.mapInArrow(lambda x: _asked(x, threshold, hashes, counts), "_h bigint, _bands bigint").groupBy("_h").agg(F.bit_or("_bands").alias("_bands")).collect():
        bands[np.searchsorted(hashes, np.int64(r["_h"]).view(np.uint64))] = r["_bands"]

    # what is the same in a text's rows comes first, so that they are written small
    asked = parts(some, hashes, counts).select("_node", "_its", "_words", "_need", F.explode(F.array_distinct(F.array("_band", "_lower"))).alias("_band"), *arrays)
    asked = asked.select("_node", "_its", "_words", "_need", "_band", F.explode(F.arrays_zip(*arrays)).alias("_p"))
    asked = asked.select("_node", "_its", "_words", "_need", "_band", "_p._times", "_p._span", "_p._low", F.col("_p._parts").alias("_h"))
    there = parts(some, hashes, counts, bands.view(np.uint64)).select(*(F.col(c).alias(f"{c}_of") for c in ("_node", "_its", "_words")), "_band", F.explode(F.arrays_zip(*arrays)).alias("_p"))
    there = there.select("_node_of", "_its_of", "_words_of", "_band", *(F.col(f"_p.{c}").alias(f"{c}_of") for c in ("_times", "_span", "_low")), F.col("_p._parts").alias("_h"))
    # as most_edits() of the longer text
    most, more = F.floor(F.lit(1 - threshold) * F.col("_words") + 1e-9), F.col("_words") - F.col("_words_of")
    near = (F.col("_words_of") <= F.col("_words")) & (more <= most)
    # of a part at i, the place j in the other text: |i - j| + |more - (i - j)| <= most
    high, high_of = F.col("_low") + F.col("_span"), F.col("_low_of") + F.col("_span_of")
    placed = (2 * F.col("_low_of") <= 2 * high + most - more) & (2 * high_of >= 2 * F.col("_low") - most - more)
    enough = F.col("_times_of") >= F.col("_times") - most
    met = asked.hint("merge").join(there, ["_h", "_band"]).where((F.col("_its") != F.col("_its_of")) & near & placed & enough)
    met = met.groupBy("_node", "_node_of").agg(*(F.first(c).alias(c) for c in ("_its", "_its_of", "_need")), F.sum(F.least("_times", "_times_of")).alias("_n")).where("_n >= _need")
    first = F.col("_node") < F.col("_node_of")
    ends = [F.least("_node", "_node_of").alias("_a"), F.greatest("_node", "_node_of").alias("_b")]
    pairs = met.select(*ends, F.when(first, F.col("_its")).otherwise(F.col("_its_of")).alias("_ia"), F.when(first, F.col("_its_of")).otherwise(F.col("_its")).alias("_ib")).distinct()
    pairs = saved(pairs.join(tried.hint("merge"), ["_a", "_b"], "left_anti"), "rest")
    release(spark)

    blocks = F.lit(max(1, -(-(size["chars"] or 0) // BLOCK_CHARS)))
    block = [F.pmod(F.xxhash64(c, F.lit(7)), blocks) for c in ("_a", "_b")]
    dealt = pairs.withColumn("_block", F.least(*block) * blocks + F.greatest(*block))
    needed = dealt.select(F.col("_a").alias("_node"), "_block").unionByName(dealt.select(F.col("_b").alias("_node"), "_block")).distinct()
    sent = some.select("_node", "_t").join(needed.hint("merge"), "_node").select(F.col("_block").alias("_to"), "_node", "_t")
    found = dealt.groupBy("_block").cogroup(sent.groupBy("_to")).applyInArrow(lambda a, b: _verify_block(a, b, threshold), f"_a {_NODE}, _b {_NODE}, _ia {_NODE}, _ib {_NODE}")
    return saved(found, "found")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, turns: int = TURNS) -> DataFrame:
    """_id, class_id (the smallest id of its class), class_size and kept (whether it is the row that stays) of every row.

    Equal texts are one node. First each sketch's bucket has a pivot, the text that shares most buckets with most others, and all texts of the bucket are compared with it: a group of n near copies costs n comparisons, not n * n. Then, `turns` times, PIVOTS other members of each bucket that isn't of one class yet are pivots for its members of other classes: a link shares several buckets and has new chances in each of them. A turn is linear in the buckets' members, however large one is. The links of texts in buckets that still have several classes, which no pivot has shown, are then looked up exactly (see rest_of_links): two texts that share a bucket and are a link are always of one class.

    Cases: null and empty texts are one class. Texts without words are in a class with equal texts alone. The row that stays has the smallest id of its class, and of texts with that id the one of the smallest hash; rows that repeat it all are marked. Null ids never name a class that has another id, and a class of null ids alone has class_id null. Texts of any length are aligned whole. An empty table gives an empty table; other columns are not touched.
    """
    return _judged(docs, id_col, text_col, threshold, turns).drop("_node")


def _judged(docs: DataFrame, id_col: str, text_col: str, threshold: float, turns: int = TURNS) -> DataFrame:
    """The rows of near_classes, and _node, the hash of the row's text."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t")).withColumns({"_node": node_of("_t"), "_row": F.xxhash64("_id", "_t")})
    with scratch(spark) as kept:
        sketched = saved(rows.mapInArrow(lambda x: _sketch(x, threshold), f"_id {kind}, _node {_NODE}, _row bigint, _words bigint, _keys array<bigint>"), "sketches")
        distinct = sketched.groupBy("_node").agg(F.first("_words").alias("_words"), F.first("_keys").alias("_keys"), F.min("_row").alias("_row"))
        entries = distinct.select("_node", "_words", "_row", F.explode(F.array_distinct("_keys")).alias("_bucket"))
        # what a join looks up is written first: both sides are then plain shuffles, which Spark can split at a hot key
        shared = saved(entries.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "shared")
        members = saved(entries.join(shared.hint("merge"), "_bucket").select("_bucket", "_n", "_node", "_words", "_row"), "buckets")
        release(spark)

        # one row of each text, so that copies of a text don't meet; merged at every size, since the table of texts grows with the input
        sizes = saved(members.groupBy("_node").agg(F.sum("_n").alias("_score"), F.first("_row").alias("_row")), "sizes")
        texts = saved(rows.select("_node", "_row", "_t").join(sizes.select("_node", "_row").hint("merge"), ["_node", "_row"]).groupBy("_node").agg(F.first("_t").alias("_t")), "texts")
        release(spark)

        def verified(pairs: DataFrame, first: bool) -> DataFrame:
            some = texts
            if not first:  # a few of them
                ends = pairs.select(F.col("_a").alias("_node")).unionByName(pairs.select(F.col("_b").alias("_node"))).distinct()
                some = saved(texts.join(ends.hint("merge"), "_node", "left_semi"), "some")
            a = some.select(F.col("_node").alias("_a"), F.col("_t").alias("_ta")).hint("merge")
            b = some.select(F.col("_node").alias("_b"), F.col("_t").alias("_tb")).hint("merge")
            return saved(pairs.join(a, "_a").join(b, "_b").mapInArrow(lambda x: _verify(x, threshold), f"_a {_NODE}, _b {_NODE}, _ia {_NODE}, _ib {_NODE}"), "found")

        # each text is a class of its own at first
        left = members.join(sizes.select("_node", "_score"), "_node").select("_bucket", "_node", "_words", "_score", F.col("_node").alias("_its"))
        classes = tried = None

        def merged(joined: DataFrame) -> DataFrame:
            """The classes of all texts, with those of new links between classes."""
            if classes is None:
                return joined
            moved = classes.join(joined.select(F.col("_node").alias("_class"), F.col("_class").alias("_up")), "_class", "left").select("_node", F.coalesce("_up", "_class").alias("_class"))
            return saved(moved.unionByName(joined.join(classes, "_node", "left_anti")), "classes")

        for turn in range(turns + 1):
            orders = [F.xxhash64("_bucket", "_node", F.lit(turn), F.lit(k)) for k in range(PIVOTS)] if turn else [F.col("_score")]
            chosen = left.groupBy("_bucket").agg(*(F.max(F.struct(o.alias("_first"), "_node", "_words", "_its")).alias(f"_p{k}") for k, o in enumerate(orders)))
            each = F.array_distinct(F.array(*(F.struct(f"_p{k}._node", f"_p{k}._words", f"_p{k}._its") for k in range(len(orders)))))
            pairs = pairs_with(left, saved(chosen.select("_bucket", F.explode(each).alias("_p")), "pivots"), threshold)
            pairs = saved(pairs if tried is None else pairs.join(tried.hint("merge"), ["_a", "_b"], "left_anti"), "pairs")
            tried = pairs.select("_a", "_b") if tried is None else tried.unionByName(pairs.select("_a", "_b"))
            found = verified(pairs, first=not turn)
            joined = components(found.select(F.col("_ia").alias("_a"), F.col("_ib").alias("_b")))
            release(spark)
            classes = merged(joined)
            # buckets of several classes are left
            again = left.join(joined.select(F.col("_node").alias("_its"), F.col("_class").alias("_up")), "_its", "left").withColumn("_its", F.coalesce("_up", "_its")).drop("_up")
            mixed = again.groupBy("_bucket").agg(F.min("_its").alias("_low"), F.max("_its").alias("_high")).where("_low <> _high").select("_bucket")
            left = saved(again.join(mixed.hint("merge"), "_bucket"), "left")
            release(spark)
        if left.limit(1).count():
            found = rest_of_links(left, tried, texts, threshold)
            classes = merged(components(found.select(F.col("_ia").alias("_a"), F.col("_ib").alias("_b"))))
            release(spark)

        placed = kept(saved(sketched.select("_id", "_node").join(classes, "_node", "left").select("_id", "_node", F.coalesce("_class", "_node").alias("_class")), "placed"))
        first = F.min(F.struct(F.col("_id").isNull().alias("_none"), F.col("_id").alias("_id"), F.col("_node").alias("_node")))
        groups = kept(saved(placed.groupBy("_class").agg(first.alias("_first"), F.count(F.lit(1)).alias("class_size")).where("class_size > 1"), "groups"))
    alone = F.col("class_size").isNull()
    class_id = F.when(alone, F.col("_id")).otherwise(F.col("_first._id"))
    stays = alone | (F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_node") == F.col("_first._node")))
    out = placed.join(groups, "_class", "left")
    return out.select("_id", "_node", class_id.alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), stays.alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row of docs for each class, with all its columns; cases as in near_classes. Of rows that repeat an id and text any one stays."""
    rows = _judged(docs, id_col, text_col, threshold).select("_id", F.col("_node").alias("_digest"), F.col("kept").alias("_stays"))
    return one_of_each(docs, rows, id_col, node_of(text_of(text_col)))
