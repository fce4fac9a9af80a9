"""Toxic spans by a linear-chain conditional random field over words."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import crf
from weftline.llm.common import labelled_sample, slices, text_of
from weftline.llm.words import gram_hashes, word_hashes

WORD = re.compile(r"\w+")
#: Bound of the training sample: texts of each class (at most twice as many), and characters of a text.
PER_CLASS, MAX_CHARS = 700, 20_000
#: Prefix lengths that are features beside the whole word, so that inflected forms share what is learned.
PREFIXES = (4, 5, 6)
#: Share of the sample's texts that have a feature which is learnt though it marks no toxic word; distinct words kept at hand.
COMMON, MAX_WORDS = 0.02, 100_000
_CAP = 12.0


def features(word: str) -> list[str]:
    w = word.lower()
    return ["=" + w, *(f"{n}{w[:n]}" for n in PREFIXES if len(w) >= n)]


@dataclass
class Tagger:
    """Weights of a word's own features, of its neighbours' whole words, transitions, and the curve from the strongest word to a document's score."""

    own: dict[str, float] = field(default_factory=dict)
    before: dict[str, float] = field(default_factory=dict)
    after: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 0.0
    level: float = -4.0
    cache: _Codes | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": None}

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The chance that each word is toxic, and where each text's words begin; a line is a sequence."""
        if self.cache is None or len(self.cache) > MAX_WORDS:
            self.cache = _Codes(self)
        words, lengths, first = [], [], [0]
        for text in texts:
            for line in text.split("\n"):
                found = WORD.findall(line)
                if found:
                    words += found
                    lengths.append(len(found))
            first.append(len(words))
        if not words:
            return np.empty(0), np.array(first)
        codes = np.fromiter(map(self.cache.__getitem__, words), dtype=np.int64, count=len(words))
        own, before, after = (np.frombuffer(x)[codes] for x in self.cache.weights)
        chains = crf.Chains(np.array(lengths))
        emit = own + self.bias
        inner = np.flatnonzero(chains.follows)
        emit[inner] += before[inner - 1]
        emit[inner - 1] += after[inner]
        return crf.marginals(chains, emit, self.trans), np.array(first)

    def strongest(self, texts: list[str]) -> np.ndarray:
        """The log-odds of each text's most toxic word; the floor where there is no word."""
        p, first = self.probabilities(texts)
        out = np.full(len(texts), -_CAP)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            out[some] = np.clip(crf.logit(np.maximum.reduceat(p, first[some]), 1e-9), -_CAP, _CAP)
        return out

    def score(self, texts: list[str]) -> list[tuple[float, list[dict]]]:
        """Of each text, the score and the toxic spans (start and end in code points; neighbouring toxic words of a line are one span)."""
        p, first = self.probabilities(texts)
        out = []
        for i, text in enumerate(texts):
            own = p[first[i] : first[i + 1]]
            z = float(np.clip(crf.logit(own.max(), 1e-9), -_CAP, _CAP)) if len(own) else -_CAP
            spans: list[dict] = []
            if len(own) and own.max() >= 0.5:
                previous = -2
                for k, m in enumerate(WORD.finditer(text)):
                    if own[k] >= 0.5:
                        if previous == k - 1 and "\n" not in text[spans[-1]["end"] : m.start()]:
                            spans[-1]["end"] = m.end()
                        else:
                            spans.append({"start": m.start(), "end": m.end()})
                        previous = k
            out.append((float(crf.logistic(np.array(self.slope * z + self.level))), spans))
        return out


class _Codes(dict):
    """A number for each word seen, and by number the weights of its features as itself, as the word before and as the word after."""

    def __init__(self, tagger: Tagger) -> None:
        self.own, self.before, self.after = tagger.own, tagger.before, tagger.after
        self.weights = (array("d"), array("d"), array("d"))

    def __missing__(self, word: str) -> int:
        names = features(word)
        for column, value in zip(self.weights, (sum(self.own.get(n, 0.0) for n in names), self.before.get(names[0], 0.0), self.after.get(names[0], 0.0))):
            column.append(value)
        self[word] = code = len(self)
        return code


def distinct_families(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Leave out a text that shares one of three smallest five-word hashes with an earlier one: near copies would otherwise vote many times."""
    seen: set = set()
    out = []
    for text, y in sample:
        h = gram_hashes(word_hashes([text])[0], 5)
        marks = {(k, int((h * np.uint64(2 * k + 3)).min())) for k in range(3)} if len(h) else {text}
        if not marks & seen:
            out.append((text, y))
        seen |= marks
    return out


def gain(a: int, b: int, n_a: int, n_b: int) -> float:
    """Twice the log-likelihood that a rate of its own in each class gains, a of n_a and b of n_b."""

    def part(k: int, n: int, p: float) -> float:
        return (k * np.log(p) if k else 0.0) + ((n - k) * np.log(1 - p) if n > k else 0.0)

    both = (a + b) / (n_a + n_b)
    return 2 * (part(a, n_a, a / n_a) + part(b, n_b, b / n_b) - part(a, n_a, both) - part(b, n_b, both))


def train(sample: list[tuple[str, int]], least_texts: int = 3, least_odds: float = 3.0, least_gain: float = 26.0) -> Tagger:
    """Learn from whole texts that are labelled toxic (1) or not (0).

    Words get labels first: in a toxic text, a word is toxic if one of its features has smoothed log-odds of `least_odds` or more between toxic and other texts, and a likelihood ratio statistic of `least_gain` or more, so that hardly any of tens of thousands of features gets there by chance; all other words are not. A feature counts in toxic texts once for each different pair of neighbouring words, so that a passage which many texts share has one vote. The field is then fitted to these labels, and the documents' curve to the documents' labels.
    """
    whole, sample = sample, distinct_families(sample)
    n = [sum(y == k for _, y in sample) for k in (0, 1)]
    tagger = Tagger()
    y_doc = np.array([y for _, y in whole], dtype=float)
    if not n[1] or not n[0]:
        tagger.slope, tagger.level = crf.calibrate(np.zeros(len(whole)), y_doc) if len(whole) else (0.0, -4.0)
        return tagger
    texts = [[[w for w in WORD.findall(line)] for line in t.split("\n")] for t, _ in sample]
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for lines, (_, y) in zip(texts, sample):
        seen[y].update({f for line in lines for w in line for f in features(w)})
    def stands_out(f: str, c: int) -> bool:
        odds = np.log((c + 0.5) / (n[1] + 1)) - np.log((seen[0][f] + 0.5) / (n[0] + 1))
        return bool(odds >= least_odds) and gain(c, seen[0][f], n[1], n[0]) >= least_gain

    around: dict[str, set] = {f: set() for f, c in seen[1].items() if stands_out(f, c)}
    for lines, (_, y) in zip(texts, sample):
        for line in lines if y else ():
            for before, w, after in zip(["", *line], line, [*line[1:], ""]):
                for f in features(w):
                    if f in around:
                        around[f].add((before, after))
    strong = {f for f, places in around.items() if stands_out(f, min(seen[1][f], len(places)))}
    common = {f for c in seen for f in c if seen[0][f] + seen[1][f] >= max(least_texts, COMMON * len(sample))}
    ids = {f: i + 1 for i, f in enumerate(sorted(strong | common))}
    width, size = 1 + len(PREFIXES), len(ids) + 1
    rows, labels, lengths = array("q"), array("b"), []
    for lines, (_, y) in zip(texts, sample):
        for line in lines:
            if line:
                lengths.append(len(line))
                for w in line:
                    names = features(w)
                    rows.extend([ids.get(f, 0) for f in names] + [0] * (width - len(names)))
                    labels.append(int(y == 1 and any(f in strong for f in names)))
    x, y = np.array(rows).reshape(-1, width), np.array(labels, dtype=np.int64)
    chains = crf.Chains(np.array(lengths))
    before, after = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    inner = np.flatnonzero(chains.follows)
    before[inner], after[inner - 1] = x[inner - 1, 0], x[inner, 0]
    columns = [*(x[:, k] for k in range(width)), size + before, 2 * size + after]

    def emission(w: np.ndarray) -> np.ndarray:
        out = np.full(len(x), w[-1])
        for c in columns:
            out += w[c]
        return out

    def gradient(d: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(c, weights=d, minlength=3 * size + 1) for c in columns)
        out[[0, size, 2 * size]] = 0
        out[-1] = d.sum()
        return out

    w, tagger.trans = crf.fit(chains, y, emission, gradient, 3 * size + 1, steps=40)
    tagger.trans = tagger.trans.copy()
    tagger.bias = float(w[-1])
    for k, target in enumerate((tagger.own, tagger.before, tagger.after)):
        target.update({f: float(w[k * size + i]) for f, i in ids.items() if abs(w[k * size + i]) > 0.01})
    z = np.concatenate([tagger.strongest([t for t, _ in whole[a:b]]) for a, b in slices([t for t, _ in whole])])
    tagger.slope, tagger.level = crf.calibrate(z, y_doc)
    return tagger


def score_toxicity(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """_id, _score (0 to 1), _predicted (1 from the threshold on) and _spans (toxic spans in code points) of every row of docs.

    No shuffle; the model is bounded by the training sample's bound.

    Cases: null and empty texts, and texts without words, get the score of a text whose words are surely not toxic. Very long texts are read whole. Repeated rows and null ids pass through; a tie at the threshold counts as toxic; empty tables stay empty; other columns are not touched.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            got = [x for a, b in slices(texts) for x in tagger.score(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in got], pa.float64()), pa.array([int(s >= threshold) for s, _ in got], pa.int32()), pa.array([x for _, x in got], spans_type)], ["_id", "_score", "_predicted", "_spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _score double, _predicted int, _spans array<struct<start:bigint,end:bigint>>")


def drop_toxic(docs: DataFrame, tagger: Tagger, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose score is under the threshold, with their columns; cases as in score_toxicity."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            keep = [s < threshold for a, b in slices(texts) for s, _ in tagger.score(texts[a:b])]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, eligible: Column, label: str = "toxic") -> Tagger:
    """Train on the bounded sample of labelled rows that are eligible (a condition on doc_id)."""
    return train(labelled_sample(docs, labels, label, eligible, PER_CLASS, MAX_CHARS))
