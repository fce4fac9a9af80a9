"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import crf
from weftline.llm.common import labelled_sample, slices, text_of
from weftline.llm.words import word_hashes

#: Bound of the training sample: texts of each class (at most twice as many), and characters of a text.
PER_CLASS, MAX_CHARS = 1500, 20_000
#: Cut points of a line feature that its bins have.
CUTS = 6

_CLASS = np.zeros(256, dtype=np.int64)
for _k, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b".,;:'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(0xC3, 0xC4)), bytes(range(0xD0, 0xD2)), bytes(range(0x80, 0xC0))), 1):
    _CLASS[list(_set)] = _k


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features for each line, the lines' lengths in characters, and where each text's lines begin.

    Features: shares of upper case, digits, ! and ?, punctuation, symbols and Cyrillic letters; words; letters a word; shares of words that equal the word one, two or three before; whether another line of the text is the same; length.
    """
    lines, first = [], [0]
    for text in texts:
        lines += text.split("\n")
        first.append(len(lines))
    first = np.array(first)
    length = np.array([len(x) for x in lines], dtype=float)
    parts = [x.encode("utf-8", "surrogatepass") for x in lines]
    data = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
    at = np.cumsum([0, *(len(p) + 1 for p in parts)])
    classes = _CLASS[data]
    owner = np.repeat(np.arange(len(lines)), np.diff(at))
    counts = np.bincount(owner * 9 + classes, minlength=9 * len(lines)).reshape(-1, 9)
    some = np.maximum(length, 1)
    shares = [counts[:, k] / some for k in (1, 2, 3, 4, 5, 7)]
    hashes, begin = word_hashes(lines)
    words = np.diff(begin).astype(float)
    owner = np.repeat(np.arange(len(lines)), np.diff(begin))
    repeats = []
    for lag in (1, 2, 3):
        same = np.zeros(len(hashes))
        if len(hashes) > lag:
            same[lag:] = (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag])
        repeats.append(np.bincount(owner, weights=same, minlength=len(lines)) / np.maximum(words, 1))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    keys: dict = {}
    which = np.array([keys.setdefault((d, x), len(keys)) for d, x in zip(doc.tolist(), lines)])
    twin = (np.bincount(which)[which] > 1) & (words > 0)
    return np.stack([*shares, words, (length - words) / np.maximum(words, 1), *repeats, twin.astype(float), length], axis=1), length, first


@dataclass
class LineTagger:
    """Cut points of the features, weights of a line's own, the previous and the next line's bins, transitions, and the curve from a document's mean to its score."""

    cuts: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 0.0
    level: float = 0.0

    def design(self, x: np.ndarray, chains: crf.Chains) -> np.ndarray:
        """Indicators of every feature's value being over each cut, for the line and its neighbours, and a constant."""
        own = (x[:, :, None] > self.cuts[None]).reshape(len(x), -1).astype(np.float32)
        before, after = np.zeros_like(own), np.zeros_like(own)
        inner = np.flatnonzero(chains.follows)
        before[inner], after[inner - 1] = own[inner - 1], own[inner]
        return np.concatenate([own, before, after, np.ones((len(x), 1), dtype=np.float32)], axis=1)

    def means(self, texts: list[str]) -> np.ndarray:
        """The log-odds of each text's length-weighted mean chance that a line is good."""
        x, length, first = line_features(texts)
        if not len(self.weights):
            return np.zeros(len(texts))
        chains = crf.Chains(np.diff(first))
        p = crf.marginals(chains, self.design(x, chains) @ self.weights, self.trans)
        weight = np.maximum(length, 1)
        return crf.logit(np.add.reduceat(p * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]), 1e-4)

    def scores(self, texts: list[str]) -> np.ndarray:
        return crf.logistic(self.slope * self.means(texts) + self.level) if texts else np.empty(0)


def train(sample: list[tuple[str, int]]) -> LineTagger:
    """Learn from whole texts of good (1) and bad (0) quality: lines take their text's label, the field is fitted to the lines, the curve to the texts."""
    tagger = LineTagger()
    texts, y_doc = [t for t, _ in sample], np.array([y for _, y in sample], dtype=float)
    if len(set(y_doc.tolist())) < 2:
        tagger.slope, tagger.level = crf.calibrate(np.zeros(len(texts)), y_doc)
        return tagger
    # a slice at a time: arrays of all characters at once would be many times the sample
    parts = [line_features(texts[a:b]) for a, b in slices(texts)]
    x, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([np.diff(p[2]) for p in parts])
    y = np.repeat(y_doc.astype(np.int64), sizes)
    chains = crf.Chains(sizes)
    # cut points from both classes alike, so that a rare class shapes them too
    at = np.linspace(0, 1, CUTS + 2)[1:-1]
    tagger.cuts = np.sort(np.concatenate([np.quantile(x[y == k], at[k::2], axis=0) for k in (0, 1)]), axis=0).T
    d = tagger.design(x, chains)
    w, trans = crf.fit(chains, y, lambda w: d @ w.astype(np.float32), lambda r: r.astype(np.float32) @ d, d.shape[1], steps=80, rate=0.1, l2=0.3)
    tagger.weights, tagger.trans = w.copy(), trans.copy()
    tagger.slope, tagger.level = crf.calibrate(np.concatenate([tagger.means(texts[a:b]) for a, b in slices(texts)]), y_doc)
    return tagger


def score_quality(docs: DataFrame, tagger: LineTagger, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """_id, _score (0 to 1) and _predicted (1 from the threshold on) of every row of docs.

    No shuffle; the model has a fixed size.

    Cases: null and empty texts count as one empty line. Very long texts and lines are read whole. Repeated rows and null ids pass through; a tie at the threshold counts as good; empty tables stay empty; other columns are not touched.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            s = np.concatenate([tagger.scores(texts[a:b]) for a, b in slices(texts)]) if texts else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], ["_id", "_score", "_predicted"])

    return rows.mapInArrow(run, f"_id {docs.schema[id_col].dataType.simpleString()}, _score double, _predicted int")


def fit_quality(docs: DataFrame, labels: DataFrame, eligible: Column, label: str = "quality") -> LineTagger:
    """Train on the bounded sample of labelled rows that are eligible (a condition on doc_id)."""
    return train(labelled_sample(docs, labels, label, eligible, PER_CLASS, MAX_CHARS))
