"""Licence scans by a trained paragraph classifier. DataFrame functions only on the executors.

A sparse logistic regression over words and word pairs tells licence families from one another and from other text. It is fitted on the driver, on the identifiers, names and paragraphs of license_texts and variations of them; a temperature is then fitted on further variations. A prediction stands only if its chance reaches LEAST_CHANCE (leave_one_out says what it does to families that the training hasn't seen), and if the paragraph has a name of the family in it or enough of the word triples of one of its paragraphs; else the licence is unknown.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import text_of
from weftline.llm.license_texts import FAMILIES, FRAMES, OTHERS, Family

#: Words that are no feature of their own.
STOP = frozenset("a all an and any are as at be by for from has have in is it its may no not of on or other shall that the this to was which with you your".split())

#: Least probability of a prediction, and least share of a template's triples in the paragraph.
LEAST_CHANCE, LEAST_TRIPLES = 0.55, 0.5

#: A paragraph ends at a blank line, or with a line that ends a sentence: wrapped lines are one paragraph.
PARAGRAPH = "\\n[ \\t\\r]*(?:\\n[ \\t\\r]*)+|(?<=[.!?:;])[ \\t\\r]*\\n"
#: What the paragraphs of license_texts have. No paragraph is left out for the want of these: identifiers alone ("This project is Apache-2.0.") have none.
CUES = "licen[sc]|copyright|rights|redistribut|permission|permitted|warrant|public domain|spdx|creative commons|creativecommons|\\bcc[ -]?(?:by|0)|\\b[al]?gpl|\\bmpl|\\bepl|unencumbered|as.is\\b|you must|you may|you are free|you can|anyone is free|strictly prohibited|misrepresented|reproduced|neither the name|unless required|liable|corresponding source"

_TOKEN = "[^a-z0-9.]+"
#: Bins of features on the executors.
BINS = 1024


def tokens(text: str) -> list[str]:
    return [w for w in (x.strip(".") for x in re.sub(_TOKEN, " ", text.lower()).split(" ")) if w]


def grams(words: list[str]) -> set[str]:
    """Words and pairs of neighbours, but for those of stop words alone."""
    return {w for w in words if w not in STOP} | {f"{a} {b}" for a, b in zip(words, words[1:]) if a not in STOP or b not in STOP}


def triples(words: list[str]) -> list[str]:
    n = min(3, len(words))
    return sorted({" ".join(words[i : i + n]) for i in range(len(words) - n + 1)})


@dataclass(frozen=True)
class Model:
    families: list[str]
    features: list[str]
    weights: np.ndarray  # features x (families and none)
    bias: np.ndarray
    temperature: float

    def chances(self, words: list[str]) -> np.ndarray:
        index = {f: i for i, f in enumerate(self.features)}
        z = (self.bias + self.weights[[index[g] for g in sorted(grams(words)) if g in index]].sum(axis=0)) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def statements(family: Family) -> list[str]:
    """Every way to state a licence: each name and identifier in its frames, and the paragraphs."""
    out = [frame.replace("{}", name) for frame in FRAMES if "{}" in frame for name in family.names]
    return out + [frame.replace("<>", i) for frame in FRAMES if "<>" in frame for i in family.ids] + list(family.texts)


def variations(families: dict[str, Family], seed: int, each: int) -> list[tuple[list[str], int]]:
    """Statements and other sentences, cut, with words left out and made-up words around them; the class is the family's place, the last one is none. Families have all their statements once, and as many parts of paragraphs each."""
    rng = random.Random(seed)

    def filler() -> list[str]:
        return ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(0, 12))]

    def varied(text: str) -> list[str]:
        words = tokens(text)
        if len(words) > 16 and rng.random() < 0.5:  # a part of a paragraph
            size = rng.randint(8, len(words) - 1)
            start = rng.randint(0, len(words) - size)
            words = words[start : start + size]
        return filler() + ([w for w in words if rng.random() > 0.04] or words) + filler()

    out = []
    for k, family in enumerate(families.values()):
        out += [(varied(text), k) for text in statements(family)]
        out += [(varied(rng.choice(family.texts)), k) for _ in range(each)]
    none = len(families)
    out += [(varied(rng.choice(OTHERS)), none) for _ in range(8 * each)]
    return out + [(filler() + rng.sample(sorted(STOP), 5) + filler(), none) for _ in range(4 * each)]


def fit(families: dict[str, Family] | None = None, each: int = 25, steps: int = 100, rate: float = 0.5, l2: float = 1e-4) -> Model:
    """Softmax regression by gradient steps; weights near zero are dropped. Deterministic."""
    families = FAMILIES if families is None else families
    sample = variations(families, 1, each)
    vocabulary = sorted({g for f in families.values() for t in statements(f) for g in grams(tokens(t))})
    index = {f: i for i, f in enumerate(vocabulary)}

    def design(rows: list[tuple[list[str], int]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(rows), len(vocabulary)))
        for r, (words, _) in enumerate(rows):
            x[r, [index[g] for g in grams(words) if g in index]] = 1
        return x, np.array([k for _, k in rows])

    x, y = design(sample)
    n = len(families) + 1
    w, b, target = np.zeros((len(vocabulary), n)), np.zeros(n), np.eye(n)[y]
    for _ in range(steps):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = p / p.sum(axis=1, keepdims=True) - target
        w -= rate * (x.T @ d / len(x) * 8 + l2 * w)
        b -= rate * d.mean(axis=0)
    w = np.round(np.where(abs(w) > 0.02, w, 0), 6)
    used = np.flatnonzero(abs(w).sum(axis=1))
    x, y = design(variations(families, 2, each))
    z = x @ w + b

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    return Model(list(families), [vocabulary[i] for i in used], w[used], np.round(b, 6), float(round(min(np.arange(0.3, 3.01, 0.1), key=loss), 2)))


def leave_one_out(least_chance: float = LEAST_CHANCE, each: int = 25) -> dict[str, dict[str, float]]:
    """For each family, what becomes of its statements: `known` by a model that has learnt it (the share that is named rightly, on variations that it hasn't seen), and, by a model that hasn't, the shares `unknown`, `none`, and `wrong` (named as another family)."""
    out = {}
    whole = fit(each=each)
    seen = variations(FAMILIES, 3, each)
    for k, name in enumerate(FAMILIES):
        others = {f: v for f, v in FAMILIES.items() if f != name}
        model = fit(others, each=each)
        texts = [words for words, c in seen if c == k]
        judged = [judge(words, model, least_chance) for words in texts]
        out[name] = {
            "known": sum((judge(words, whole, least_chance) or ("none",))[0] == name for words in texts) / len(texts),
            "unknown": sum(j is not None and j[0] == "unknown" for j in judged) / len(texts),
            "none": sum(j is None for j in judged) / len(texts),
            "wrong": sum(j is not None and j[0] != "unknown" for j in judged) / len(texts),
        }
    return out


def named_in(words: list[str], family: str) -> bool:
    """Whether the words have a name or identifier of the family."""
    whole = f" {' '.join(words)} "
    return any(f" {' '.join(tokens(n))} " in whole for n in (*FAMILIES[family].names, *FAMILIES[family].ids))


def judge(words: list[str], model: Model, least_chance: float = LEAST_CHANCE, least_triples: float = LEAST_TRIPLES) -> tuple[str, float] | None:
    """(family or unknown, chance) of a paragraph's words; None if they state no licence."""
    p = model.chances(words)
    k = int(p.argmax())
    if k == len(model.families):
        return None
    family, own = model.families[k], set(triples(words))
    fits = named_in(words, family) or any(len(own & set(triples(tokens(t)))) >= least_triples * len(triples(tokens(t))) for t in FAMILIES[family].texts)
    return (family if p[k] >= least_chance and fits else "unknown", round(float(p[k]), 6))


def _array(values: list) -> Column:
    """Values as one literal array."""
    return F.lit(list(values)) if values else F.array()


def _adder(weights: Column):
    return lambda total, i: total + F.element_at(weights, i)


def scan_licenses(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", least_chance: float = LEAST_CHANCE, least_triples: float = LEAST_TRIPLES) -> DataFrame:
    """_id and licenses, an array of (paragraph, family, chance) of each row: its paragraphs (from 0; see PARAGRAPH) that state a licence. The family is 'unknown' where the chance is under `least_chance` or neither a name nor a paragraph of the family confirms it.

    Every paragraph is scored. No shuffle; the model's size follows from license_texts.

    Cases: null and empty texts have no licence. Very long texts and paragraphs are read whole. Null ids and repeated rows pass through; an empty table gives an empty table; other columns are not touched.
    """
    model = model or fit()
    names = [*model.families, "none"]
    # features are dealt to bins by their crc32, so that a place is looked up in a bin and not in all of them
    deal = [zlib.crc32(f.encode()) % BINS for f in model.features]
    by_bin = sorted(range(len(deal)), key=lambda i: deal[i])
    bins = [[model.features[i] for i in by_bin if deal[i] == b] for b in range(BINS)]
    weights = model.weights[by_bin]
    columns = [F.lit([float(v) for v in weights[:, c]]) for c in range(len(names))]
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))

    def words_in(paragraph: Column) -> Column:
        cut = F.split(F.lower(paragraph), _TOKEN)
        return F.filter(F.transform(cut, lambda w: F.btrim(w, F.lit("."))), lambda w: w != "")

    def joined(words: Column, n: int) -> Column:
        last = F.size(words) - (n - 1)
        at = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.concat_ws(" ", *(F.get(words, i + (k - 1)) for k in range(n))))

    # so much none is ahead without features, and so much each feature gives the family it favours most over none: features that give less together can't state a licence
    ahead = float(model.bias[-1] - model.bias[:-1].max())
    gains = _array((weights[:, :-1] - weights[:, -1:]).max(axis=1, initial=-np.inf).tolist())
    alone = [f for f in model.features if " " not in f]
    pairs = [f.split(" ") for f in model.features if " " in f]
    begins, ends = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
    in_bins, before = F.array(*(_array(b) if b else F.array().cast("array<string>") for b in bins)), _array(np.cumsum([0, *(len(b) for b in bins)])[:-1].tolist())

    def place(g: Column) -> Column:
        """A feature's place, from 1 on; null if it is none."""
        b = F.pmod(F.crc32(g.cast("binary")), F.lit(BINS)).cast("int")
        at = F.array_position(F.get(in_bins, b), g).cast("int")
        return F.when(at > 0, F.get(before, b).cast("int") + at)

    def features(words: Column) -> Column:
        """Places of the words, then of the pairs, that are features, each once. Few words begin a pair, so few pairs are made."""
        own = F.array_distinct(F.filter(words, lambda w: w.isin(alone)))
        both = F.transform(words, lambda w, i: F.when(w.isin(begins) & F.get(words, i + 1).isin(ends), F.concat_ws(" ", w, F.get(words, i + 1))))
        both = F.array_distinct(F.filter(both, lambda g: g.isNotNull()))
        return F.filter(F.transform(F.concat(own, both), place), lambda i: i.isNotNull())

    def judged(at: Column) -> Column:
        """The families' scores of a paragraph's features, given by their places."""
        return F.array(*(F.aggregate(at, F.lit(float(b)), _adder(col), lambda s: s / F.lit(model.temperature)) for col, b in zip(columns, model.bias.tolist())))

    def pick(z: Column) -> Column:
        top = F.array_max(z)
        total = F.aggregate(z, F.lit(0.0), lambda s, x: s + F.exp(x - top))
        return F.struct(F.element_at(_array(names), F.array_position(z, top).cast("int")).alias("family"), (F.lit(1.0) / total).alias("chance"))

    some = rows.select("_id", F.transform(F.split("_t", PARAGRAPH), lambda p, i: F.struct(i.alias("paragraph"), p.alias("text"))).alias("_p"))
    some = some.withColumn("_s", F.transform("_p", lambda p: F.struct(p["paragraph"].alias("paragraph"), words_in(p["text"]).alias("words"))))
    some = some.withColumn("_s", F.transform("_s", lambda p: F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), features(p["words"]).alias("at"))))
    some = some.withColumn("_s", F.filter("_s", lambda p: F.aggregate(p["at"], F.lit(1e-6), _adder(gains)) >= F.lit(ahead)))
    some = some.withColumn("_s", F.transform("_s", lambda p: F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), judged(p["at"]).alias("z"))))
    some = some.withColumn("_s", F.transform("_s", lambda p: F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), pick(p["z"]).alias("best"))))
    some = some.withColumn("_s", F.filter("_s", lambda p: p["best"]["family"] != "none"))
    known = {f: FAMILIES[f] for f in model.families}
    by_text = F.array(*(F.struct(F.lit(k).alias("family"), _array(triples(tokens(t))).alias("triples")) for k, f in known.items() for t in f.texts))
    by_name = F.array(*(F.struct(F.lit(k).alias("family"), F.lit(f" {' '.join(tokens(n))} ").alias("name")) for k, f in known.items() for n in (*f.names, *f.ids)))

    def named(p: Column) -> Column:
        own = F.when(F.size(p["words"]) < 3, F.array(F.array_join(p["words"], " "))).otherwise(joined(p["words"], 3))
        whole = F.concat(F.lit(" "), F.array_join(p["words"], " "), F.lit(" "))
        fits = F.exists(by_name, lambda t: (t["family"] == p["best"]["family"]) & F.contains(whole, t["name"])) | F.exists(by_text, lambda t: (t["family"] == p["best"]["family"]) & (F.size(F.array_intersect(t["triples"], own)) >= F.lit(least_triples) * F.size(t["triples"])))
        return F.struct(p["paragraph"].alias("paragraph"), F.when((p["best"]["chance"] >= least_chance) & fits, p["best"]["family"]).otherwise(F.lit("unknown")).alias("family"), F.round(p["best"]["chance"], 6).alias("chance"))

    return some.select("_id", F.transform("_s", named).alias("licenses"))


def scan_one(text: str | None, model: Model, least_chance: float = LEAST_CHANCE, least_triples: float = LEAST_TRIPLES) -> list[tuple[int, str, float]]:
    """What scan_licenses finds in one text, in plain Python; the tests compare the two."""
    out = []
    for i, paragraph in enumerate(re.split(PARAGRAPH, text or "")):
        if found := judge(tokens(paragraph), model, least_chance, least_triples):
            out.append((i, *found))
    return out
