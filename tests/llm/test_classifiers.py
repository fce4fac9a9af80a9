import random
import re

import numpy as np
from pyspark.sql import functions as F

from weftline.llm import crf, quality, toxicity
from weftline.llm.common import crc_of_id
from weftline.llm.license_scan import CUES, fit, leave_one_out, scan_licenses, scan_one, statements
from weftline.llm.license_texts import FAMILIES, OTHERS

from .conftest import prose

BAD = ["glarg", "vornik", "zupst"]


def brute_marginals(emit, trans):
    n = len(emit)
    total = np.zeros(n)
    z = 0.0
    for code in range(2**n):
        y = [(code >> i) & 1 for i in range(n)]
        w = np.exp(sum(e for e, k in zip(emit, y) if k) + sum(trans[a][b] for a, b in zip(y, y[1:])))
        z += w
        total += w * np.array(y)
    return total / z


def test_marginals_and_expectations_equal_enumeration():
    rng = np.random.default_rng(1)
    lengths = [3, 0, 5, 1, 7, 4]
    emit, trans = rng.normal(size=sum(lengths)) * 2, rng.normal(size=(2, 2))
    chains = crf.Chains(np.array(lengths))
    want = np.concatenate([brute_marginals(e, trans) for e in np.split(emit, np.cumsum(lengths)[:-1]) if len(e)])
    assert np.allclose(crf.marginals(chains, emit, trans), want)
    p, pairs = crf.expectations(chains, emit, trans)
    assert np.allclose(p, want) and np.isclose(pairs.sum(), sum(max(0, n - 1) for n in lengths))
    step = 1e-5  # the expected transitions are the gradient of log z
    for i in range(2):
        for j in range(2):
            up, down = trans.copy(), trans.copy()
            up[i, j] += step
            down[i, j] -= step

            def log_z(t):
                out = 0.0
                for e in np.split(emit, np.cumsum(lengths)[:-1]):
                    if len(e):
                        out += np.log(sum(np.exp(sum(x for k, x in enumerate(e) if c >> k & 1) + sum(t[c >> k & 1][c >> k + 1 & 1] for k in range(len(e) - 1))) for c in range(2 ** len(e))))
                return out

            assert np.isclose((log_z(up) - log_z(down)) / (2 * step), pairs[i, j], atol=1e-4)


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng, 60).split(" ")
        y = int(i % 4 == 0)
        if y:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "en", "ta", "."]))
        rows.append((i, " ".join(words), y))
    return rows


def test_toxicity_on_held_out_rows(spark, odd_docs, no_docs):
    rows = toxic_rows(400, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    tagger = toxicity.fit_toxicity(docs, labels, crc_of_id("doc_id") % 3 != 1)
    held = {r.doc_id for r in docs.where(crc_of_id("doc_id") % 3 == 1).collect()}
    got = {r._id: r for r in toxicity.score_toxicity(docs, tagger).collect()}
    right = [got[i]._predicted == y for i, _, y in rows if i in held]
    assert len(right) > 100 and np.mean(right) >= 0.97
    texts = {i: t for i, t, _ in rows}
    found = [texts[i][s.start : s.end] for i, r in got.items() for s in r._spans]
    assert found and np.mean([any(b in f for b in BAD) for f in found]) > 0.95
    assert {r.doc_id for r in toxicity.drop_toxic(docs, tagger).collect()} == {i for i, r in got.items() if not r._predicted}
    odd = toxicity.score_toxicity(odd_docs, tagger).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r._score <= 1 for r in odd)
    assert toxicity.drop_toxic(odd_docs, tagger).columns == odd_docs.columns
    assert toxicity.score_toxicity(no_docs, tagger).count() == 0


def test_training_without_labels(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    t = toxicity.fit_toxicity(odd_docs, labels, F.lit(True))
    q = quality.fit_quality(odd_docs, labels, F.lit(True))
    assert all(r._predicted == 0 for r in toxicity.score_toxicity(odd_docs, t).collect())
    assert all(0 <= r._score <= 1 for r in quality.score_quality(odd_docs, q).collect())


def test_quality_on_held_out_rows(spark, odd_docs, no_docs):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        lines = [prose(rng, rng.randint(5, 20)).capitalize() + "." for _ in range(rng.randint(1, 6))]
        y = int(i % 4 != 0)
        if not y:
            k = rng.randrange(3)
            lines = [x.upper() + "!!" if k == 0 else " ".join([x.split()[0]] * 30) if k == 1 else x.replace(" ", "### ") for x in lines]
        rows.append((i, "\n".join(lines), y))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    tagger = quality.fit_quality(docs, labels, crc_of_id("doc_id") % 5 != 0)
    held = {r.doc_id for r in docs.where(crc_of_id("doc_id") % 5 == 0).collect()}
    got = {r._id: r._predicted for r in quality.score_quality(docs, tagger).collect()}
    assert np.mean([got[i] == y for i, _, y in rows if i in held]) >= 0.97
    assert quality.score_quality(odd_docs, tagger).count() == odd_docs.count()
    assert quality.score_quality(no_docs, tagger).count() == 0


#: Statements as they are found in the wild, none of them a text that the model learns from, and what they state.
IN_THE_WILD = [
    ("SPDX-License-Identifier: MIT", "mit"),
    ("GNU GPL v3", "gpl"),
    ("ISC License", "isc"),
    ("# Licensed under the Apache License, Version 2.0 (the License);\n# you may not use this file except in compliance with the License.", "apache-2.0"),
    ("You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Redistributions in binary form must reproduce the above copyright\n    notice, this list of conditions and the following disclaimer in the\n    documentation and/or other materials provided with the distribution.", "bsd"),
    ("Released under the\nMIT License.", "mit"),
    ("All\nrights reserved.", "proprietary"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl-2.0"),
    ("The data set is licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License", "gpl"),
    ("licensed under the GNU Lesser General Public License", "lgpl"),
    ("To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this work.", "public-domain"),
    ("Licensed under the Fancy Open License, version 9.", "unknown"),
]


def test_licenses_native_equals_plain(spark, odd_docs, no_docs):
    model = fit()
    rng = random.Random(2)
    texts = [prose(rng, 5) + ".\n" + t + ("" if t[-1] in ".:;" else "\n") + "\n" + prose(rng, 3) for f in FAMILIES.values() for t in statements(f)[::5] + list(f.texts)]
    texts += [t for t, _ in IN_THE_WILD] + ["all rights", "", "the license of the driver", "License\n\nAll rights reserved.", *OTHERS]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    got = sorted(((r._id, [(x.paragraph, x.family) for x in r.licenses]) for r in scan_licenses(docs, model).collect()), key=str)
    want = sorted(((r.doc_id, [x[:2] for x in scan_one(r.text, model)]) for r in docs.collect()), key=str)
    assert got == want
    assert scan_licenses(no_docs, model).count() == 0


def test_licenses_in_the_wild():
    model = fit()
    for text, family in IN_THE_WILD:
        assert family in [f for _, f, _ in scan_one(text, model)], text
    assert all(t not in f.texts for t, _ in IN_THE_WILD for f in FAMILIES.values())
    assert sum(scan_one(t, model) != [] for t in OTHERS) == 0


def test_every_statement_has_a_cue():
    cue = re.compile(CUES, re.I | re.A)
    assert [t for f in FAMILIES.values() for t in f.texts if not cue.search(t)] == []


def test_families_left_out_are_not_taken_for_others():
    table = leave_one_out(each=10)
    close = {"gpl", "lgpl", "agpl", "cc-by", "cc-by-sa", "cc-by-nc"}  # their statements name one another
    assert np.mean([v["known"] for v in table.values()]) >= 0.8
    assert max(v["wrong"] for k, v in table.items() if k not in close) <= 0.05


def test_statements_without_a_cue_are_scored(spark):
    texts = [("This project is Apache-2.0.", "apache-2.0"), ("BSD-3-Clause", "bsd"), ("Some prose first.\nDual MIT / Apache-2.0", "apache-2.0"), ("Sie kamen mit dem Schiff und mit vielen Freunden.", None)]
    assert not any(re.search(CUES, t, re.I | re.A) for t, _ in texts)
    docs = spark.createDataFrame(list(enumerate(t for t, _ in texts)), "doc_id long, text string")
    got = {r._id: [x.family for x in r.licenses] for r in scan_licenses(docs).collect()}
    assert got == {k: [f] if f else [] for k, (_, f) in enumerate(texts)}


def test_features_are_looked_up_not_intersected(spark):
    """Nothing goes through all features for each paragraph."""
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    plan = scan_licenses(docs)._jdf.queryExecution().analyzed().toString()
    assert "array_intersect(array_union(" not in plan and "crc32(" in plan
