import re

import numpy as np
import pytest

from cadenza.llm import licenses
from cadenza.llm.licenses import TEMPLATES, licences, scan

from .edge import ROWS, docs_of, edge, none


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return licenses.fit(spark, docs)


def test_notices_in_the_sample_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {"gpl": "GNU General Public", "cc-by-nc": "CC BY-NC", "mit": "MIT License", "apache": "Apache License", "proprietary": "All rights reserved"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = licences(docs, *model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sorted(k for k, w in words.items() if w in texts[r.doc_id])
        assert r.families == want and r.licence == (r.families[0] if len(want) == 1 else "none" if not want else r.licence)


def test_wordings(spark, model):
    texts = [
        "intro\nThis file is licensed under the Apache License, Version 2.0\nmore", "Released under the MIT License",
        "This work is licensed under the GNU General Public License, version 2.", "Licensed under CC BY-SA 3.0.",
        "She got her driving licence on the third attempt and was proud of it.", "copyright law is a broad field of study in most countries",
        "no notice here", *(t for _, t in TEMPLATES),
    ]
    got = {r.doc_id: r.licence for r in licences(docs_of(spark, texts), *model).collect()}
    assert [got[k] for k in range(7)] == ["apache", "mit", "gpl", "cc-by-sa", "unknown", "unknown", "none"]
    assert [got[7 + k] for k in range(len(TEMPLATES))] == [f for f, _ in TEMPLATES]


UNSEEN = [
    "Licensed under the Eclipse Public License 2.0.", "This package is distributed under the Artistic License 2.0.",
    "This document is licensed under the GNU Free Documentation License, version 1.3.",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Licensed under the European Union Public Licence, version 1.2.", "Released under the Boost Software License, Version 1.0.",
]


def test_families_without_templates_are_unknown(spark, model):
    rows = scan(docs_of(spark, UNSEEN), *model).collect()
    assert {r.doc_id: r.family for r in rows} == dict.fromkeys(range(len(UNSEEN)), "unknown")


def test_one_common_first_line_does_not_empty_the_sample(spark):
    docs = docs_of(spark, ["the same first line of them all"] * 3000 + [f"another line {k} of its own" for k in range(300)])
    found = licenses.examples(spark, docs, 100).where("family = 'none'")
    assert found.count() == 100


def test_fit_and_scores_against_numpy(spark):
    """The same regression by plain gradient steps on a dense matrix."""
    docs = docs_of(spark, [f"an ordinary line {k} about {'rivers' if k % 2 else 'mountains'} and the people there" for k in range(30)])
    rows = licenses.examples(spark, docs, 20).collect()

    def grams(lower):
        words = re.findall("[a-z0-9]+", lower)
        return set(words) | set(zip(words, words[1:]))

    train = [r for r in rows if not r.held]
    names = {g: k for k, g in enumerate(sorted(set().union(*(grams(r.lower) for r in train)), key=str))}

    def vector(lower):
        x, own = np.zeros(len(names)), grams(lower)
        for g in own & names.keys():
            x[names[g]] = 1 / np.sqrt(len(own))
        return x

    x = np.array([vector(r.lower) for r in train])
    y = np.array([[float(r.family == c) for c in licenses.CLASSES] for r in train])
    rate = licenses.RATE / y.sum(axis=0)[y.argmax(axis=1)]
    w = np.zeros((len(names), len(licenses.CLASSES)))
    for _ in range(3):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        w += x.T @ (rate[:, None] * (y - p / p.sum(axis=1, keepdims=True)))
    weights, temperature = licenses.fit(spark, docs, 20, steps=3)
    texts = ["Released under the MIT License.", "Licensed under CC BY 4.0.", UNSEEN[0]]
    got = {r.doc_id: r.probability for r in scan(docs_of(spark, texts), weights, temperature).collect()}
    for k, text in enumerate(texts):
        z = vector(text.lower()) @ w / temperature
        p = np.exp(z - z.max())
        assert abs(got[k] - (p / p.sum())[:-1].max()) < 1e-6


def test_probabilities_and_shares(spark, model):
    rows = scan(docs_of(spark, ["Released under the MIT License.\nLicensed under CC BY 4.0."]), *model).collect()
    assert sorted((r.paragraph, r.family) for r in rows) == [(0, "mit"), (1, "cc-by")]
    assert all(0.5 <= r.probability <= 1 and 0.6 <= r.shared <= 1 for r in rows)


def test_edge_rows_and_empty_table(spark, model):
    rows = licences(edge(spark), *model).collect()
    assert len(rows) == len(ROWS) and {r.licence for r in rows} == {"none"}
    assert licences(none(spark), *model).count() == 0
    weights, temperature = licenses.fit(spark, none(spark).select("doc_id", "text"), steps=2)
    assert licences(docs_of(spark, ["Released under the MIT License."]), weights, temperature).count() == 1


def test_notices_without_a_listed_word_are_scored(spark, model):
    texts = [
        "You may not use this file except in compliance with the terms given to you.",
        "an intro\nDistributed on an \"AS IS\" BASIS, either express or implied, unless required by applicable law or agreed to in writing",
        "In no file is the law of the river given.", "word " * 3000 + "basis",
    ]
    assert not any(c in t.lower() for t in texts for c in licenses.CUES)
    assert [(r.paragraph, r.family) for r in scan(docs_of(spark, texts), *model).orderBy("doc_id").collect()] == [(0, "apache"), (1, "apache")]


def test_only_paragraphs_that_a_template_could_confirm_are_stored_and_scored(spark, model, monkeypatch):
    # Words of three families, but not three n-grams of any one: no score would make these a notice.
    texts = ["an apache in the unencumbered land of mozilla, as the river goes by to the sea and the law", "Licensed under CC BY 4.0.",
             "You may not use this file except in compliance with the terms given to you."]
    stored, cut = [], licenses.cut_lineage

    def seen(df):
        out = cut(df)
        stored.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(licenses, "cut_lineage", seen)
    rows = scan(docs_of(spark, texts), *model).orderBy("doc_id").collect()
    assert [(r.doc_id, r.family) for r in rows] == [(1, "cc-by"), (2, "apache")]
    assert (["lower", "text"], 2) in stored
