import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import langid

from .edge import ROWS, edge, none


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(langid.training_rows(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.detect(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_spans_of_mixed_text(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 900 and doc_id < 60").collect() if "%" not in r.text and "!!" not in r.text}
    text = docs["en"][:300] + " " + docs["de"][:300] + " " + docs["fr"][:200]
    (row,) = langid.detect(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).collect()
    names = [s.lang for s in row.spans]
    assert names == ["en", "de", "fr"]
    assert abs(row.spans[0].end - 300) < 25 and abs(row.spans[1].start - 301) < 25 and abs(row.spans[2].start - 602) < 25
    assert all(a.end < b.start for a, b in zip(row.spans, row.spans[1:]))


def brute_viterbi(scores, switch):
    best, back = scores[0].copy(), []
    for s in scores[1:]:
        step = best[None, :] - switch * (1 - np.eye(len(best)))
        back.append(step.argmax(axis=1))
        best = step.max(axis=1) + s
    path = [best.argmax()]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def path_score(scores, path, switch):
    return sum(s[k] for s, k in zip(scores, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_of_many_documents_is_each_ones_best_path():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 5, 1, 40, 7, 0, 23])
    scores = rng.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    labels = langid.viterbi(scores, lengths, 4.0)
    at = 0
    for n in lengths:
        if n:
            part = scores[at : at + n].astype(float)
            assert path_score(part, labels[at : at + n], 4.0) == pytest.approx(path_score(part, brute_viterbi(part, 4.0), 4.0), abs=1e-3)
        at += n


def test_scripts_rule_languages_out():
    model = langid.fit([("привет как дела сегодня вечером", "ru"), ("hello how are you this evening", "en")])
    codes = np.concatenate(([0], langid._codes("ok да 你好"), [0]))
    words = langid.words_of(codes)
    scores = model.word_scores(words)
    assert model.languages == ["en", "ru"]
    assert scores[0, 1] < -40 and scores[1, 0] < -40 and abs(scores[2, 0] - scores[2, 1]) < 40


def test_training_rows_are_neither_held_out_nor_unlabelled(spark):
    rows = langid.training_rows(edge(spark))
    assert all(t is not None and lang is not None for t, lang in rows)
    assert len(langid.training_rows(edge(spark), max_docs=2)) == 2


def test_edge_rows_and_empty_table(spark, model):
    rows = langid.detect(edge(spark), model).collect()
    assert len(rows) == len(ROWS)
    assert all(r.lang_pred == "und" and r.score == 0 and r.spans == [] for r in rows if r.doc_id in (3, 5))
    assert all(r.lang_pred == "en" and 0 < r.score <= 1 for r in rows if r.doc_id in (1, 2, 4))
    assert langid.detect(none(spark), model).count() == 0
    assert langid.fit([]).languages == ["und"]
