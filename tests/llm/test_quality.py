import numpy as np

from cadenza.llm import quality

from .edge import ROWS, edge, none


def test_held_out_accuracy_and_calibration(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(quality.training_rows(docs, labels))
    rows = quality.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    score, label = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    good, bad = score[label == 1], score[label == 0]
    assert len(good) > 30 and len(bad) >= 5
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([(r.predicted == 1) == (r.quality == 1) for r in rows]) > 0.95
    assert ((score - label) ** 2).mean() < 0.06


def test_held_out_rows_teach_nothing(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = labels.where(~quality.held_out(labels.doc_id))
    assert quality.training_rows(docs, labels) == quality.training_rows(docs, kept)
    assert len(quality.training_rows(docs, labels, max_docs=7)) == 7


def test_fit_and_score_are_repeatable(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    one, two = (sorted(quality.score(docs, quality.fit(quality.training_rows(docs, labels))).collect()) for _ in range(2))
    assert one == two


def test_edge_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (4, 1), (6, 0), (6, 0), (None, 1), (77, 0), (5, None)], "doc_id bigint, quality int")
    model = quality.fit(quality.training_rows(edge(spark), labels))
    rows = quality.score(edge(spark), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 5)}) == 1  # texts without words
    assert quality.score(none(spark), model).count() == 0
    assert quality.fit(quality.training_rows(none(spark), labels.limit(0))).probability(np.zeros((1, 66))).shape == (1,)
    everything = quality.accepted(edge(spark), model, threshold=0.0)
    assert everything.schema == edge(spark).schema and everything.count() == len(ROWS)
    assert quality.accepted(edge(spark), model, threshold=1.1).count() == 0
