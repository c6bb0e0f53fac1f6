"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network in numpy.

Every word counts twice: as itself and as its shape, with a mark where it repeats the word before.  Both are hashed
into a fixed number of buckets.  A bucket's vector is the sum of sparse random index vectors of the words around it in
the training texts; a document is the mean of its words' vectors.  The network's probability is calibrated by one
temperature fitted on training documents that the network was not trained on.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_rows, bytes_column, first_by_hash, pick, row_strings, with_row

MAX_TRAIN_DOCS = 6000  # bound of the labelled sample that is fitted on the driver
BUCKETS = 1 << 15
DIMS = 32
ONES = 4  # non-zero entries of an index vector
REACH = 2  # words to either side that make up a context
HIDDEN = 24
EPOCHS = 300
THRESHOLD = 0.3
SEED = 7
CACHE_WORDS = 200_000

_RUN = re.compile(rb"(.)\1+")
_SHAPE = bytes(
    ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)


class Reader:
    """Bucket numbers of a text's words and shapes; remembers a bounded number of words."""

    def __init__(self):
        self.seen: dict[bytes, tuple[int, int]] = {}

    def _of(self, word: bytes) -> tuple[int, int]:
        if len(self.seen) >= CACHE_WORDS:
            self.seen.clear()
        shape = _RUN.sub(rb"\1", word.translate(_SHAPE))[:8]
        pair = zlib.crc32(word) % BUCKETS, zlib.crc32(b"shape " + shape) % (BUCKETS // 2) * 2
        self.seen[word] = pair
        return pair

    def read(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        get, of = self.seen.get, self._of
        pairs = np.array([get(w) or of(w) for w in text.split()], dtype=np.int32).reshape(-1, 2)
        words, shapes = pairs[:, 0], pairs[:, 1].copy()
        shapes[1:] += words[1:] == words[:-1]
        return words, shapes


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors, the same in every run."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIMS), np.float32)
    for k in range(ONES):
        out[np.arange(BUCKETS), rng.integers(0, DIMS, BUCKETS)] += 1 - 2 * (k % 2)
    return out


def context_vectors(texts: list[bytes]) -> np.ndarray:
    """For words (first) and shapes (second): unit sums of the index vectors around them, in (2, BUCKETS, DIMS)."""
    index, reader = index_vectors(), Reader()
    out = np.zeros((2, BUCKETS, DIMS), np.float32)
    for text in texts:
        words, shapes = reader.read(text)
        around = np.zeros((len(words), DIMS), np.float32)
        near = index[words] + index[shapes]
        for d in range(1, REACH + 1):
            around[d:] += near[:-d]
            around[:-d] += near[d:]
        around += index[shapes]
        np.add.at(out[0], words, around)
        np.add.at(out[1], shapes, around + index[shapes])
    length = np.linalg.norm(out, axis=2, keepdims=True)
    return out / np.maximum(length, 1e-6)


def pooled(text: bytes, vectors: np.ndarray, reader: Reader) -> np.ndarray:
    """Mean word vector and mean shape vector, then the log length and the share of repeated words."""
    words, shapes = reader.read(text)
    if not len(words):
        return np.zeros(2 * DIMS + 2, np.float32)
    parts = [np.zeros(DIMS, np.float64), np.zeros(DIMS, np.float64)]
    for at in range(0, len(words), 65536):  # long texts in pieces
        for k, ids in enumerate((words, shapes)):
            parts[k] += vectors[k][ids[at : at + 65536]].sum(axis=0)
    n = len(words)
    return np.concatenate([parts[0] / n, parts[1] / n, [np.log1p(n) / 10, float((shapes & 1).mean())]]).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        # Rounded, so that a text scores the same whatever stands beside it in a batch.
        return np.round(1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30))), 9)


def _train(x: np.ndarray, y: np.ndarray) -> tuple:
    """Full-batch Adam on the log loss with a small weight decay."""
    rng = np.random.default_rng(SEED)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(x @ params[0] + params[1])
        gap = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - y) / len(y)
        back = np.outer(gap, params[2]) * (1 - hidden**2)
        grads = [x.T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ gap + 1e-4 * params[2], gap.sum(keepdims=True)]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return params[0], params[1], params[2], float(params[3][0])


def fit(rows: list[tuple[bytes, int]]) -> Model:
    """Model from (text, label) rows; every fifth row calibrates the temperature and trains nothing."""
    if not rows:
        rows = [(b"", 1)]
    vectors, reader = context_vectors([t for t, _ in rows]), Reader()
    x = np.array([pooled(t, vectors, reader) for t, _ in rows], dtype=np.float64)
    y = np.array([label for _, label in rows], dtype=np.float64)
    held = np.arange(len(y)) % 5 == 4
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    model = Model(vectors, mean, scale, *_train((x[~held] - mean) / scale, y[~held]), 1.0)
    if held.any():
        z, t = model.logits(x[held]), y[held]

        def loss(temperature):
            p = np.clip(1 / (1 + np.exp(-np.clip(z / temperature, -30, 30))), 1e-9, 1 - 1e-9)
            return -(t * np.log(p) + (1 - t) * np.log(1 - p)).mean()

        model.temperature = min(np.geomspace(0.5, 5, 41).tolist(), key=loss)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality") -> list[tuple[bytes, int]]:
    """At most ``max_docs`` labelled rows whose crc32(id) mod 5 is not 0, a hash of the id deciding which.

    This is the bound of the sample that is read by the driver; where fewer rows are labelled, all are taken.
    A label that is null or a document without row in ``docs`` teaches nothing.
    """
    marks = pick(labels, doc_id=id_col, label=label_col).where("label is not null and doc_id is not null")
    marks = marks.where(~held_out(F.col("doc_id"))).dropDuplicates(["doc_id"])
    marks = first_by_hash(marks, max_docs, "doc_id")
    texts = pick(docs, doc_id=id_col, text=text_col)
    rows = texts.join(F.broadcast(marks), "doc_id")  # at most max_docs rows of two numbers
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_docs)
    return [((r["text"] or "").encode(), int(r["label"])) for r in rows.select("text", "label").collect()]


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    ``score`` is the probability of label 1; null and empty texts are scored as texts without words.  Repeated rows
    come back once each; a null id is not held out; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        reader = Reader()
        for batch in batches:
            p = pa.array(_probabilities(bytes_column(batch, "text"), sent.value, reader), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), p], names=["doc_id", "score"])

    found = pick(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def _probabilities(texts: list[bytes], model: Model, reader: Reader) -> np.ndarray:
    if not texts:
        return np.empty(0)
    return model.probability(np.array([pooled(t, model.vectors, reader) for t in texts], dtype=np.float64))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``; rows keep their place, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        reader = Reader()
        for batch in batches:
            p = pa.array(_probabilities(row_strings(batch, text_col), sent.value, reader), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), p], names=["row", "score"])

    return as_rows(docs).mapInArrow(run, with_row(docs, "score", T.DoubleType())).where(F.col("score") >= threshold).select("row.*")
