"""Quality classifier: votes of the nearest labelled neighbours in a latent-semantic space.

A text's terms are hashed byte trigrams, trigrams of character classes, and how
often a word repeats the one before it.  Their weighted counts are projected to
a few latent dimensions (truncated SVD of the labelled sample).  The labelled
vectors are broadcast; every document's cosine to each of them is computed in
exact blocked products, and its nearest neighbours vote, weighted by similarity
and by how many labelled rows of their class each stands for.

Bounds: the model is fitted on a sample of labelled rows chosen by a hash of
``doc_id``, about ``per_class`` of each class at most; the broadcast is
``2 * per_class`` latent vectors and the projection, whatever the input.

Defined results: a null, empty or white text has no terms and gets the share of
label 1 among the labelled rows; without labelled rows the score is 0.5.  Rows
with a null label or id teach nothing.  Repeated rows score alike.  Extra
columns are ignored by the scores and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import doc_text, fold, labelled_sample, read_table, slices

FOLDS, HELD_OUT = 5, 0
PER_CLASS = 1500
DIMENSIONS, NEIGHBOURS = 64, 15
#: Length of the repeated-word term against one for each other kind of term.
REPEAT_WEIGHT = 2.0
THRESHOLD = 0.3
SHAPES, GRAMS = 16 ** 3, 2048
#: Bytes of a text whose terms are counted at a time.
STEP = 1 << 20


def _classes() -> np.ndarray:
    table = np.full(256, 10, np.int64)  # other ASCII
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r",
                               b".,;:?", b"!", b"|", b"#%$&*", b"'\"()-")):
        table[list(chars)] = k
    table[0x80:0xC0], table[0xC0:] = 11, 12
    return table


_CLASS = _classes()
_REPEATS = SHAPES + GRAMS
TERMS = SHAPES + GRAMS + 1


def terms(text: str) -> np.ndarray:
    """Weighted counts: log of the count of each term; each kind of term has length one."""
    out = np.zeros(TERMS, np.float32)
    data = text.encode("utf-8", "surrogatepass")
    shapes, grams = np.zeros(SHAPES, np.int64), np.zeros(GRAMS, np.int64)
    n_words = repeats = 0
    for at in range(0, len(data), STEP):
        raw = np.frombuffer(data, np.uint8, min(STEP + 2, len(data) - at), at)
        c = _CLASS[raw]
        shapes += np.bincount(c[:-2] << 8 | c[1:-1] << 4 | c[2:], minlength=SHAPES)
        b = raw.astype(np.uint32)
        grams += np.bincount(((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(21), minlength=GRAMS)
        words = data[at:at + STEP].split()
        n_words += len(words)
        repeats += sum(map(eq, words, words[1:]))
    for part, counts in ((out[:SHAPES], shapes), (out[SHAPES:_REPEATS], grams)):
        if counts.any():
            weight = np.log1p(counts)
            part[:] = weight / np.sqrt((weight * weight).sum())
    out[_REPEATS] = REPEAT_WEIGHT * (repeats / n_words) ** 0.5 if n_words else 0.0
    return out


@dataclass
class Model:
    projection: np.ndarray | None  # TERMS x dimensions
    vectors: np.ndarray | None  # labelled rows x dimensions, of length one
    votes: np.ndarray | None  # label 1 votes of each labelled row
    weights: np.ndarray | None  # labelled rows that each stands for
    prior: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        made = rows @ self.projection
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if self.vectors is None:
            return out
        rows = np.stack([terms(t) for t in texts])
        known = rows.any(axis=1)
        cosine = self.project(rows[known]) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6) ** 4 * self.weights[near]
        out[known] = np.clip((weight * self.votes[near]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)
        return out


def _latent(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors by a randomised range finder (fixed seed)."""
    size = min(dimensions, *rows.shape)
    basis = rows.T @ np.random.default_rng(7).standard_normal((rows.shape[0], min(size + 16, rows.shape[0]))).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ right.T)[:, :size].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS,
        dimensions: int = DIMENSIONS, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Fits on labelled rows outside the held-out fold; ``labels`` has doc_id and ``label`` (0 or 1)."""
    chosen, totals = labelled_sample(docs, labels, label, per_class, folds, held_out)
    if not totals:
        return Model(None, None, None, None, 0.5)
    prior = totals.get(1, 0) / sum(totals.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            made = [terms(t).astype(np.float16).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(made, pa.binary())], ["doc_id", "label", "terms"])

    schema = T.StructType([chosen.schema["doc_id"], *T.StructType.fromDDL("label int, terms binary").fields])
    found = sorted(chosen.mapInArrow(run, schema).collect(), key=lambda r: (r["doc_id"], r["label"], bytes(r["terms"])))
    if not found:
        return Model(None, None, None, None, prior)
    rows = np.stack([np.frombuffer(r["terms"], np.float16) for r in found]).astype(np.float32)
    y = np.array([r["label"] for r in found])
    used = rows.any(axis=1)
    if not used.any():
        return Model(None, None, None, None, prior)
    rows, y = rows[used], y[used]
    seen = (rows > 0).sum(axis=0)
    idf = (np.log((1 + len(rows)) / (1 + seen)) + 0.1).astype(np.float32)
    projection = idf[:, None] * _latent(rows * idf, dimensions)
    weights = np.array([totals[v] / max(1, (y == v).sum()) for v in (0, 1) if v in totals] if len(totals) == 2 else [1.0, 1.0])
    model = Model(projection, None, y.astype(np.float32), weights[y].astype(np.float32), prior)
    model.vectors = model.project(rows)
    return model


def quality_scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    texts = doc_text(docs).withColumn("held_out", fold(F.col("doc_id"), folds) == held_out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("held_out boolean, score double, predicted int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = shared.value.scores(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return texts.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = shared.value.scores([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_scores(docs, fit(docs, read_table(spark, sf_dir, "labels")))
