"""Quality by the votes of the nearest labelled documents in a latent-semantic space.

A document is counted in hashed features: its words, the shapes of its words, repeated words
and repeated runs of three. Logarithms of the counts, weighted by the inverse document
frequencies of the whole corpus, are projected to the leading singular directions of a
bounded sample of labelled documents. The sample's vectors are broadcast, and every document
gets the exact cosines to all of them, a block of documents at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import in_portions
from matchlake.llm.labelled import sample

#: Labelled documents of each class in the sample, at most, and the latent dimensions.
PER_CLASS = 1_500
DIMENSIONS = 64
NEIGHBOURS = 25

WORD_FEATURES, SHAPE_FEATURES = 2048, 1024
FEATURES = WORD_FEATURES + SHAPE_FEATURES + 2
_AGAIN, _SAME_RUN = FEATURES - 2, FEATURES - 1
#: Documents whose cosines are computed at a time, and words that a task remembers.
BLOCK = 256
REMEMBERED = 200_000



class Counter:
    """Feature counts of texts; remembers the features of words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def _features(self, word: str) -> int:
        """The word's and its shape's feature in one number. Shapes keep what is no letter or digit."""
        letters = [c for c in word if c.isalpha()]
        upper = sum(c.isupper() for c in letters)
        kind = "A" if upper == len(letters) > 1 else "Aa" if upper else "a"
        shape = re.sub(r"[^\W\d_]+", kind, re.sub(r"\d+", "9", word))[:12]
        core = word.strip(".,;:!?()\"'%$&*#").lower()
        at = xxhash.xxh32_intdigest(core) % WORD_FEATURES
        self.known[word] = value = at * SHAPE_FEATURES + xxhash.xxh32_intdigest(shape) % SHAPE_FEATURES
        return value

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known.get
        both = np.array([v if (v := known(w)) is not None else self._features(w) for w in words], np.int64)
        counts = np.zeros(FEATURES)
        counts[:WORD_FEATURES] = np.bincount(both // SHAPE_FEATURES, minlength=WORD_FEATURES)
        counts[WORD_FEATURES:_AGAIN] = np.bincount(both % SHAPE_FEATURES, minlength=SHAPE_FEATURES)
        counts[_AGAIN] = (both[1:] == both[:-1]).sum()
        if len(both) > 2:
            runs = (both[:-2] * 1_000_003 + both[1:-1]) * 1_000_003 + both[2:]
            counts[_SAME_RUN] = len(runs) - len(np.unique(runs))
        return counts


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log((1 + documents) / (1 + documents with the feature)) of each feature, over all texts.

    A task hands on one row for each feature.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, found, rows = Counter(), np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found[:FEATURES] += counter(text.as_py()) > 0
                rows += 1
        found[FEATURES] = rows
        columns = [pa.array(range(FEATURES + 1), pa.int32()), pa.array(found)]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "documents"])

    per_task = docs.select("text").mapInArrow(count, "feature int, documents long")
    rows = per_task.groupBy("feature").agg(F.sum("documents").alias("documents")).collect()  # one for each feature
    found = np.zeros(FEATURES + 1)
    for row in rows:
        found[row["feature"]] = row["documents"]
    return np.log((1 + found[FEATURES]) / (1 + found[:FEATURES]))


@dataclass
class Model:
    frequencies: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space; 0 for documents without features."""
        return _unit(_unit(np.log1p(counts) * self.frequencies) @ self.directions).astype(np.float32)

    def votes(self, vectors: np.ndarray, neighbours: int) -> np.ndarray:
        """Share of label 1 among the nearest, each with its cosine's square as weight and the class's.

        A vector of 0 has no nearest ones, and so the share among all labels.
        """
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        cosines = np.maximum(vectors @ self.vectors.T, 0)
        if neighbours < len(self.labels):
            near = np.argpartition(-cosines, neighbours, axis=1)[:, :neighbours]
        else:
            near = np.broadcast_to(np.arange(len(self.labels)), cosines.shape)
        weight = np.take_along_axis(cosines, near, axis=1).astype(float) ** 2 + 1e-9
        weight *= self.weights[self.labels[near]]
        found = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.where(vectors.any(axis=1), found, np.average(self.labels, weights=self.weights[self.labels]))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, dimensions: int = DIMENSIONS) -> Model:
    """Latent vectors of at most ``per_class`` rows of each class of ``labels`` (doc_id, quality), none held out.

    The sample bounds what the driver and the broadcast hold; the document frequencies are
    those of all of ``docs``.
    """
    frequencies = inverse_frequencies(docs)
    texts, sizes = sample(docs, labels, "quality", per_class)
    y = np.array([label for _, label in texts], np.int64)
    drawn = np.bincount(y, minlength=2)
    share = np.array([sizes.get(k, 0) / max(1, drawn[k]) for k in (0, 1)])
    counter = Counter()
    counts = np.array([counter(text) for text, _ in texts], np.float32).reshape(len(texts), FEATURES)
    rows = _unit(np.log1p(counts) * frequencies)
    rank = min(dimensions, *rows.shape) if len(texts) else 1
    random = np.random.default_rng(0)
    basis = random.standard_normal((FEATURES, min(rank + 16, FEATURES)))
    for _ in range(4):  # subspace iteration
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0] if len(texts) else basis
    _, _, turned = np.linalg.svd(rows @ basis, full_matrices=False) if len(texts) else (0, 0, np.eye(basis.shape[1]))
    directions = basis @ turned.T[:, :rank]
    model = Model(frequencies, directions, np.empty((0, rank), np.float32), y, share / max(share.max(), 1e-12))
    model.vectors = model.latent(counts)
    return model


def score(docs: DataFrame, model: Model, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with quality, the weighted share of good documents among the nearest labelled ones.

    Needs text; a column called quality is replaced, all others stay. NULL and empty texts have no
    nearest ones, and so the labels' share; without labels the quality is 0.5.
    """
    docs = docs.drop("quality")
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in in_portions(batches, BLOCK):
            text = batch.column(batch.schema.get_field_index("text"))
            counts = np.array([counter(t.as_py()) for t in text])
            new = pa.array(held.value.votes(held.value.latent(counts), neighbours), pa.float64())
            fields = [*batch.schema, pa.field("quality", pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, new], schema=pa.schema(fields))

    return docs.mapInArrow(vote, T.StructType([*docs.schema.fields, T.StructField("quality", T.DoubleType())]))
