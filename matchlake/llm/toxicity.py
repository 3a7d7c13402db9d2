"""Toxicity by multiple-instance learning.

A document is a bag of sentences, and only the bag is labelled. A sentence is toxic with the
logistic probability of the weights of its learned words, or not at all without any; a
document is toxic unless all of its sentences are harmless, which is the noisy-or of the
sentences. Sentences with the same learned words are the same evidence and count once. What
no learned word explains is left to a leak, one for each document, so that no length alone
makes a document toxic. Weights and leak are those that make the documents' labels most
likely, so that sentences get scores without labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import in_portions
from matchlake.llm.labelled import sample

#: Labelled documents of each class that a model is fitted on, at most.
PER_CLASS = 2_500
#: Letters (bytes) of the prefix that stands for words which the fit has not seen.
PREFIX = 5
#: Least likelihood ratio, against chance, of a word or prefix that gets a weight.
RATIO = 20.0

_END = b"\x01"
_PREFIXED = b"\x02"
_ENDS = b".?\n"
#: ASCII letters are lower-cased; the ends of sentences become marks, other ASCII signs spaces.
_LETTERS = bytes(
    1 if b in _ENDS else b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)
)
_SENTENCE = re.compile(r"[^.?\n]+")


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words, with a mark after each sentence."""
    return (text or "").encode().translate(_LETTERS).replace(_END, b" \x01 ").split()


_NONE: frozenset[bytes] = frozenset()


@dataclass
class Model:
    """Logit of a sentence with learned words, their weights, and the logit of a document's leak."""

    bias: float
    weights: dict[bytes, float]
    leak: float = -np.inf

    @cached_property
    def _prefixes(self) -> frozenset[bytes]:
        """The learned prefixes, without their mark."""
        return frozenset(f[1:] for f in self.weights if f.startswith(_PREFIXED))

    def sentences(self, text: str | None) -> list[frozenset[bytes]]:
        """The learned features of each sentence that has words, in order."""
        weights, prefixes, found = self.weights, self._prefixes, []
        for sentence in (text or "").encode().translate(_LETTERS).split(_END):
            if words := sentence.split():
                learned = [w for w in words if w in weights or w[:PREFIX] in prefixes]
                found.append(frozenset(_features(learned) & weights.keys()) if learned else _NONE)
        return found

    def logit(self, learned: frozenset[bytes]) -> float:
        """Of a sentence; without learned words it can't be toxic."""
        return self.bias + fsum(self.weights[f] for f in learned) if learned else -np.inf

    def toxicity(self, sentences: list[frozenset[bytes]]) -> float:
        """The noisy-or of the leak and of each different set of learned features; 0 without sentences."""
        if not sentences:
            return 0.0
        return noisy_or(np.array([self.leak, *sorted(map(self.logit, set(sentences) - {_NONE}))]))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def noisy_or(logits: np.ndarray) -> float:
    """1 - product of (1 - p); 0 without sentences."""
    return float(-np.expm1(-_softplus(logits).sum()))


def _features(words: list[bytes]) -> set[bytes]:
    """Words, and their prefixes after a mark."""
    return {x for w in words if w != _END for x in (w, _PREFIXED + w[:PREFIX])}


def _telling(bags: list[list[bytes]], y: np.ndarray) -> list[bytes]:
    """Features whose documents are toxic more or less often than chance would have it (G-test)."""
    seen, toxic = Counter(), Counter()
    for words, label in zip(bags, y, strict=True):
        found = _features(words)
        seen.update(found)
        toxic.update(found if label else ())
    names = sorted(seen)
    n, k = (np.array([c[f] for f in names], float) for c in (seen, toxic))
    total, positive = len(y), y.sum()
    ratio = np.zeros(len(names))
    for found, expected in (
        (k, n * positive / total),
        (n - k, n * (1 - positive / total)),
        (positive - k, (total - n) * positive / total),
        (total - positive - n + k, (total - n) * (1 - positive / total)),
    ):
        ratio += 2 * found * np.log(np.maximum(found, 1e-300) / np.maximum(expected, 1e-300))
    return [f for f, g in zip(names, ratio, strict=True) if g >= RATIO]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, rounds: int = 400) -> Model:
    """Model of ``labels`` (doc_id, toxic) from at most ``per_class`` rows of each class, none held out.

    The fit is bounded by ``per_class`` and runs on the driver; classes weigh as all labels
    have them. Without labels of both classes every document with words gets the same score.
    """
    texts, sizes = sample(docs, labels, "toxic", per_class)
    y = np.array([label for _, label in texts], np.int64)
    if len(set(y.tolist())) < 2:
        return Model(-12.0, {}, 0.0 if y.any() else -12.0)
    bags = [tokens(text) for text, _ in texts]
    names = _telling(bags, y)
    number = {f: i for i, f in enumerate(names)}
    occurrence, sentence, document = [], [], []
    for bag, words in enumerate(bags):
        ends = [-1, *(i for i, w in enumerate(words) if w == _END), len(words)]
        features = (_features(words[begin + 1 : end]) for begin, end in zip(ends, ends[1:], strict=False))
        for found in sorted({tuple(sorted(number[f] for f in x if f in number)) for x in features} - {()}):
            occurrence += found
            sentence += [len(document)] * len(found)
            document.append(bag)
    speaks = np.array([any(w != _END for w in words) for words in bags], float)
    occurrence, sentence, document = (np.array(x, np.int64) for x in (occurrence, sentence, document))
    share = np.array([sizes[k] / (y == k).sum() for k in (0, 1)])[y]
    share /= share.mean()
    weights, bias, leak = np.zeros(len(names)), -8.0, -8.0
    squares, bias_squares, leak_squares = np.full(len(names), 1e-8), 1e-8, 1e-8
    for _ in range(rounds):  # gradient steps, scaled by the gradients so far
        z = bias + np.bincount(sentence, weights[occurrence], len(document))
        harmless = np.bincount(document, _softplus(z), len(texts)) + speaks * _softplus(np.array(leak))
        toxic = -np.expm1(-harmless)  # ``harmless`` is -log of the chance that all sentences are
        pull = np.where(y == 1, -np.exp(-harmless) / np.maximum(toxic, 1e-12), 1.0) * share
        slope = pull[document] * np.exp(-_softplus(-z))
        for_bias, for_leak = slope.sum(), (pull * speaks).sum() * np.exp(-_softplus(np.array(-leak)))
        by_word = np.bincount(occurrence, slope[sentence], len(names)) + 0.02 * weights
        squares += by_word**2
        bias_squares += for_bias**2
        leak_squares += for_leak**2
        weights -= 0.3 * by_word / np.sqrt(squares)
        bias -= 0.3 * for_bias / np.sqrt(bias_squares)
        leak -= 0.3 * for_leak / np.sqrt(leak_squares)
    return Model(float(bias), dict(zip(names, weights.tolist(), strict=True)), float(leak))


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` with toxicity, the leaky noisy-or of its sentences, and toxic_sentences.

    Needs text; columns of the new names are replaced. toxic_sentences are those with a score
    of ``least`` or more: where they begin and end in the text, in characters, and the score.
    NULL and empty texts have no sentences and the toxicity 0.
    """
    docs = docs.drop("toxicity", "toxic_sentences")
    spans = T.ArrayType(T.StructType().add("begin", "long").add("end", "long").add("score", "double"))
    added = [T.StructField("toxicity", T.DoubleType()), T.StructField("toxic_sentences", spans)]
    arrow_span = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was fitted on

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in in_portions(batches):
            scores, found = [], []
            for text in batch.column(batch.schema.get_field_index("text")):
                text = text.as_py() or ""
                sentences = own.sentences(text)
                scores.append(own.toxicity(sentences))
                found.append(_located(text, own, sentences, least) if sentences and scores[-1] >= least else [])
            new = [pa.array(scores, pa.float64()), pa.array(found, pa.list_(arrow_span))]
            fields = [pa.field("toxicity", pa.float64()), pa.field("toxic_sentences", pa.list_(arrow_span))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema=pa.schema([*batch.schema, *fields]))

    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, *added]))


def _located(text: str, model: Model, sentences: list[frozenset[bytes]], least: float) -> list[dict]:
    """The sentences with words, as ``sentences`` has them, that reach ``least``."""
    spans = [m.span() for m in _SENTENCE.finditer(text) if tokens(m[0])]
    scores = 1 / (1 + np.exp(-np.array([model.logit(learned) for learned in sentences])))
    return [{"begin": a, "end": b, "score": float(p)} for (a, b), p in zip(spans, scores, strict=True) if p >= least]


def without_toxic(docs: DataFrame, labels: DataFrame, most: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` without those of a toxicity of ``most`` or more; all columns stay."""
    model = fit(docs, labels, per_class)
    packed = docs.select("text", F.struct("*").alias("row"))
    return score(packed, model).where(F.col("toxicity") < most).select("row.*")
