"""Spark's random forest of classes, grown by passes over blocks of rows.

The forest is the one that ``RandomForestClassifier`` fits on the same rows in the same partitions: thresholds,
each tree's samples, each node's features, gains and ties are Spark's, which the tests check node by node. What
differs is a pass: Spark looks up every row in every tree by itself, here a task walks a block of rows at once,
and a row's samples are one byte for each tree, stored once.
"""

from __future__ import annotations

import math
import pickle
import sys
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from struct import pack, unpack

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks get this module's functions themselves, so that a job needn't send the package to its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that a task works on at once; the forest doesn't depend on it.
BLOCK = 16_384
#: Spark looks for thresholds in so many rows at least.
LEAST_SAMPLE = 10_000
#: What stands before the length and the numbers of an array in Java's serialisation.
INTEGERS = b"ur\x00\x02[IM\xba`&v\xea\xb2\xa5\x02\x00\x00xp"
#: A node of less impurity is not split.
EPSILON = 2.0**-52


#: What ``_growth`` gives; plain arrays, which workers read without the package.
Growth = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]


@dataclass
class Node:
    """A node of a growing tree; ``number`` is 1 for the root, children of n are 2n and 2n + 1."""

    number: int
    counts: np.ndarray
    impurity: float
    gain: float = 0.0
    feature: int = 0
    split: int = 0
    children: tuple[int, int] | None = None


def fit_trees(rows: DataFrame, features: Sequence[str], forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """The model that ``forest`` would fit on ``rows``, which hold ``features`` and the label, without missing values.

    Only the number of trees, the depth and the seed may differ from Spark's defaults. Rows are read as they are
    partitioned, several times, so they should be persisted.
    """
    spark, label = rows.sparkSession, forest.getLabelCol()
    forest._transfer_params_to_java()
    rows = rows.select(*(F.col(c).cast("double").alias(c) for c in (*features, label)))
    classes = forest._java_obj.getNumClasses(rows._jdf, 100)
    metadata = _metadata(spark, forest, len(features), rows.count(), classes)
    thresholds = _thresholds(rows, features, metadata, forest.getSeed())

    samples = _samples(rows, forest.getNumTrees(), forest.getSeed())
    blocks = _blocks(rows, features, label, thresholds, classes).zip(samples)
    blocks.persist(StorageLevel.DISK_ONLY)
    try:
        grown = _grow(blocks, [len(t) for t in thresholds], classes, forest)
    finally:
        blocks.unpersist()
    return _model(spark.sparkContext, forest, grown, thresholds, classes)


def _metadata(spark, forest: RandomForestClassifier, features: int, rows: int, classes: int):
    """Spark's description of the fit, all features being continuous."""
    jvm = spark._jvm
    impl, tree = jvm.org.apache.spark.ml.tree.impl, jvm.org.apache.spark.mllib.tree.configuration
    bins = min(forest.getMaxBins(), rows)
    each = spark.sparkContext._gateway.new_array(jvm.int, features)
    for i in range(features):
        each[i] = bins
    chosen = features if forest.getNumTrees() == 1 else int(np.ceil(np.sqrt(features)))
    no_categories, no_sets = jvm.PythonUtils.toScalaMap({}), jvm.PythonUtils.toScalaMap({}).keySet()
    return impl.DecisionTreeMetadata(
        features, rows, float(rows), classes, bins, no_categories, no_sets, each, forest._java_obj.getOldImpurity(),
        tree.QuantileStrategy.Sort(), forest.getMaxDepth(), 1, 0.0, 0.0, forest.getNumTrees(), chosen,
    )


def _thresholds(rows: DataFrame, features: Sequence[str], metadata, seed: int) -> list[list[float]]:
    """The thresholds of each feature by Spark's rule, from the rows that Spark draws for it (about ``LEAST_SAMPLE``)."""
    spark = rows.sparkSession
    sampled, n, least = rows, metadata.numExamples(), max(metadata.maxBins() ** 2, LEAST_SAMPLE)
    if least < n:
        drawn = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        jrows = rows._jdf.javaRDD().sample(False, least / n, drawn)
        sampled = DataFrame(spark._jsparkSession.createDataFrame(jrows, rows._jdf.schema()), spark)
    spark_forest = _scala_object(spark._jvm.org.apache.spark.ml.tree.impl, "RandomForest")
    values, found = sampled.toPandas(), []
    for i, feature in enumerate(features):
        # Spark counts the values that aren't zero and takes the rest for zeros.
        kept, counts = np.unique(values[feature].to_numpy()[values[feature].to_numpy() != 0], return_counts=True)
        if not len(kept):
            found.append([])
            continue
        weights = spark._jvm.PythonUtils.toScalaMap(_java(spark._jvm, dict(zip(kept.tolist(), counts.astype(float).tolist(), strict=True))))
        splits = spark_forest.findSplitsForContinuousFeature(weights, int(counts.sum()), metadata, i)
        found.append(list(splits))
    return found


def _blocks(
    rows: DataFrame, features: Sequence[str], label: str, thresholds: list[list[float]], classes: int
) -> RDD[tuple[int, bytes]]:
    """Blocks of rows: their number, and for each feature the rows' codes (bin times classes, plus class)."""
    cuts = [np.array(t) for t in thresholds]
    kind = _code_type([len(t) for t in thresholds], classes)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_blocks(np.stack([c.to_numpy() for c in b.columns]) for b in batches):
            if not np.isfinite(part).all():
                raise ValueError("features and labels must be finite")
            labels = part[-1].astype(np.int64)
            if (labels != part[-1]).any() or (labels < 0).any():
                raise ValueError(f"{label} is no class: labels are whole numbers from 0")
            codes = np.stack(
                [np.searchsorted(cut, column) * classes + labels for cut, column in zip(cuts, part, strict=False)]
            )
            yield pa.record_batch([pa.array([part.shape[1]]), pa.array([codes.astype(kind).tobytes()])], ["n", "codes"])

    found = rows.select(*features, label).mapInArrow(encoded, "n bigint, codes binary")
    return found.rdd.map(lambda row: (row.n, bytes(row.codes)))


def _code_type(splits: Sequence[int], classes: int) -> np.dtype:
    return np.min_scalar_type((max(splits) + 1) * classes)


def _in_blocks(batches: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The columns of arrays, as arrays of ``BLOCK`` columns each but for the last one."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.shape[1]
        if n >= BLOCK:
            joined = np.concatenate(waiting, axis=1)
            for start in range(0, n - n % BLOCK, BLOCK):
                yield joined[:, start : start + BLOCK]
            waiting, n = [joined[:, n - n % BLOCK :]], n % BLOCK
    if n:
        yield np.concatenate(waiting, axis=1)


def _samples(rows: DataFrame, trees: int, seed: int) -> RDD[bytes]:
    """How often each tree's sample holds a row, for the same blocks.

    Spark draws them (``BaggedPoint``) and gives each row's as a serialised object, which holds one array of numbers.
    """
    spark = rows.sparkSession
    jvm = spark._jvm
    ones = getattr(rows.select(F.lit(1.0))._jdf, "as")(jvm.org.apache.spark.sql.Encoders.DOUBLE()).rdd()
    itself = getattr(_scala_object(jvm.scala, "Predef"), "$conforms")()
    bagged = _scala_object(jvm.org.apache.spark.ml.tree.impl, "BaggedPoint").convertToBaggedRDD(
        ones, 1.0, trees, True, itself, seed
    )
    serialised = jvm.org.apache.spark.sql.Encoders.javaSerialization(jvm.java.lang.Class.forName("java.lang.Object"))
    drawn = DataFrame(spark._jsparkSession.createDataset(bagged, serialised).toDF(), spark)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = INTEGERS + pack(">i", trees)

        def drawn(batch: pa.RecordBatch) -> np.ndarray:  # objects of the same class are of the same length
            values = batch.column(0).cast(pa.binary())
            places = np.frombuffer(values.buffers()[1], np.int32)[values.offset :][: len(values) + 1]
            objects = np.frombuffer(values.buffers()[2], np.uint8)[places[0] : places[-1]].reshape(len(values), -1)
            start = values[0].as_py().index(mark) + len(mark)
            # Of each four bytes the last one: no sample holds a row 256 times.
            return objects[:, start + 3 : start + 4 * trees : 4].T

        for part in _in_blocks(map(drawn, batches)):
            yield pa.record_batch([pa.array([part.tobytes()])], ["samples"])

    return drawn.mapInArrow(numbers, "samples binary").rdd.map(lambda row: bytes(row.samples))


def _java(jvm, value):
    """A Python value as a Java one, in one call."""
    return jvm.org.apache.spark.mllib.api.python.SerDe.loads(bytearray(pickle.dumps(value, 2)))


def _scala_object(package, name: str):
    return getattr(getattr(package, f"{name}$"), "MODULE$")


class JavaRandom:
    """``java.util.Random``."""

    def __init__(self, seed: int):
        self._state = (seed ^ 0x5DEECE66D) % 2**48

    def next_int(self) -> int:
        self._state = (self._state * 0x5DEECE66D + 0xB) % 2**48
        return (self._state >> 16) - (self._state >> 47 << 32)

    def next_long(self) -> int:
        return (self.next_int() << 32) + self.next_int()


class ShiftRandom:
    """Spark's ``XORShiftRandom``."""

    def __init__(self, seed: int):
        data = pack(">Q", seed % 2**64)
        low = murmur(data, 0x3C074A61)
        self._state = murmur(data, low) << 32 | low

    def _next(self, bits: int) -> int:
        x = self._state
        x ^= x << 21 & 2**64 - 1
        x ^= x >> 35
        self._state = x ^ x << 4 & 2**64 - 1
        return self._state & (1 << bits) - 1

    def next_double(self) -> float:
        return ((self._next(26) << 27) + self._next(27)) * 2.0**-53


def murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 (32 bits) of whole words."""
    h, full = seed, 2**32 - 1
    for (k,) in (unpack("<I", data[i : i + 4]) for i in range(0, len(data), 4)):
        k = k * 0xCC9E2D51 & full
        k = (k << 15 | k >> 17) * 0x1B873593 & full
        h ^= k
        h = (h << 13 | h >> 19) * 5 + 0xE6546B64 & full
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & full
    h = (h ^ h >> 13) * 0xC2B2AE35 & full
    return h ^ h >> 16


def some_features(n: int, wanted: int, seed: int) -> list[int]:
    """``wanted`` of ``n`` features by Spark's reservoir sampling."""
    chosen, rng = list(range(wanted)), ShiftRandom(seed)
    for i in range(wanted, n):
        place = int(rng.next_double() * (i + 1))
        if place < wanted:
            chosen[place] = i
    return chosen


def _grow(
    blocks: RDD, splits: list[int], classes: int, forest: RandomForestClassifier
) -> list[list[Node]]:
    """The nodes of every tree; a pass counts the rows of all nodes that Spark would split at once."""
    trees, depth, rng = forest.getNumTrees(), forest.getMaxDepth(), JavaRandom(forest.getSeed())
    wanted = len(splits) if trees == 1 else math.ceil(math.sqrt(len(splits)))
    memory = forest.getMaxMemoryInMB() * 1024 * 1024
    numbers: list[dict[int, int]] = [{1: 0} for _ in range(trees)]
    grown: list[list[Node]] = [[Node(1, np.zeros(classes), 0.0)] for _ in range(trees)]
    stack = [(tree, 1) for tree in range(trees)]
    while stack:
        chosen: dict[int, list[tuple[int, list[int]]]] = {}
        used = 0
        while stack:
            tree, number = stack[-1]
            features = list(range(wanted))
            if wanted < len(splits):
                features = some_features(len(splits), wanted, rng.next_long())
            needed = 8 * classes * sum(splits[f] + 1 for f in features)
            if used and used + needed > memory:
                break
            stack.pop()
            chosen.setdefault(tree, []).append((number, features))
            used += needed
        chosen = {tree: chosen[tree] for tree in _scala_order(blocks.context._jvm, list(chosen))}
        growths = {
            tree: _growth(grown[tree], [(numbers[tree][n], f) for n, f in nodes], classes, _code_type(splits, classes))
            for tree, nodes in chosen.items()
        }
        best = _best(blocks, growths, splits, classes)
        for tree, nodes in chosen.items():
            for (number, _), (counts, impurity, gain, feature, split, left, right) in zip(nodes, best[tree], strict=True):
                node = grown[tree][numbers[tree][number]]
                node.counts, node.impurity, node.gain = counts, impurity, gain
                level = number.bit_length() - 1
                if gain <= 0 or level == depth:
                    continue
                node.feature, node.split, node.children = feature, split, (len(grown[tree]), len(grown[tree]) + 1)
                for child, part in ((2 * number, left), (2 * number + 1, right)):
                    numbers[tree][child] = len(grown[tree])
                    grown[tree].append(Node(child, part, float(gini(part))))
                    if level + 1 < depth and gini(part) >= EPSILON:
                        stack.append((tree, child))
    return grown


def _scala_order(jvm, keys: list[int]) -> list[int]:
    """The order in which Spark goes through a group's trees: that of Scala's maps."""
    found = jvm.scala.collection.mutable.HashMap()
    for key in keys:
        found.put(key, key)
    ordered = found.toMap(getattr(_scala_object(jvm.scala, "Predef"), "$conforms")()).keysIterator()
    return [ordered.next() for _ in keys]


def _growth(nodes: list[Node], counted: list[tuple[int, list[int]]], classes: int, kind: np.dtype) -> Growth:
    """What a pass needs of a tree: its splits so far, and the nodes whose rows are counted.

    Of each node its feature, the greatest code of it that goes left, both next nodes (itself without a split) and
    its place among the counted ones, or -1; of each counted one its features; and the levels above them.
    """
    place = np.full(len(nodes), -1)
    place[[i for i, _ in counted]] = range(len(counted))
    return (
        np.array([n.feature for n in nodes]),
        np.array([n.split * classes + classes - 1 for n in nodes], kind),
        np.array([n.children or (i, i) for i, n in enumerate(nodes)]).ravel(),
        place,
        np.array([f for _, f in counted]),
        max(nodes[i].number.bit_length() - 1 for i, _ in counted),
    )


def _best(blocks: RDD, growths: dict[int, Growth], splits: list[int], classes: int) -> dict[int, list[tuple]]:
    """Of each tree the best splits of its counted nodes, from one pass over all rows."""
    sc = blocks.context
    known = sc.broadcast(growths)
    width = (max(max(splits), 1) + 1) * classes
    kind = _code_type(splits, classes)

    def counted(parts: Iterator) -> Iterator[tuple[int, np.ndarray]]:
        counts = {tree: np.zeros(features.size * width) for tree, (*_, features, _) in known.value.items()}
        for (n, codes), samples in parts:
            codes = np.frombuffer(codes, kind)
            samples = np.frombuffer(samples, np.uint8).reshape(-1, n)
            for tree, growth in known.value.items():
                _count(growth, codes, n, samples[tree], width, counts[tree])
        for tree, found in counts.items():
            # Shuffled as the smaller numbers that they are; sums are taken in 64 bits.
            yield tree, found.astype(np.int64 if found.max(initial=0) >= 2**31 else np.int32)

    def split(found: tuple[int, np.ndarray]) -> tuple[int, list[tuple]]:
        tree, counts = found
        chosen = known.value[tree][-2]
        return tree, best_splits(counts.reshape(*chosen.shape, -1, classes), chosen, np.array(splits))

    sums = blocks.mapPartitions(counted).reduceByKey(_add, min(len(growths), blocks.getNumPartitions()))
    try:
        return dict(sums.map(split).collect())
    finally:
        known.destroy()


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.add(a, b, dtype=np.int64)


def _count(growth: Growth, codes: np.ndarray, n: int, samples: np.ndarray, width: int, counts: np.ndarray) -> None:
    """Adds a block's rows, each as often as the tree's sample holds it, to the counts by node, feature and code."""
    feature, cut, following, places, features, steps = growth
    rows = np.flatnonzero(samples)
    weights = samples.take(rows).astype(np.float64)
    node = np.zeros(len(rows), np.intp)
    first = feature * n
    for _ in range(steps):
        at = first.take(node)
        at += rows
        right = codes.take(at) > cut.take(node)
        node *= 2
        node += right
        node = following.take(node)
    place = places.take(node)
    if (place < 0).any():
        kept = np.flatnonzero(place >= 0)
        rows, weights, place = rows.take(kept), weights.take(kept), place.take(kept)
    start = np.arange(len(features)) * (features.shape[1] * width)
    for k, chosen in enumerate(features.T):
        at = (chosen * n).take(place)
        at += rows
        key = (start + k * width).take(place)
        key += codes.take(at)
        counts += np.bincount(key, weights, len(counts))


def gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of counts by class (last axis), by the steps in which Spark computes it."""
    total = counts.sum(axis=-1)
    impurity = np.ones(total.shape)
    with np.errstate(invalid="ignore", divide="ignore"):
        for c in range(counts.shape[-1]):
            share = counts[..., c] / total
            impurity = impurity - share * share
    return np.where(total == 0, 0.0, impurity)


def best_splits(counts: np.ndarray, features: np.ndarray, splits: np.ndarray) -> list[tuple]:
    """The best split of each node, by counts of (node, feature, bin, class).

    Given as counts by class, impurity, gain, feature, split, and counts of both sides. Of equal gains the first
    feature's first split holds, as in Spark; the gain is 0 or less, and the impurity -1, where none is valid.
    """
    counts = counts.astype(np.float64)
    total = counts[:, 0].sum(axis=1)
    left = counts.cumsum(axis=2)[:, :, :-1]
    right = counts.sum(axis=2)[:, :, None] - left
    n_left, n_right = left.sum(axis=-1), right.sum(axis=-1)
    impurity, n = gini(total), n_left + n_right
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = impurity[:, None, None] - n_left / n * gini(left) - n_right / n * gini(right)
    exists = np.arange(left.shape[2]) < splits[features][:, :, None]
    gain = np.where(exists & (n_left > 0) & (n_right > 0) & (gain >= 0), gain, -np.inf)
    best = gain.reshape(len(gain), -1).argmax(axis=1)
    found = []
    for i, (k, split) in enumerate(zip(*np.unravel_index(best, gain.shape[1:]), strict=True)):
        won = float(gain[i, k, split])
        valid = float(impurity[i]) if won >= 0 else -1.0
        found.append((total[i], valid, won, int(features[i, k]), int(split), left[i, k, split], right[i, k, split]))
    return found


def _model(
    sc: SparkContext, forest: RandomForestClassifier, grown: list[list[Node]], thresholds: list[list[float]], classes: int
) -> RandomForestClassificationModel:
    """Spark's model of the trees."""
    jvm, gateway = sc._jvm, sc._gateway
    ml = jvm.org.apache.spark.ml
    Gini, Leaf = jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator, ml.tree.LeafNode  # noqa: N806
    Inner, Cut = ml.tree.InternalNode, ml.tree.ContinuousSplit  # noqa: N806

    def built(nodes: list[Node], counts, i: int) -> tuple:
        """The node, and what it predicts if it is a leaf; leaves that predict the same are one, as in Spark."""
        node = nodes[i]
        predicted = float(node.counts.argmax())
        if node.children:
            (left, of_left), (right, of_right) = (built(nodes, counts, child) for child in node.children)
            if of_left is None or of_left != of_right:
                statistics = Gini(counts.get(i), int(node.counts.sum()))
                cut = Cut(node.feature, thresholds[node.feature][node.split])
                inner = Inner(predicted, node.impurity, node.gain, left(), right(), cut, statistics)
                return lambda: inner, None
        return lambda: Leaf(predicted, node.impurity, Gini(counts.get(i), int(node.counts.sum()))), predicted

    kind = ml.classification.DecisionTreeClassificationModel
    trees = gateway.new_array(kind, len(grown))
    for i, nodes in enumerate(grown):
        counts = _java(jvm, [array("d", n.counts) for n in nodes])
        trees[i] = kind(built(nodes, counts, 0)[0](), len(thresholds), classes)
    java = ml.classification.RandomForestClassificationModel(forest.uid, trees, len(thresholds), classes)
    return forest._copyValues(forest._create_model(forest._java_obj.copyValues(java, ml.param.ParamMap())))
