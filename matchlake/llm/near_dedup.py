"""Near duplicates by MinHash bands with sequential Bayesian verification.

1. Every document gets the hashes of its distinct word shingles and a MinHash signature of
   them. Documents with equal sets are one class, of which one member is looked at.
2. Classes meet in the buckets of their signatures' bands. Buckets with the same members are
   looked at once. What travels is a byte of each hash: members are compared a batch of
   hashes at a time, and a pair is dropped as soon as the posterior probability that it is
   similar falls below the chosen miss probability. A bucket gives a forest of likely pairs,
   not all of them; a very large one ties its members to one of them unseen.
3. The components of likely pairs are groups. Each text goes once to its group, or to a
   chunk of bounded weight of it. There pairs that aren't connected yet are sought with whole
   signatures, again by batches, and verified on their full sets. What leaves the task is a
   forest of verified links.
4. Members of a group of several chunks that aren't connected with its centre visit all of
   its other chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import forget, fresh, stored

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Shingles that a chunk of a group holds at most, about; a single document may have more.
CHUNK_SHINGLES = 100_000
#: Members of a bucket that are compared; those of larger ones are all taken as likely.
BUCKET_MEMBERS = 4096
#: Bands of a signature at least, and at most as long as they can have fewer rows.
LEAST_BANDS, MOST_BANDS = 24, 48


@dataclass(frozen=True)
class Similarity:
    """What counts as similar, and how pairs are sought.

    ``words`` to a shingle; similar means 100 * intersection >= ``percent`` * union. With
    ``bands`` of ``rows`` hashes a pair of similarity s shares no bucket with probability
    (1 - s**rows)**bands. Where they aren't given they are chosen so that this is at most
    ``unmet`` at ``percent``: 24 bands of 6 at 0.85 (1.2e-5), 37 of 6 at 0.8 (1.3e-5).
    """

    words: int = 5
    percent: int = 80
    bands: int | None = None
    rows: int | None = None
    unmet: float = 1.5e-5
    miss: float = 1e-6
    batch: int = 24
    seed: int = 1

    def __post_init__(self):
        """Rows: 6, or fewer where those would take over ``MOST_BANDS``; at least ``LEAST_BANDS`` bands."""

        def needed(rows: int) -> int:
            met = (self.percent / 100) ** rows
            return max(LEAST_BANDS, ceil(log(self.unmet) / log1p(-met)) if met < 1 else 1)

        fitting = (r for r in range(6, 1, -1) if needed(r) <= MOST_BANDS)
        rows = self.rows or (6 if self.bands else next(fitting, 1))
        object.__setattr__(self, "rows", rows)
        object.__setattr__(self, "bands", self.bands or needed(rows))

    @cached_property
    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(self.seed)
        odd = random.integers(0, 2**64, self.bands * self.rows, np.uint64) | np.uint64(1)
        return odd, random.integers(0, 2**64, self.bands * self.rows, np.uint64)

    @cached_property
    def least(self) -> list[tuple[int, int]]:
        """For each batch: the hashes so far, and the fewest equal ones that are not pruned.

        With a uniform prior the similarity of a pair with m of n equal hashes is distributed
        as Beta(m + 1, n - m + 1); it is at least t with the probability that of n + 1 trials
        of success t at most m succeed.
        """
        t, bounds = self.percent / 100, []
        for n in range(self.batch, self.bands * self.rows + 1, self.batch):
            below, m = 0.0, -1
            while below < self.miss:
                m += 1
                below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            bounds.append((n, m))
        return bounds


class Shingler:
    """Hashed word shingles."""

    def __init__(self, how: Similarity):
        self.how = how

    def __call__(self, text: str | None) -> np.ndarray:
        """The document's set as sorted hashes: of all runs of words, or of the whole where it has fewer."""
        words = (text or "").encode().translate(_LOWER).split()
        # Hashing a word takes less time than looking it up among many.
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        run = min(self.how.words, len(words))
        shingles = np.full(len(words) - run + 1 if run else 0, run, np.uint64)
        for k in range(run):
            shingles = (shingles ^ (shingles >> np.uint64(29))) * _MIX + hashes[k : k + len(shingles)]
        shingles = (shingles ^ (shingles >> np.uint64(32))) * _MIX
        shingles ^= shingles >> np.uint64(29)
        shingles.sort()
        return shingles[np.concatenate(([True], shingles[1:] != shingles[:-1]))] if len(shingles) else shingles

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        odd, plus = self.how.factors
        least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 512):
            hashed = shingles[at : at + 512, None] * odd
            hashed += plus
            np.minimum(least, hashed.min(axis=0), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)

    def bands(self, signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(self.how.bands, self.how.rows).astype(np.uint64)
        keys = np.arange(self.how.bands, dtype=np.uint64)
        for k in range(self.how.rows):
            keys = (keys ^ (keys >> np.uint64(31))) * _MIX + rows[:, k]
        return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def _signed(docs: DataFrame, how: Similarity) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key, part, bands and sketch of each row; no set_key without words.

    ``part`` tells the sets of rows with the same doc_id apart, ``text_key`` their texts. The
    sketch has a byte of each hash of the signature.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = "text_key bigint, n_shingles bigint, set_key binary, part bigint, bands array<bigint>, sketch binary"
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(added).fields])
    arrow = to_arrow_schema(schema)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(how)
        for batch in batches:
            sizes, keys, parts, bands, sketches = [], [], [], [], []
            for text in batch["text"]:
                shingles = shingler(text.as_py())
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                parts.append(_part(shingles) if len(shingles) else None)
                signature = shingler.signature(shingles) if len(shingles) else None
                bands.append(shingler.bands(signature) if len(shingles) else None)
                sketches.append(signature.astype(np.uint8).tobytes() if len(shingles) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(parts, pa.int64())]
            columns += [pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], *columns], schema=arrow)

    return docs.select("doc_id", _text_key(), "text").mapInArrow(sign, schema)


def _text_key() -> Column:
    return F.xxhash64("text").alias("text_key")


def _part(shingles: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(shingles.tobytes()), "big", signed=True)


def _unpruned(signatures: np.ndarray, i: int, others: np.ndarray, how: Similarity) -> np.ndarray:
    """Those of ``others`` that no batch of hashes prunes as a partner of ``i``."""
    equal, begin = np.zeros(len(others), np.int64), 0
    for end, least in how.least:
        if not others.size:
            break
        equal += (signatures[others, begin:end] == signatures[i, begin:end]).sum(axis=1)
        stay = equal >= least
        others, equal, begin = others[stay], equal[stay], end
    return others


class Chunk:
    """Members that a task compares: their sets, signatures, components and sides."""

    def __init__(self, shingler: Shingler, rows: list[dict]):
        self.how = shingler.how
        distinct = {(r["node"], r["text"]): r for r in rows}
        # A doc_id may have several texts: one of those with the node's set is taken.
        sets = {}
        for node, text in distinct:
            if node not in sets and _part(shingles := shingler(text)) == node[1]:
                sets[node] = (distinct[node, text], shingles)
        self.nodes = sorted(sets)
        rows, self.sets = [sets[node][0] for node in self.nodes], [sets[node][1] for node in self.nodes]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.signatures = np.array([shingler.signature(s) for s in self.sets])
        first = {}
        self.component = np.array([first.setdefault(r["label"], n) for n, r in enumerate(rows)])
        self.visits = np.array([r["visits"] for r in rows])

    def links(self, across: bool) -> Iterator[tuple[object, object]]:
        """Verified links that join components. ``across``: only between visitors and others."""
        percent = self.how.percent
        for i in range(len(self.nodes) - 1):
            others = np.nonzero(self.component[i + 1 :] != self.component[i])[0] + i + 1
            if across:
                others = others[self.visits[others] != self.visits[i]]
            small, large = np.minimum(self.sizes[others], self.sizes[i]), np.maximum(self.sizes[others], self.sizes[i])
            others = _unpruned(self.signatures, i, others[100 * small >= percent * large], self.how)
            for at in range(0, len(others), 64):
                some = others[at : at + 64]
                some = some[self.component[some] != self.component[i]]
                for j in some[self._similar(i, some)] if some.size else ():
                    if self.component[j] != self.component[i]:
                        self.component[self.component == self.component[j]] = self.component[i]
                        yield self.nodes[i], self.nodes[j]

    def _similar(self, i: int, others: np.ndarray) -> np.ndarray:
        """Exact verification on the full sets."""
        sizes, mine = self.sizes[others], self.sets[i]
        theirs = np.concatenate([self.sets[j] for j in others])
        place = np.searchsorted(mine, theirs)
        both = mine[np.minimum(place, len(mine) - 1)] == theirs
        common = np.add.reduceat(both.astype(np.int64), np.cumsum(sizes) - sizes)
        return 100 * common >= self.how.percent * (sizes + len(mine) - common)


def _link_schema(members: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(side, members.schema["node"].dataType) for side in "ab"])


def _likely(members: DataFrame, how: Similarity) -> DataFrame:
    """Forests of likely pairs (a, b) from the buckets of ``members``: band, key, node, sketch."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _link_schema(members)
    arrow = to_arrow_schema(schema)

    def forest(nodes: pa.Array, sketches: list[bytes]) -> pa.RecordBatch:
        signatures = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
        component, pairs = np.arange(len(sketches)), []
        for i in range(len(sketches) - 1):
            others = np.nonzero(component[i + 1 :] != component[i])[0] + i + 1
            for j in _unpruned(signatures, i, others, how).tolist():
                if component[j] != component[i]:
                    component[component == component[j]] = component[i]
                    pairs.append((i, j))
        ends = [nodes.take(pa.array([pair[k] for pair in pairs], pa.int64())) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([e.cast(f.type) for e, f in zip(ends, arrow, strict=True)], schema=arrow)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sketches, now = [], [], None
        for batch in batches:
            for at, of in enumerate(zip(batch["band"].to_pylist(), batch["key"].to_pylist(), strict=True)):
                if of != now:
                    if len(sketches) > 1:
                        yield forest(pa.concat_arrays(nodes), sketches)
                    nodes, sketches, now = [], [], of
                nodes.append(batch["node"].slice(at, 1))
                sketches.append(batch["sketch"][at].as_py())
        if len(sketches) > 1:
            yield forest(pa.concat_arrays(nodes), sketches)

    return members.repartition("band", "key").sortWithinPartitions("band", "key").mapInArrow(compare, schema)


def _linked(members: DataFrame, how: Similarity, across: bool) -> DataFrame:
    """Verified links (a, b) from the chunks of ``members``: group, chunk, node, label, visits, text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _link_schema(members)
    arrow, chunk_of = to_arrow_schema(schema), ("group", "chunk")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, now = Shingler(how), [], None

        def links() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                pairs = Chunk(shingler, held).links(across)
                found = [{side: {"id": n[0], "part": n[1]} for side, n in zip("ab", pair, strict=True)} for pair in pairs]
                yield pa.RecordBatch.from_pylist(found, arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    of = tuple(row[c] for c in chunk_of)
                    if of != now:
                        yield from links()
                        held, now = [], of
                    held.append(row | {c: (row[c]["id"], row[c]["part"]) for c in ("node", "label")})
        yield from links()

    return members.repartition(*chunk_of).sortWithinPartitions(*chunk_of).mapInArrow(compare, schema)


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node that it is connected to, of all nodes of ``edges`` (a, b).

    Large and small stars by turns: each node's neighbours are tied to the smallest of them,
    until every component is a star. All tables have at most as many rows as there are edges.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(pairs.distinct(), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stored, so that each join has its own shuffle, in which Spark splits a node with very many links.
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stored(large.distinct(), "large")
        smallest = stored(large.groupBy("a").agg(F.min("b").alias("least")), "smallest")
        small = large.join(smallest, "a").select("least", F.explode(F.array("a", "b")).alias("a")).where("a <> least")
        tied = stored(small.select("a", F.col("least").alias("b")).distinct(), "links")
        for old in (edges, least, large, smallest):
            forget(old)
        edges = tied
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` of ``edges`` (a, b, distinct and a > b) has one ``b`` and no ``b`` is an ``a``."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("above")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("above")))
    nodes = ends.groupBy("node").agg(F.sum("above").alias("above"), F.min("above").alias("least"))
    return nodes.where("above > 1 OR above > 0 AND least = 0").isEmpty()


def near_duplicates(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links lead to. A document without words has no
    shingles and no links. Rows with the same doc_id but other shingles are documents of their
    own. Rows whose doc_id is NULL can't be named and link with nothing; their component_id is NULL.
    Equal texts have equal sets and are linked; ties go to the smallest id. A very long text is
    held by one task with its set of hashes; other columns are left out; an empty table gives no rows.
    """
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label.id", "doc_id"))
    return _labelled(docs, how).select("doc_id", "n_shingles", own.alias("component_id"))


def _labelled(docs: DataFrame, how: Similarity) -> DataFrame:
    """doc_id, text_key, n_shingles, part and label of each row; the label is the (id, part) of the smallest linked set."""
    signed = stored(_signed(docs, how), "signed")
    named = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    node = F.struct(F.col("doc_id").alias("id"), "part")
    first = (F.first(c).alias(c) for c in ("bands", "sketch"))
    classes = named.groupBy("set_key").agg(F.min(node).alias("node"), F.first("n_shingles").alias("weight"), *first)
    classes = stored(classes, "classes")
    groups = components(stored(_likely_pairs(classes, how), "likely"))
    groups = groups.unionByName(groups.select(F.col("label").alias("node"), "label").distinct())  # the smallest ones too
    labels = components(_verified(groups.join(classes.select("node", "weight"), "node"), docs, how))
    found = classes.select("set_key", "node").join(labels, "node", "left")
    found = stored(found.select("set_key", F.coalesce("label", "node").alias("label")), "labels")
    forget(classes)
    result = signed.drop("bands", "sketch").join(found, "set_key", "left")
    return result.select("doc_id", "text_key", "n_shingles", "part", "label")


def _likely_pairs(classes: DataFrame, how: Similarity) -> DataFrame:
    """Pairs (a, b) that connect all classes which share a bucket and aren't pruned."""
    spread = classes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = spread.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("node").alias("center"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
    )
    same = buckets.where("members > 1").groupBy("members", "center", "mark")
    buckets = same.agg(F.min(F.struct("band", "key")).alias("first")).select("first.*", "center", "members")
    # Buckets and members grow with the table, so they are merged and not broadcast at any size.
    members = stored(spread.join(buckets.hint("merge"), ["band", "key"]), "members")
    small = members.where(F.col("members") <= BUCKET_MEMBERS).select("band", "key", "node")
    compared = _likely(small.join(classes.select("node", "sketch"), "node"), how)
    return compared.unionByName(members.where(F.col("members") > BUCKET_MEMBERS).select(F.col("node").alias("a"), F.col("center").alias("b")))


def _verified(members: DataFrame, docs: DataFrame, how: Similarity) -> DataFrame:
    """Verified links (a, b) of groups: node, weight, and the group's smallest node as label."""
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    ids = members.select("node.id").distinct()
    texts = stored(texts.join(ids.hint("merge"), "id", "left_semi"), "texts")  # only these travel further

    def with_texts(rows: DataFrame) -> DataFrame:
        """Every text of a node's id; ``Chunk`` takes the one with the node's set."""
        return rows.withColumn("id", F.col("node.id")).join(texts, "id").drop("id")

    weights = members.groupBy("label").agg(F.sum("weight").alias("weight"))
    chunks = F.ceil(F.col("weight") / CHUNK_SHINGLES).cast("int")
    weights = weights.select(F.col("label").alias("group"), chunks.alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")
    members = stored(members.select("node", F.col("label").alias("group")).join(weights, "group").select("group", chunk, "chunks", "node"), "members")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    large = members.where("chunks > 1")
    centers = large.where("node = group").select("group", every, F.col("group").alias("node"))  # in every chunk
    asked = members.select("group", "chunk", "node").unionByName(centers)
    asked = with_texts(asked).withColumns({"label": F.col("node"), "visits": F.lit(False)})
    links = stored(_linked(asked, how, across=False), "links")
    if large.isEmpty():
        return links
    labels = components(links)
    placed = stored(large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "placed")
    mains = placed.where("node = group").select("group", F.col("label").alias("main"))
    apart = placed.join(mains, "group").where("label <> main")
    visitors = apart.select("group", every, "node", "label", F.lit(True).alias("visits"), F.col("chunk").alias("own")).where("chunk <> own").drop("own")
    hosts = placed.join(apart.select("group").distinct(), "group", "left_semi")
    hosts = hosts.select("group", "chunk", "node", "label", F.lit(False).alias("visits"))
    return links.unionByName(stored(_linked(with_texts(hosts.unionByName(visitors)), how, across=True), "links"))


def without_near_duplicates(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:  # noqa: B008
    """``docs`` with one document of each component, the one with the smallest doc_id; all columns stay.

    Rows whose doc_id is NULL stay. Rows with the same doc_id are judged each by its own text;
    of those with equal texts one stays, and of equal shingles the text with the smallest hash.
    """
    found = _labelled(docs.select("doc_id", "text"), how).where("doc_id IS NOT NULL")
    first = found.where("label.id = doc_id AND label.part = part").groupBy("doc_id", "part").agg(F.min("text_key").alias("text_key"))
    alone = found.where("n_shingles = 0")
    kept = stored(first.select("doc_id", "text_key").unionByName(alone.select("doc_id", "text_key")), "kept")
    key = fresh(docs, "text_key")
    named = docs.withColumn(key, _text_key()).join(kept.withColumnRenamed("text_key", key), ["doc_id", key], "left_semi")
    named = named.dropDuplicates(["doc_id", key]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return named.unionByName(docs.where("doc_id IS NULL"))
