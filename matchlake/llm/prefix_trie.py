"""Tries of conversations by their turns: what prefixes they share, and what sharing saves.

Conversations are sequences of turn digests. Equal ones become one row with a count; the
distinct ones are dealt out by range of their order, so a shard is a range of prefixes and a
prefix that very many share is split like any other. Each shard packs its sequences into a
double array: the child of state s by turn t is state ``base[s] + t``, if ``check`` says that
its parent is s. Walking the sequences gives each node's aggregates.

Only nodes on the path that a shard's first sequence shares with the one before it, or its
last with the one after it, are in several shards. Their length comes from the border
sequences of all shards. A node belongs to the shard that meets it first, and all aggregates
are sums over what belongs to a shard, so shared nodes are merged by adding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from matchlake.llm.common import stored

#: Ids of one end that a piece holds before they are joined.
PIECE = 65_536
NO_ENDS = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """A trie of sorted distinct sequences of integers from 0, as BASE and CHECK arrays; state 0 is the root."""

    def __init__(self, sequences: list[list[int]]):
        self.base, self.check = np.zeros(64, np.int64), np.full(64, -1, np.int64)
        self._next = list(range(65))
        self.check[0] = 0
        self._next[0] = 1
        open_nodes = [(0, 0, len(sequences), 0)]
        while open_nodes:
            state, low, high, depth = open_nodes.pop()
            if low < high and len(sequences[low]) == depth:  # the sequence that ends here sorts first
                low += 1
            if low == high:
                continue
            turns, starts = [], []
            for at in range(low, high):
                turn = sequences[at][depth]
                if not turns or turns[-1] != turn:
                    turns.append(turn)
                    starts.append(at)
            base = self._fit(turns)
            self.base[state] = base
            for turn, start, end in zip(turns, starts, [*starts[1:], high], strict=True):
                self.check[base + turn] = state
                self._next[base + turn] = base + turn + 1
                open_nodes.append((base + turn, start, end, depth + 1))

    def _free(self, slot: int) -> int:
        """The first free slot from ``slot`` on; remembers what it skipped."""
        self._grow(slot)
        passed, after = [], self._next
        while after[slot] != slot:
            passed.append(slot)
            slot = after[slot]
            if slot >= len(self.check):
                self._grow(slot)
        for x in passed:
            after[x] = slot
        return slot

    def _grow(self, slot: int) -> None:
        if slot >= len(self.check):
            more = max(len(self.check), slot + 1 - len(self.check))
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))
            self._next.extend(range(len(self._next), len(self._next) + more))

    def _fit(self, turns: list[int]) -> int:
        """The smallest base, from 1, whose slots are free for all of a node's turns."""
        offsets = np.array(turns) - turns[0]
        slot = self._free(turns[0] + 1)
        while len(turns) > 1:
            self._grow(slot + int(offsets[-1]))
            taken = np.flatnonzero(self.check[slot + offsets] >= 0)
            if not len(taken):
                break
            slot = self._free(slot + 1)
        return slot - turns[0]

    def walk(self, sequence: list[int]) -> list[int]:
        """The states of a sequence's prefixes, from the root; ends where the trie has no such child."""
        states = [0]
        for turn in sequence:
            child = int(self.base[states[-1]]) + turn
            if not 0 < child < len(self.check) or self.check[child] != states[-1] or not self.base[states[-1]]:
                break
            states.append(child)
        return states


def turn_lists(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: its turns as (key, chars), ordered by turn, NULL first.

    ``key`` is the SHA-256 of role and text, ``chars`` the text's code points. NULL roles and
    texts count as empty; turns of the same number are ordered by their keys, also equal
    ones; rows without conv_id belong to no conversation; other columns are left out.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id is not null").select(
        "conv_id", F.struct(F.col("turn"), key.alias("key"), F.length(text).cast("long").alias("chars")).alias("turn")
    )
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return lists.withColumn("turns", F.transform("turns", lambda t: F.struct(t["key"], t["chars"])))


def spliced(lists: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations of ``turn_lists`` whose first h turns are those of another one.

    The other is the one whose id ends a step of ``every`` ids; h is the checksum of the
    decimal id modulo ``most``. If it has fewer turns, all are taken; if it is absent, none.
    """
    head = lists.where(F.col("conv_id") % every == 0)
    head = head.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).cast("int")
    size = F.size("turns")
    own = F.slice("turns", h + 1, F.greatest(size - h, F.lit(0)))
    first = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    joined = lists.join(head, F.col("conv_id") - F.col("conv_id") % every == F.col("head_id"), "left")
    return joined.select("conv_id", F.concat(first, own).alias("turns"))


def _keys(turns: str) -> Column:
    return F.transform(turns, lambda t: t["key"])


def _ends(sequences: DataFrame) -> DataFrame:
    """One row per distinct sequence: its smallest conv_id, how many have it, and the digest of their ids.

    Ids are sorted over all tasks by sequence and id and joined to pieces, so that of a
    sequence that very many share only pieces of text meet in one task, one at a time.
    """
    kind = sequences.schema["conv_id"].dataType
    arrow = pa.schema([("path", pa.string()), ("conv_id", to_arrow_type(kind)), ("n", pa.int64()), ("ids", pa.string())])

    def piece(path: str, ids: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": path, "conv_id": ids[0], "n": len(ids), "ids": ",".join(map(str, ids))}], arrow)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ids, rows = None, [], []
        for batch in batches:
            for now, conv_id in zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (now != path or len(ids) == PIECE):
                    rows.append((path, ids))
                    ids = []
                path = now
                ids.append(conv_id)
            yield from (piece(*row) for row in rows if len(row[1]) > 1024)
            small = [r for r in rows if len(r[1]) <= 1024]
            columns = [[r[0] for r in small], [r[1][0] for r in small], [len(r[1]) for r in small], [",".join(map(str, r[1])) for r in small]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
            rows = []
        if ids:
            yield piece(path, ids)

    out = pa.schema([("conv_id", to_arrow_type(kind)), ("n", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, first, n, hashed = None, None, 0, hashlib.sha256()
        for batch in batches:
            rows = []
            for now, conv_id, count, ids in zip(*(batch[c].to_pylist() for c in ("path", "conv_id", "n", "ids")), strict=True):
                if n and now == path:
                    hashed.update(f",{ids}".encode())
                    n += count
                else:
                    if n:
                        rows.append({"conv_id": first, "n": n, "ends_sha256": hashed.hexdigest()})
                    path, first, n, hashed = now, conv_id, count, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist(rows, out)
        if n:
            yield pa.RecordBatch.from_pylist([{"conv_id": first, "n": n, "ends_sha256": hashed.hexdigest()}], out)

    laid = sequences.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    id_type = kind.simpleString()
    pieces = laid.mapInArrow(join, f"path string, conv_id {id_type}, n long, ids string")
    pieces = pieces.repartition("path").sortWithinPartitions("path", "conv_id")
    return pieces.mapInArrow(digest, f"conv_id {id_type}, n long, ends_sha256 string")


def _common(a: str, b: str) -> Column:
    """How many first elements of two arrays are equal."""
    least = F.least(F.size(a), F.size(b))
    equal = F.zip_with(F.slice(a, F.lit(1), least), F.slice(b, F.lit(1), least), lambda x, y: x == y)
    differs = F.array_position(equal, F.lit(False)).cast("int")
    return F.when(differs > 0, differs - 1).otherwise(least)


def _shards(sequences: DataFrame) -> DataFrame:
    """Rows with their shard, and the lengths of the prefixes that a shard's borders share; -1 without a neighbour."""
    laid = sequences.repartitionByRange(_keys("turns")).withColumn("shard", F.spark_partition_id())
    laid = stored(laid, "shards")
    borders = laid.groupBy("shard").agg(F.min(_keys("turns")).alias("first"), F.max(_keys("turns")).alias("last"))
    order = Window.orderBy("shard")  # a row for each shard
    borders = borders.select("shard", "first", "last", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    borders = borders.select(
        "shard",
        F.when(F.col("before").isNull(), -1).otherwise(_common("before", "first")).alias("shared_before"),
        F.when(F.col("after").isNull(), -1).otherwise(_common("last", "after")).alias("shared_after"),
    )
    return laid.join(F.broadcast(borders), "shard").repartition("shard").sortWithinPartitions("shard", _keys("turns"))


def _shard_nodes(rows: pa.Table, arrow: pa.Schema) -> pa.RecordBatch:
    """The nodes of one shard, its rows sorted by turns; those of other shards as well carry digests."""
    lists = rows["turns"].combine_chunks()
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    turns = lists.flatten()
    encoded = turns.field("key").dictionary_encode()
    order = np.asarray(pc.sort_indices(encoded.dictionary))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[encoded.indices.to_numpy()] if len(order) else np.empty(0, np.int64)
    size = np.zeros(len(order), np.int64)
    size[codes] = turns.field("chars").to_numpy()
    size, codes, key_of = size.tolist(), codes.tolist(), encoded.dictionary.take(pa.array(order)).to_pylist()
    sequences = [codes[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    shared_before, shared_after = rows["shared_before"][0].as_py(), rows["shared_after"][0].as_py()

    trie = DoubleArray(sequences)
    paths = [trie.walk(s) for s in (sequences[0], sequences[-1])]
    shared = {state: depth for path, most in zip(paths, (shared_before, shared_after), strict=True) for depth, state in enumerate(path[: most + 1])}
    theirs = set(paths[0][: shared_before + 1])  # met by an earlier shard first
    base, check = trie.base.tolist(), trie.check.tolist()
    n, least, depths, turn_of, ends = {}, {}, {}, {}, {}
    for sequence, count, conv_id, digest in zip(sequences, *(rows[c].to_pylist() for c in ("n", "conv_id", "ends_sha256")), strict=True):
        state, depth, turn = 0, 0, None
        for following in [*sequence, None]:
            if state not in n:  # nodes come in preorder
                n[state], least[state], depths[state], turn_of[state] = 0, conv_id, depth, turn
            n[state] += count
            least[state] = min(least[state], conv_id)
            if following is not None:
                state, depth, turn = base[state] + following, depth + 1, following
        ends[state] = digest
    children, leaves, saved = (dict.fromkeys(n, 0) for _ in range(3))
    after = paths[1][-1] if shared_after == len(sequences[-1]) else None  # goes on in the next shard
    for state in reversed(n):
        chars = size[turn_of[state]] if state else 0
        saved[state] += chars * n[state] - (0 if state in theirs else chars)
        if not children[state] and state in ends and state != after:
            leaves[state] += 1
        if state:
            parent = check[state]
            children[parent] += state not in theirs
            leaves[parent] += leaves[state]
            saved[parent] += saved[state]
    digests: dict[int, str] = {}
    for path in paths:
        hashed = hashlib.sha256()
        for state in path:
            if state:
                hashed.update(key_of[turn_of[state]])
            if state in shared:
                digests[state] = hashed.hexdigest()
    parents = [check[s] if s else None for s in n]
    columns = {
        "node": [digests.get(s) for s in n],
        "parent": [digests.get(p) for p in parents],
        "conv_id": list(least.values()),
        "depth": list(depths.values()),
        "parent_conv_id": [None if p is None or p in shared else least[p] for p in parents],
        "n_convs": list(n.values()),
        "n_children": list(children.values()),
        "n_leaves": list(leaves.values()),
        "saved_chars": list(saved.values()),
        "ends_sha256": [ends.get(s) for s in n],
    }
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)


def prefix_nodes(lists: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations in ``lists`` (conv_id, turns).

    A node has its smallest member (conv_id), depth, its parent's smallest member, the number
    of conversations with the prefix, of its children and of the childless nodes below it,
    itself included; ``saved_chars`` sums, over the nodes below and itself, the code points
    of the last turn for all members but one; ``ends_sha256`` is the SHA-256 of the ids of
    those that end there, ascending and joined by commas. Conversations without turns are
    members of the root only. Equal conversations and very common prefixes are no hot spot;
    a very long conversation is held by one task. An empty table gives no nodes.
    """
    kind = lists.schema["conv_id"].dataType
    numbers = [T.StructField(c, T.LongType()) for c in ("n_convs", "n_children", "n_leaves", "saved_chars")]
    schema = T.StructType(
        [T.StructField("node", T.StringType()), T.StructField("parent", T.StringType()), T.StructField("conv_id", kind)]
        + [T.StructField("depth", T.LongType()), T.StructField("parent_conv_id", kind), *numbers, T.StructField("ends_sha256", T.StringType())]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def nodes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None
        for batch in batches:
            numbers = batch["shard"].to_numpy()
            for part in np.split(np.arange(len(numbers)), np.flatnonzero(np.diff(numbers)) + 1):
                if held and numbers[part[0]] != shard:
                    yield _shard_nodes(pa.Table.from_batches(held), arrow)
                    held = []
                shard = numbers[part[0]]
                held.append(batch.slice(int(part[0]), len(part)))
        if held:
            yield _shard_nodes(pa.Table.from_batches(held), arrow)

    path = F.sha2(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""), 256)
    sequences = stored(lists.select("conv_id", "turns", path.alias("path")), "sequences")
    distinct = sequences.select("conv_id", "turns").join(_ends(sequences), "conv_id")
    nodes = stored(_shards(distinct).mapInArrow(nodes_of, schema), "nodes")
    merged = (
        nodes.where("node is not null")
        .groupBy("node")
        .agg(
            F.max("parent").alias("parent"),
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[F.sum(c.name).alias(c.name) for c in numbers],
            F.max("ends_sha256").alias("ends_sha256"),
        )
    )
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inner = nodes.where("node is null").drop("node")
    everything = inner.unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast(kind)).drop("node"))
    return everything.join(above, "parent", "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        *[c.name for c in numbers],
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
