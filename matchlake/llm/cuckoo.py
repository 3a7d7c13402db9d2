"""Exact duplicates by an index of live digests behind cuckoo filters.

The index is dealt over shards by digest. A shard has a cuckoo filter, 16-bit fingerprints
in buckets of four, and next to every fingerprint the key it stands for: the digest, the
document that stands for its copies and the number of live copies. A miss in the filter is
a new digest. A hit is compared with the keys in its two buckets, which settles false hits.
When no place can be made for a key, the filter is rebuilt twice as large from its keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import SPACE, fresh, stored

SLOTS = 4
MOST_KICKS = 200
#: Digests that a task's first filter holds before it hands them on.
HANDED_ON = 100_000


class CuckooIndex:
    """The filter and keys of one shard. ``kept`` and ``live`` are lists in step with ``keys``."""

    def __init__(self, buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.kept: list = []
        self.live: list[int] = []
        self.free: list[int] = []
        self._empty(buckets)

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)

    def _empty(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)  # 0: free
        self.held = [-1] * (buckets * SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = 1 + int.from_bytes(digest[:2], "little") % 0xFFFF
        first = int.from_bytes(digest[2:10], "little") % self.buckets
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) % self.buckets  # the number of buckets is a power of two

    def find(self, digest: bytes) -> int | None:
        """The key's number, if the digest is live; fingerprints that match are verified."""
        mark, *pair = self._places(digest)
        for bucket in pair:
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.keys[self.held[slot]] == digest:
                    return self.held[slot]
        return None

    def add(self, digest: bytes, doc_id, copies: int = 1) -> int:
        """Adds copies of a digest; the smallest id stands for them. Returns the key's number."""
        number = self.find(digest)
        if number is not None:
            self.live[number] += copies
            if doc_id is not None and (self.kept[number] is None or doc_id < self.kept[number]):
                self.kept[number] = doc_id
            return number
        if self.free:
            number = self.free.pop()
            self.keys[number], self.kept[number], self.live[number] = digest, doc_id, copies
        else:
            number = len(self.keys)
            self.keys.append(digest)
            self.kept.append(doc_id)
            self.live.append(copies)
        if not self._settle(number):
            self._grow()
        return number

    def remove(self, digest: bytes, copies: int = 1) -> bool:
        """Takes copies away; with the last one the digest leaves the filter. False: not live."""
        number = self.find(digest)
        if number is None:
            return False
        self.live[number] -= copies
        if self.live[number] <= 0:
            slot = self._slot_of(number)
            self.prints[slot], self.held[slot], self.keys[number] = 0, -1, None
            self.free.append(number)
        return True

    def _slot_of(self, number: int) -> int:
        _, *pair = self._places(self.keys[number])
        return next(s for b in pair for s in range(b * SLOTS, b * SLOTS + SLOTS) if self.held[s] == number)

    def _settle(self, number: int) -> bool:
        mark, first, second = self._places(self.keys[number])
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.held[slot] = mark, number
                    return True
        bucket = first
        for kick in range(MOST_KICKS):  # the one thrown out goes to its other bucket
            slot = bucket * SLOTS + (kick + mark) % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            number, self.held[slot] = self.held[slot], number
            bucket = self._other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[free]:
                    self.prints[free], self.held[free] = mark, number
                    return True
        return False

    def _grow(self) -> None:
        buckets = self.buckets
        while True:
            buckets *= 2
            self._empty(buckets)
            if all(self._settle(n) for n, key in enumerate(self.keys) if key is not None):
                return

    def rows(self) -> Iterator[dict]:
        """The live keys with their slots, from which ``restore`` sets the filter up as it was."""
        for slot, number in enumerate(self.held):
            if number >= 0:
                row = {"slot": slot, "buckets": self.buckets, "digest": self.keys[number]}
                yield row | {"keep_id": self.kept[number], "live": self.live[number]}

    def restore(self, row: dict) -> None:
        if self.buckets != row["buckets"]:
            self._empty(row["buckets"])
        self.prints[row["slot"]] = self._places(row["digest"])[0]
        self.held[row["slot"]] = len(self.keys)
        self.keys.append(row["digest"])
        self.kept.append(row["keep_id"])
        self.live.append(row["live"])


def normal_text(text: Column) -> Column:
    """The text with each run of white space as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _schema(kind: T.DataType) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = (("shard", T.IntegerType()), ("slot", T.IntegerType()), ("buckets", T.IntegerType()))
    fields += (("digest", T.BinaryType()), ("keep_id", kind), ("live", T.LongType()))
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return schema, to_arrow_schema(schema)


def _shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _folded(digests: DataFrame, shards: int) -> DataFrame:
    """A row for each digest and task, from a filter in each task: hot digests shrink before the shuffle."""
    schema, arrow = _schema(digests.schema["doc_id"].dataType)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for doc_id, digest in zip(batch["doc_id"].to_pylist(), batch["digest"].to_pylist(), strict=True):
                index.add(digest, doc_id)
            if len(index) > HANDED_ON:
                yield pa.RecordBatch.from_pylist([{"shard": 0} | r for r in index.rows()], arrow)
                index = CuckooIndex()
        yield pa.RecordBatch.from_pylist([{"shard": 0} | r for r in index.rows()], arrow)

    return digests.select("doc_id", "digest").mapInArrow(fold, schema).withColumn("shard", _shard_of(shards))


def update(
    shards: int, index: DataFrame | None = None, added: DataFrame | None = None, removed: DataFrame | None = None
) -> DataFrame:
    """The index after adding and then removing documents, given as doc_id and digest.

    An index is a table of shard, slot, buckets, digest, keep_id and live; ``shards`` must be
    that of ``index``, and should leave a shard some hundred thousand digests. The id that
    stands for a digest stays the smallest ever added while a copy lives. Digests that are
    not live can't be removed and are passed over; NULL ids never stand for others.
    """
    frames = []
    if index is not None:
        frames.append(index.withColumn("step", F.lit(0)))
    frames += [_folded(x, shards).withColumn("step", F.lit(n)) for n, x in ((1, added), (2, removed)) if x is not None]
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more)
    schema, arrow = _schema(rows.schema["keep_id"].dataType)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, filled = None, CuckooIndex()
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if len(filled):
                        yield pa.RecordBatch.from_pylist([{"shard": shard} | r for r in filled.rows()], arrow)
                    shard, filled = row["shard"], CuckooIndex()
                if row["step"] == 0:
                    filled.restore(row)
                elif row["step"] == 1:
                    filled.add(row["digest"], row["keep_id"], row["live"])
                else:
                    filled.remove(row["digest"], row["live"])
        if len(filled):
            yield pa.RecordBatch.from_pylist([{"shard": shard} | r for r in filled.rows()], arrow)

    return rows.repartition("shard").sortWithinPartitions("shard", "step", "digest").mapInArrow(merge, schema)


def duplicates(docs: DataFrame, per_shard: int = 50_000) -> DataFrame:
    """``docs`` with text_sha256, keep_id, group_size and kept; needs doc_id and text.

    Texts are equal when they are after ``normal_text``; NULL counts as empty. The smallest id
    of a group stays. Rows of the same id and text are all marked as it is; a group that has
    only NULL ids has none to stay, and its rows are kept. Columns of the new names are replaced.
    """
    docs = docs.drop("text_sha256", "keep_id", "group_size", "kept")
    digest = fresh(docs, "digest")
    narrow = [c for c in docs.columns if c != "text"]
    hashed = docs.select(*[F.col(f"`{c}`") for c in narrow], F.unhex(F.sha2(normal_text(F.col("text")), 256)).alias(digest))
    hashed = stored(hashed, "digests")
    shards = max(1, -(-hashed.count() // per_shard))
    index = stored(update(shards, added=hashed.select("doc_id", F.col(digest).alias("digest"))), "cuckoo")
    groups = index.select(F.col("digest").alias(digest), "keep_id", F.col("live").alias("group_size"))
    return hashed.join(groups, digest).select(
        *[F.col(f"`{c}`") for c in narrow],
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex(digest)).alias("text_sha256"),
    )
