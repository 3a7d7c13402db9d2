"""Token-id files: documents in order, as frequency-ranked ids in a byte-aligned code.

A row of the files is a shard: the next documents of the order, up to a number of ids. A
shard stands for itself. Its vocabulary lists the ids that occur in it, the most frequent
first, and its ids are written as places in that list, so that common ones take one byte.
The code keeps two streams: ``data`` has each place in 1 to 4 little-endian bytes, without
gaps, and ``control`` has their lengths, less one, in two bits each, four to a byte, lowest
bits first. Four ids are decoded at once: the control byte names a row of a table, which
says where each of the 16 bytes of four integers lies in the data.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchlake.llm.common import by_size

#: Ids that a shard holds at most, unless its only document has more.
SHARD_IDS = 2_000_000
#: Words that a Python worker remembers the ids of, from task to task; the first ones are the common ones.
REMEMBERED = 300_000

_LENGTHS = np.array([[(byte >> 2 * k & 3) + 1 for k in range(4)] for byte in range(256)], np.int64)


def _gather_table() -> np.ndarray:
    """For each control byte: the place of each byte of four integers; 16 stands for a zero byte."""
    table = np.full((256, 16), 16, np.int64)
    for byte, lengths in enumerate(_LENGTHS):
        first = np.concatenate(([0], np.cumsum(lengths)))
        for k in range(4):
            table[byte, 4 * k : 4 * k + lengths[k]] = np.arange(first[k], first[k + 1])
    return table


_GATHER = _gather_table()


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """The control and the data bytes of unsigned 32-bit integers."""
    values = np.ascontiguousarray(values, "<u4")
    lengths = 1 + (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int, block: int = 1 << 16) -> np.ndarray:
    """The ``count`` integers of ``pack``; a block of control bytes is decoded at a time."""
    codes = np.frombuffer(control, np.uint8)
    sizes = _LENGTHS.sum(axis=1)[codes]
    first = np.cumsum(sizes) - sizes
    # The last integers of the last control byte may be padding, which has no data.
    data = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(17, np.uint8)))
    out = np.empty((len(codes), 16), np.uint8)
    for at in range(0, len(codes), block):
        table = _GATHER[codes[at : at + block]]
        found = data[np.minimum(first[at : at + block, None] + table, len(data) - 1)]
        out[at : at + block] = np.where(table == 16, 0, found)
    return out.view("<u4").reshape(-1)[:count]


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies spell bytes as letters: printable ones as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class Encoder:
    """Ids of texts, as the tokenizer gives them without added special tokens.

    A byte-level tokenizer cuts a text where a space or a line end is followed by other than
    white space, whatever stands before. The ids of the pieces between such cuts are looked up,
    and words that were not seen yet go to the tokenizer's model. Texts with runs of white
    space or special tokens, and other kinds of tokenizers, get their ids text by text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        layout = json.loads(self.tokenizer.to_str())
        before = layout["pre_tokenizer"] or {}
        self.by_piece = (
            (before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True)) == ("ByteLevel", False, True)
            and layout["normalizer"] is None
            and layout["model"]["type"] == "BPE"
        )
        special = [re.escape(x["content"]) for x in layout["added_tokens"]]
        space = "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace())
        self.whole = "|".join([f"[ \\n][{space}]", *special])
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def text(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of letters, with or without one space before them, which are one word to the tokenizer."""
        plain = word.isascii()  # these letters are spelled as they are
        spelled = word.replace(" ", self.letters[32]) if plain else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()

    def part(self, part: str) -> bytes:
        """Ids of a text that has no cut but at its start. Words are remembered without their commas and full stops."""
        ids = self.known.get(part)
        if ids is None:
            core = part.rstrip(",.")
            if core != part and core[-1:].isalpha():
                return self.part(core) + self.part(part[len(core) :])
            ids = self.word(part) if part[part[:1] == " " :].isalpha() else self.text(part)
            if len(self.known) < REMEMBERED:
                self.known[part] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        """Ids of what followed a space, or of a line end and what follows it."""
        if piece[:1] != "\n":
            return self.part(f" {piece}")
        return self.part("\n") + (self.part(piece[1:]) if len(piece) > 1 else b"")

    def _start(self, first: str, alone: bool) -> bytes:
        """Ids of what stands before the first cut of a text."""
        if alone or first[:1] == "\n":
            return self.text(first)
        return self.part(first) if first else b""

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has.

        Pieces are cut and told apart by Arrow, so that a piece is looked up once for all its
        occurrences in the texts; their ids are then gathered from those of the distinct pieces.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.by_piece:
            alone = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        else:
            alone = np.ones(len(texts), bool)
        cut = pc.if_else(pa.array(alone), "", texts)
        lists = pc.split_pattern(pc.replace_substring(cut, "\n", " \n"), " ")
        offsets, pieces = np.asarray(lists.offsets), lists.flatten()
        coded = pieces.dictionary_encode()
        index, firsts = coded.indices.to_numpy(zero_copy_only=False).copy(), offsets[:-1]
        later = np.ones(len(index), bool)
        later[firsts] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[index[later]] = True
        known, lead = self.known.get, " "
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [(known(lead + x) or self.piece(x)) if u else b"" for x, u in zip(distinct, used.tolist(), strict=True)]
        # What a text starts with has other ids than the same piece after a space.
        single = np.diff(offsets) == 1
        starts = zip(pieces.take(pa.array(firsts)).to_pylist(), single.tolist(), alone.tolist(), strict=True)
        index[firsts] = len(found) + np.arange(len(firsts))
        found += [b"" if apart else self._start(first, only) for first, only, apart in starts]
        for n in np.flatnonzero(alone).tolist():
            found[len(found) - len(firsts) + n] = self.text(texts[n].as_py())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, begins = np.frombuffer(b"".join(found), "<u4"), np.cumsum(lengths) - lengths
        counts = lengths[index]
        ends = np.cumsum(counts)
        ids = pool[np.arange(counts.sum()) + np.repeat(begins[index] - (ends - counts), counts)]
        return ids, np.diff(np.concatenate(([0], ends))[offsets])

    def __call__(self, text: str) -> np.ndarray:
        return self.texts(pa.array([text], pa.large_string()))[0]


@cache
def encoder_of(path: str) -> Encoder:
    """The worker's encoder: loaded once, whatever the number of its tasks."""
    return Encoder(path)


def _shard(part: int, number: int, docs: list, ids: list[np.ndarray]) -> dict:
    stream = np.concatenate(ids)
    counts = np.bincount(stream)  # ids are below the size of the tokenizer's vocabulary
    distinct = np.flatnonzero(counts)
    distinct = distinct[np.argsort(-counts[distinct], kind="stable")]
    rank = np.zeros(len(counts), np.uint32)
    rank[distinct] = np.arange(len(distinct))
    control, data = pack(rank[stream])
    vocabulary = distinct.astype("<u4").tobytes()
    lengths = [len(x) for x in ids]
    return {"part": part, "shard": number, "tokens": len(stream), "doc_ids": docs, "lengths": lengths} | {
        "vocabulary": vocabulary,
        "control": control,
        "data": data,
    }


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of all texts of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    ``tokenizer`` is the path of a tokenizers file, ``end_id`` ends each document. NULL and empty
    texts have no ids but the end; NULL ids come first; equal rows are written one by one; other
    columns are left out; an empty table gives files without shards. A row goes to the range of its id, so what a
    task holds at once is one shard.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (("part", T.IntegerType()), ("shard", T.IntegerType()), ("tokens", T.LongType()))]
        + [T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType()))]
        + [T.StructField(n, T.BinaryType()) for n in ("vocabulary", "control", "data")]
    )
    arrow = _arrow_schema(kind)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), np.array([] if end_id is None else [end_id], "<u4")
        names, ids, held, number, part = [], [], 0, 0, 0
        for batch in by_size(batches, "text", 4 << 20):
            part = batch["part"][0].as_py()
            stream, counts = encoder.texts(batch["text"])
            for doc_id, text_ids in zip(batch["doc_id"].to_pylist(), np.split(stream, np.cumsum(counts)[:-1]), strict=True):
                new = np.concatenate((text_ids, end))
                if ids and held + len(new) > shard_ids:
                    yield pa.RecordBatch.from_pylist([_shard(part, number, names, ids)], arrow)
                    names, ids, held, number = [], [], 0, number + 1
                names.append(doc_id)
                ids.append(new)
                held += len(new)
        if ids:
            yield pa.RecordBatch.from_pylist([_shard(part, number, names, ids)], arrow)

    order = F.col("doc_id").asc_nulls_first()
    laid = docs.select("doc_id", "text").repartitionByRange(order).sortWithinPartitions(order)
    shards = laid.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(encode, schema)
    shards.write.option("compression", "zstd").parquet(path)


def _arrow_schema(kind: T.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    doc_id = to_arrow_type(kind)
    numbers = [("part", pa.int32()), ("shard", pa.int32()), ("tokens", pa.int64())]
    lists = [("doc_ids", pa.list_(doc_id)), ("lengths", pa.list_(pa.int64()))]
    return pa.schema(numbers + lists + [(n, pa.binary()) for n in ("vocabulary", "control", "data")])


def shard_ids_of(row: dict) -> Iterator[tuple[object, np.ndarray]]:
    """The documents of a shard with their ids, decoded from its bytes."""
    ids = np.frombuffer(row["vocabulary"], "<u4")[unpack(row["control"], row["data"], row["tokens"])]
    ends = np.cumsum(row["lengths"], dtype=np.int64)
    for doc_id, end, length in zip(row["doc_ids"], ends, row["lengths"], strict=True):
        yield doc_id, ids[end - length : end]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of ``write_tokens`` as doc_id, part, shard, place (in the shard), offset and ids."""
    files = spark.read.parquet(path)
    return _decoded(files, "ids array<long>", lambda ids: {"ids": ids.tolist()}, pa.list_(pa.int64()))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and ids_crc32, all from the files.

    ``start`` counts the ids of all documents before it: those of the parts before, of the
    part's shards before and of the shard's documents before. What is summed in order over
    all files is one number for each part.
    """
    files = spark.read.parquet(path)
    docs = _decoded(files, "ids_crc32 long", lambda ids: {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}, pa.int64())
    shards = files.select("part", "shard", "tokens")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(earlier.orderBy("part")), F.lit(0)).alias("part_start"))
    within = F.coalesce(F.sum("tokens").over(earlier.partitionBy("part").orderBy("shard")), F.lit(0))
    starts = shards.select("part", "shard", within.alias("shard_start")).join(F.broadcast(parts), "part")
    start = F.col("part_start") + F.col("shard_start") + F.col("offset")
    return docs.join(starts, ["part", "shard"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def _decoded(files: DataFrame, column: str, value, arrow_type: pa.DataType) -> DataFrame:
    kind = files.schema["doc_ids"].dataType.elementType
    name = column.split(" ")[0]
    schema = f"doc_id {kind.simpleString()}, part int, shard int, place int, offset long, n_tokens long, {column}"
    doc_id = _arrow_schema(kind).field("doc_ids").type.value_type
    places = [(n, pa.int32()) for n in ("part", "shard", "place")]
    arrow = pa.schema([("doc_id", doc_id), *places, ("offset", pa.int64()), ("n_tokens", pa.int64()), (name, arrow_type)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard, rows, offset = batch.slice(at, 1).to_pylist()[0], [], 0
                for place, (doc_id, ids) in enumerate(shard_ids_of(shard)):
                    fixed = {"doc_id": doc_id, "part": shard["part"], "shard": shard["shard"], "place": place}
                    rows.append(fixed | {"offset": offset, "n_tokens": len(ids)} | value(ids))
                    offset += len(ids)
                yield pa.RecordBatch.from_pylist(rows, arrow)

    return files.mapInArrow(decode, schema)
