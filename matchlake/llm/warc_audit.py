"""WARC files and their Merkle fixity audit.

``write_warc`` writes one record for each page. ``scan_warc`` reads the files of a replica
record by record: where it lies, how long it is, and its SHA-256. ``merkle_tree`` hashes
ranges of ``FANOUT`` records in the order of their offsets, ranges of such ranges, and so on
up to one root for each file. ``mismatches`` compares the roots of two replicas and goes down
only where they differ, until it has the records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import by_size, stored

FANOUT = 16
#: Records of a file at most, which bound the file that a task reads whole.
FILE_RECORDS = 2_000
_END = "\r\n\r\n"
#: Fixed value: a gzip member that holds nothing.
_EMPTY = bytes.fromhex("1f8b080000000000000303000000000000000000")
#: Bytes that are inflated at a time.
_PIECE = 16_384


def _header(text: Column) -> Column:
    """A header's value on one line."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """A resource record without the line ends that close it; NULL headers and bodies are empty."""
    body = F.coalesce(html, F.lit(""))
    lines = [
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:page:"),
        _header(page_id.cast("string")),
        F.lit(">\r\nWARC-Target-URI: "),
        _header(url),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(_END),
        body,
    ]
    return F.concat(*lines)


def write_warc(pages: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Writes ``pages`` (page_id, url, html) as gzipped WARC files, in the order of their rows.

    Each record is a gzip member of its own, so that damage to one leaves the others readable. Spark's
    text writer puts an empty member after each as its line end; tasks write, and rewrite after a
    loss, as they do any other files. NULL columns are empty; repeated rows are records of their
    own; an empty table gives no records.
    """

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "value"):
            members = []
            for text in batch["value"]:
                deflate = zlib.compressobj(wbits=31)
                members.append(deflate.compress(text.as_buffer()) + deflate.compress(_END.encode()) + deflate.flush())
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])

    records = pages.select(record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("value"))
    members = records.mapInArrow(compress, "value binary").select(F.col("value").cast("string"))
    writer = members.write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY.decode("latin-1"))
    writer.option("maxRecordsPerFile", file_records).text(path)


def _member(content: bytes, at: int, most: int | None = None) -> tuple[bytes, int | None]:
    """What the gzip member at ``at`` holds, as far as it can be read, and where it ends; None if it is damaged.

    With ``most`` reading stops once so many bytes are known.
    """
    inflate, parts, read = zlib.decompressobj(wbits=31), [], 0
    while at < len(content) and not inflate.eof and (most is None or read < most):
        piece = content[at : at + _PIECE]
        before = inflate.copy()
        try:
            parts.append(inflate.decompress(piece))
        except zlib.error:
            return b"".join([*parts, *_readable(before, piece)]), None
        read, at = read + len(parts[-1]), at + len(piece)
    return b"".join(parts), at - len(inflate.unused_data) if inflate.eof else None


def _readable(inflate, piece: bytes) -> Iterator[bytes]:
    """What a damaged piece gives before its error."""
    for at in range(len(piece)):
        try:
            yield inflate.decompress(piece[at : at + 1])
        except zlib.error:
            return


def _next_member(content: bytes, at: int) -> int:
    """Where the next member with the start of a record begins, or the end."""
    while (at := content.find(_EMPTY[:3], at)) >= 0:
        if _member(content, at, 5)[0][:5] == b"WARC/":
            return at
        at += 1
    return len(content)


def _stretches(content: bytes) -> Iterator[tuple[bytes, bool]]:
    """The uncompressed parts of a gzipped file between its damaged members, which are parts of their own, and whether they are damaged."""
    parts, at = [], 0  # a member for the file, or one for each record
    while at < len(content):
        if content.startswith(_EMPTY, at):
            at += len(_EMPTY)
            continue
        part, end = _member(content, at)
        if end is None:
            if parts:
                yield b"".join(parts), False
            end, parts = _next_member(content, at + 1), []
            if end - at != len(_EMPTY):  # else an empty member is damaged, which loses nothing
                yield part, True
        else:
            parts.append(part)
        at = end
    if parts:
        yield b"".join(parts), False


def read_records(content: bytes) -> Iterator[tuple[int, bytes, dict[str, str], bytes]]:
    """Offset, bytes, headers and body of each record of a gzipped or plain WARC file.

    Offsets are those of the uncompressed file. A damaged gzip member gives what can be read of it, the
    rest of it as one record without headers, and reading goes on at the next member that starts a
    record; offsets after it lack what was lost. Damage in the empty members between records loses nothing
    and gives no sign. In a plain file, or within a member, what can't be parsed
    ends the file or the member: its rest is one record without headers. A file that is cut off
    lacks what comes after the cut. An empty file has no records.
    """
    at, plain = 0, content[:5] == b"WARC/" or content.find(_EMPTY[:3]) < 0
    for part, damaged in [(content, False)] if plain else _stretches(content):
        records = list(_parsed(part)) if damaged else _parsed(part)
        if damaged and len(records) > 1 and not records[-1][1].startswith(b"WARC/"):
            # Bytes after the end of a record are damage to it.
            first, record, headers, body = records[-2]
            records[-2:] = [(first, record + records[-1][1], headers, body)]
        for offset, record, headers, body in records or ([(0, b"", {}, b"")] if damaged else []):
            yield at + offset, record, headers, body
        at += len(part)


def _parsed(content: bytes) -> Iterator[tuple[int, bytes, dict[str, str], bytes]]:
    at = 0
    while at < len(content):
        head = content.find(b"\r\n\r\n", at)
        lines = content[at:head].decode("utf-8", "replace").split("\r\n") if head >= 0 else [""]
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        length = headers.get("Content-Length", "")
        end = head + 4 + int(length) if length.isascii() and length.isdigit() else -1
        if not lines[0].startswith("WARC/") or end < 0 or content[end : end + 4] != b"\r\n\r\n":
            yield at, content[at:], {}, b""
            return
        yield at, content[at : end + 4], headers, content[head + 4 : end]
        at = end + 4


def scan_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, ordinal, offset, length, record_id and sha256 of every record below ``path``.

    ``file`` is the file's number, which replicas share; a file that Spark didn't name has its own name.
    A file is read as a whole by one task, with records of any length. Repeated records are told
    apart by their ordinals, records without an id have a NULL one, files without records give no rows.
    """
    schema = "file string, ordinal long, offset long, length long, record_id string, sha256 string"
    names = ("file", "ordinal", "offset", "length", "record_id", "sha256")
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    arrow = pa.schema(list(zip(names, types, strict=True)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["file"].to_pylist(), batch["content"], strict=True):
                rows = [
                    (file, n, at, len(record), headers.get("WARC-Record-ID"), hashlib.sha256(record).hexdigest())
                    for n, (at, record, headers, _) in enumerate(read_records(content.as_py()))
                ]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], schema=arrow)

    file = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"^(part-\d+)-.*?((?:-c\d+)?)\..*$", "$1$2")
    files = spark.read.format("binaryFile").load(path).select(file.alias("file"), "content")
    return files.mapInArrow(scan, schema)


def merkle_tree(records: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """file, level, node, begin, end and hash of all nodes over ``records`` (file, ordinal, offset, length, sha256).

    A node's hash covers its range of offsets and the hashes below it in their order. Records
    are level 0; a file's root is the only node of its highest level. A group has at most
    ``fanout`` rows, and a level a ``fanout``-th of the rows of the one below.
    """
    level = records.select(
        "file",
        F.lit(0).alias("level"),
        F.col("ordinal").alias("node"),
        F.col("offset").alias("begin"),
        (F.col("offset") + F.col("length")).alias("end"),
        F.col("sha256").alias("hash"),
    )
    tree, depth = level, 0
    most = records.agg(F.max("ordinal").alias("most")).first()["most"] or 0
    while most > 0 or depth == 0:
        most, depth = most // fanout, depth + 1
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        level = level.groupBy("file", F.expr(f"node div {fanout}").alias("parent")).agg(
            F.min("begin").alias("begin"), F.max("end").alias("end"), F.array_join(F.transform(children, lambda c: c["hash"]), "").alias("below")
        )
        covered = F.concat_ws(":", "begin", "end", "below")
        level = level.select("file", F.lit(depth).alias("level"), F.col("parent").alias("node"), "begin", "end", F.sha2(covered, 256).alias("hash"))
        level = stored(level, f"merkle-{depth}")
        tree = tree.unionByName(level)
    return tree


def mismatches(one: DataFrame, two: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """file, ordinal, begin, end and status of the records in which two trees differ.

    status is ``differs``, or ``missing`` and ``added`` for what only the first or the second has.
    All nodes of the highest level that both trees have are compared, which covers all files of
    both; below it only children of nodes that differ.
    """
    top = min(tree.agg(F.max("level").alias("top")).first()["top"] or 0 for tree in (one, two))
    parents = None
    for level in range(top, -1, -1):
        a, b = (
            tree.where(F.col("level") == level).select(
                "file", "node", F.col("begin").alias(f"begin_{n}"), F.col("end").alias(f"end_{n}"), F.col("hash").alias(f"hash_{n}")
            )
            for n, tree in (("a", one), ("b", two))
        )
        if parents is not None:
            asked = parents.select("file", F.col("node").alias("parent"))
            a, b = (
                x.withColumn("parent", F.expr(f"node div {fanout}")).join(asked, ["file", "parent"], "left_semi").drop("parent")
                for x in (a, b)
            )
        parents = stored(a.join(b, ["file", "node"], "full").where("NOT (hash_a <=> hash_b)"), f"differ-{level}")
    status = F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "added").otherwise("differs")
    return parents.select(
        "file",
        F.col("node").alias("ordinal"),
        F.coalesce("begin_a", "begin_b").alias("begin"),
        F.coalesce("end_a", "end_b").alias("end"),
        status.alias("status"),
    )


def audit(spark: SparkSession, one: str, two: str, fanout: int = FANOUT) -> DataFrame:
    """All records of the replica ``one`` as ``scan_warc`` has them, with status: ``intact`` or that of ``mismatches``.

    Records that only ``two`` has are rows without length, record_id and sha256. Without records
    on either side there are no rows.
    """
    scans = [stored(scan_warc(spark, path), "records") for path in (one, two)]
    found = stored(mismatches(*[merkle_tree(scan, fanout) for scan in scans], fanout), "mismatches")
    found = found.select("file", "ordinal", "begin", "status")
    return scans[0].join(found, ["file", "ordinal"], "full").select(
        "file",
        "ordinal",
        F.coalesce("offset", "begin").alias("offset"),
        "length",
        "record_id",
        "sha256",
        F.coalesce("status", F.lit("intact")).alias("status"),
    )
