"""Bounded samples of labelled documents, which the trained operators learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """Texts and labels of at most ``per_class`` rows of each class, and how many rows each class has.

    The rows of ``labels`` with the smallest hashes of their ids are taken, none of them held
    out; NULL ids and labels are left out. A label whose document is missing gives no text, and
    one whose document has several rows the smallest text.
    """
    named = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    open_ = named.select("doc_id", F.col(label).cast("int").alias("label")).where("label IN (0, 1)")
    sizes = {r["label"]: r["count"] for r in open_.groupBy("label").count().collect()}
    chosen = [open_.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]).distinct())  # at most 2 * per_class rows
    texts = docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "label")  # one row per id leaves a task
    rows = texts.agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (str(r["doc_id"]), r["label"], r["text"] or ""))
    return [(r["text"] or "", r["label"]) for r in rows], sizes
