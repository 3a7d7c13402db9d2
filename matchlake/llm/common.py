"""Helpers that several operators share: scratch tables, places in an order, and columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlake.session import remove_folder, shared_folder

#: White space that separates words: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to scratch and read again, so that a lost executor repeats nothing before it."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Removes the scratch files that a frame of ``stored`` reads; it can't be used any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def placed(df: DataFrame, order: list[Column], place: str) -> DataFrame:
    """``df`` with each row's place, from 0, in the order of all rows.

    Rows are dealt out by range and sorted in their partitions, then written; what is
    gathered afterwards is one count for each partition. Order columns that many rows
    share are no hot spot as long as later ones tell the rows apart.
    """
    at, part, first = (fresh(df, x) for x in ("at", "part", "first"))
    local = F.monotonically_increasing_id()
    laid = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, local), "placed")
    laid = laid.withColumn(part, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND(2**33 - 1))
    counts = laid.groupBy(part).agg(F.count(F.lit(1)).alias(first))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    return (
        laid.join(F.broadcast(firsts), part)  # a row for each partition
        .withColumn(place, F.col(first) + F.col(at))
        .select(*[F.col(f"`{c}`") for c in df.columns], place)
    )


def in_portions(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of large batches in smaller ones, so that results go back before much text has gathered."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of large batches in smaller ones of about ``most`` bytes in ``column``, at least a row each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes + 16), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, end - at)
            at = end
