"""Periodic runs of words: stretches that repeat themselves with a period, found word by word.

The words of a text are followed in order. A word's earlier occurrences name lags, a lag's
diagonal has a match length that grows while words a lag apart agree, and a diagonal that
ends with a length that suffices is emitted as a run at once. What keeps the diagonals few:

* A run of period q and at least ``max(24, 3q)`` words matches itself over at least
  ``max(24 - q, 2q)`` words, so at least 16. An occurrence only counts when a context of as
  many words agrees. Texts without a repeated context of 16 words have no run.
* Contexts double: 16 words are for periods up to 16, 32 for 17 to 32, and so on. In a run, a
  context of at least q words recurs after q words and not before, because the period would
  not be the smallest otherwise. So the latest occurrence is the only one to look at, each
  context length has at most one active diagonal, and a diagonal's lag is a smallest period.

So a text of n words takes O(n log n) steps, however it repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from matchlake.llm.common import SPACE, by_size

#: A run has at least so many words and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the shortest context: what the shortest runs match of themselves.
CONTEXT = 16

Run = tuple[int, int, int]


def _paired(names: np.ndarray, span: int) -> np.ndarray:
    """Names of contexts of twice the words, by the names of their halves."""
    if len(names) <= span:
        return names[:0]
    both = names[:-span] * (names.max() + 1) + names[span:]
    return np.unique(both, return_inverse=True)[1].astype(np.int64)


def _lags(names: np.ndarray) -> np.ndarray:
    """For each place: how far back the same name was last; 0 where it is new."""
    order = np.argsort(names, kind="stable")
    again = np.flatnonzero(names[order[1:]] == names[order[:-1]])
    lags = np.zeros(len(names), np.int64)
    lags[order[again + 1]] = order[again + 1] - order[again]
    return lags


def _diagonals(lags: np.ndarray, span: int, least: int, most: int) -> Iterator[Run]:
    """Runs of the diagonals with lags from ``least`` to ``most``, each when its diagonal ends."""
    places = np.flatnonzero((lags >= least) & (lags <= most))
    active, matched, last = 0, 0, -2
    for place, lag in zip(places.tolist(), lags[places].tolist(), strict=True):
        if lag == active and place == last + 1:
            matched += 1
        else:
            if matched + active >= max(LEAST_WORDS, LEAST_PERIODS * active):
                yield last + span - matched - active, matched + active, active
            active, matched = lag, span
        last = place
    if matched + active >= max(LEAST_WORDS, LEAST_PERIODS * active):
        yield last + span - matched - active, matched + active, active


def runs(codes: np.ndarray) -> list[Run]:
    """The runs of a sequence of integers as (start, length, period), by start and period."""
    names = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    found: list[Run] = []
    span, least = 1, 1
    while LEAST_PERIODS * least <= len(codes):
        if span >= CONTEXT:
            lags = _lags(names)
            if not lags.any():
                break
            found += _diagonals(lags, span, least, span)
            least = span + 1
        names, span = _paired(names, span), 2 * span
    return sorted(found, key=lambda r: (r[0], r[2]))


def _repetitive(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which documents have a repeated context of 16 words; by hashes, so rarely one too many."""
    lengths = np.diff(starts)
    long = np.flatnonzero(lengths >= LEAST_WORDS)
    if not len(long):
        return long
    hashes = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        span = (len(codes) - len(hashes)) + 1
        hashes = hashes[:-span] * np.uint64(factor) + hashes[span:]
    # Contexts that lie in one document, told apart by document.
    docs = np.repeat(long, lengths[long] - CONTEXT + 1)
    first = np.cumsum(lengths[long] - CONTEXT + 1) - (lengths[long] - CONTEXT + 1)
    places = np.arange(len(docs)) - np.repeat(first - starts[long], lengths[long] - CONTEXT + 1)
    keys = (hashes[places] ^ (hashes[places] >> np.uint64(31))) * np.uint64(0xE7037ED1A0B428DB) + docs.astype(np.uint64)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.unique(docs[np.isin(keys, twice)]) if len(twice) else docs[:0]


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's words start, and the words of all texts one after another."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, offsets = lists.flatten(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
    filled = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    return before[offsets], words.filter(filled)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, runs and collapsed.

    Words are what white space (space and the controls 9 to 13) separates. A run is a longest
    stretch with a smallest period, of at least 24 words and three periods; ``runs`` has their
    start (from 0), length and period by start and period. ``collapsed`` is the text with the
    first period of each run only, its words joined by single spaces. NULL and empty texts have
    no words; equal runs of different periods don't exist, so there are no ties; rows of one
    doc_id are rows of their own, also if doc_id is NULL; other columns are left out; an empty
    table gives no rows. A very long text is held by one task, with about 100 bytes a word.
    """
    kind = docs.schema["doc_id"].dataType
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run))]
        + [T.StructField("collapsed", T.StringType())]
    )
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    arrow = pa.schema([("doc_id", to_arrow_type(kind)), ("n_words", pa.int64()), ("runs", pa.list_(run_type)), ("collapsed", pa.string())])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            starts, words = _words(batch["text"])
            codes = words.dictionary_encode().indices.to_numpy()
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            kept = np.ones(len(codes), bool)
            for doc in _repetitive(codes, starts).tolist():
                at = starts[doc]
                for start, length, period in runs(codes[at : starts[doc + 1]]):
                    found[doc].append({"start": start, "length": length, "period": period})
                    kept[at + start + period : at + start + length] = False
            after = np.concatenate(([0], np.cumsum(kept)))[starts]
            lists = pa.ListArray.from_arrays(after.astype(np.int32), words.filter(pa.array(kept)))
            collapsed = pc.binary_join(lists, pa.scalar(" ", words.type)).cast(pa.string())
            columns = [batch["doc_id"].cast(arrow.field("doc_id").type), pa.array(np.diff(starts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, arrow.field("runs").type), collapsed], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(follow, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """``text``, a tenth of all with a periodic tail, by the checksum h of the decimal id.

    Where ``h % 10 = 0`` and there are words, those from word ``a = g % n`` on repeat the next
    ``p = 1 + (n - a) / (3 + g % 8)`` of them, with ``g = h / 10`` and n words. NULL ids plant nothing.
    """
    checksum = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, g = F.size(words), F.floor(checksum / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((checksum % 10 == 0) & (n > 0), changed).otherwise(text)
