"""Benchmark decontamination: test suffixes searched in suffix arrays of the documents.

The words of some documents make up a shard, of which a task builds the suffix array. Every
suffix of a benchmark item that has a window's length is looked up there by binary search;
the suffixes that share its window are where it occurs verbatim, and each occurrence is
followed to its full length. Words that no item has end every match, so stretches between
them that are shorter than the shortest window stay out of the array.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import fresh, stored

#: Words of items that one broadcast holds, unless its only item has more.
BLOCK_WORDS = 2_000_000
#: Bytes of text in a shard, unless its only document has more.
SHARD_BYTES = 8_000_000
#: Occurrences that are followed at a time.
AT_ONCE = 1_000_000

#: Lower-cases A-Z; ASCII other than letters and digits becomes a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return (text or "").encode().translate(_LETTERS).split()


class Items:
    """A block of benchmark items: their words as numbers, and the windows to look for."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        texts = [(item_id, words) for item_id, text in items if (words := words_of(text))]
        self.ids = [item_id for item_id, _ in texts]
        self.numbers = {w: n for n, w in enumerate(sorted({w for _, words in texts for w in words}), 1)}
        self.words = np.array([self.numbers[w] for _, words in texts for w in words], np.int64)
        lengths = np.array([len(words) for _, words in texts], np.int64)
        self.ends = np.cumsum(lengths)
        starts = [np.arange(e - n, e - min(window, n) + 1) for e, n in zip(self.ends, lengths, strict=True)]
        self.item = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        self.starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.windows = np.minimum(window, lengths)[self.item] if texts else np.empty(0, np.int64)
        self.shortest = int(self.windows.min()) if texts else 0
        self.longest = int(lengths.max()) if texts else 0


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in the order of their first ``depth`` words, by prefix doubling."""
    order = np.argsort(words, kind="stable")
    rank, known = _ranks(words, order), 1
    while known < depth and rank.max(initial=0) < len(words) - 1:
        key = rank * (len(words) + 1)
        key[: len(words) - known] += rank[known:] + 1
        order = np.argsort(key, kind="stable")
        rank, known = _ranks(key, order), 2 * known
    return order


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(key), np.int64)
    ordered = key[order]
    rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) if len(key) else 0
    return rank


def _search(text: np.ndarray, array: np.ndarray, items: Items, after: bool) -> np.ndarray:
    """Binary search of all windows at once: how many suffixes come before (with ``after``, not after) each."""
    low, high = np.zeros(len(items.starts), np.int64), np.full(len(items.starts), len(array), np.int64)
    while (open_ := np.nonzero(low < high)[0]).size:
        middle = (low[open_] + high[open_]) // 2
        order, place = np.zeros(len(open_), np.int64), array[middle]
        for k in range(int(items.windows.max())):
            same = np.nonzero((order == 0) & (items.windows[open_] > k))[0]
            if not same.size:
                break
            at = place[same] + k
            word = np.where(at < len(text), text[np.minimum(at, len(text) - 1)], 0)
            order[same] = np.sign(word - items.words[items.starts[open_[same]] + k])
        right = order <= 0 if after else order < 0
        low[open_] = np.where(right, middle + 1, low[open_])
        high[open_] = np.where(right, high[open_], middle)
    return low


def occurrences(text: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Test suffixes, places in ``text`` and lengths of all longest verbatim matches of a window or more.

    ``text`` has the numbers of words, and 0 where no match goes on. A match that goes on to
    the left is left to the suffix that starts there.
    """
    if not len(text) or not len(items.starts):
        return
    array = suffix_array(text, items.longest)
    low, high = (_search(text, array, items, after) for after in (False, True))
    found = np.nonzero(high > low)[0]
    begin = 0
    while begin < len(found):
        sums = np.cumsum((high - low)[found[begin:]])
        end = begin + max(1, int(np.searchsorted(sums, AT_ONCE, "right")))
        some = found[begin:end]
        begin, counts = end, (high - low)[some]
        test = np.repeat(some, counts)
        within = np.arange(len(test)) - np.repeat(np.cumsum(counts) - counts, counts)
        place, start = array[low[test] + within], items.starts[test]
        first = (test == 0) | (items.item[test - 1] != items.item[test])
        left = ~first & (place > 0) & (text[place - 1] == items.words[start - 1])
        test, place, start = test[~left], place[~left], start[~left]
        length, end_of_item = items.windows[test].copy(), items.ends[items.item[test]]
        going = np.arange(len(test))
        while going.size:
            at, word = place[going] + length[going], start[going] + length[going]
            more = (at < len(text)) & (word < end_of_item[going])
            more[more] = text[at[more]] == items.words[word[more]]
            going = going[more]
            length[going] += 1
        yield test, place, length


def _searched(texts: list[str | None], items: Items) -> tuple[list[int], list[list[dict]], list[list[dict]]]:
    """Per document: its words, its hit stretches of words, and for each item its longest match."""
    numbers, counts = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        numbers.append(np.fromiter(map(items.numbers.get, words, repeat(0)), np.int64, len(words)))
        numbers.append(np.zeros(1, np.int64))  # nothing matches across documents
    whole = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
    firsts = np.cumsum(np.array(counts, np.int64) + 1) - np.array(counts, np.int64) - 1
    # Stretches of known words that a window fits into, each with the 0 after it.
    known = np.concatenate(([0], (whole > 0).astype(np.int8), [0]))
    begins, ends = np.nonzero(np.diff(known) == 1)[0], np.nonzero(np.diff(known) == -1)[0]
    fits = ends - begins >= max(1, items.shortest)
    begins, sizes = begins[fits], ends[fits] - begins[fits] + 1
    origin = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    best: list[dict[int, tuple]] = [{} for _ in texts]
    edges = np.zeros(len(whole) + 1, np.int64)
    for test, place, length in occurrences(whole[origin], items):
        at = origin[place]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
        doc = np.searchsorted(firsts, at, "right") - 1
        item = items.item[test]
        order = np.lexsort((at, -length, item, doc))
        new = np.concatenate(([True], (np.diff(doc[order]) != 0) | (np.diff(item[order]) != 0)))
        for x in order[new] if len(order) else []:
            match = (-int(length[x]), int(at[x] - firsts[doc[x]]), int(items.starts[test[x]]))
            best[doc[x]][item[x]] = min(match, best[doc[x]].get(item[x], match))
    hit = np.concatenate(([0], (np.cumsum(edges) > 0).astype(np.int8)))
    spans: list[list[dict]] = [[] for _ in texts]
    for a, b in zip(np.nonzero(np.diff(hit) == 1)[0], np.nonzero(np.diff(hit) == -1)[0], strict=True):
        doc = int(np.searchsorted(firsts, a, "right")) - 1
        spans[doc].append({"from": int(a - firsts[doc]), "to": int(b - firsts[doc])})
    sizes_of = np.diff(np.concatenate(([0], items.ends)))
    found = [
        [
            {"item_id": items.ids[i], "length": -n, "at": at, "item_at": start - int(items.ends[i] - sizes_of[i])}
            for i, (n, at, start) in sorted(matches.items())
        ]
        for matches in best
    ]
    return counts, spans, found


def item_blocks(benchmark: DataFrame, block_words: int) -> int:
    """Number of blocks that keep the items of each to about ``block_words``."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))
    return max(1, -(-(benchmark.agg(F.sum(words).alias("n")).first()["n"] or 0) // block_words))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, hit_spans and item_matches against all items of ``benchmark``.

    Needs text in ``docs``, and item_id and text in ``benchmark``; columns of the new names are
    replaced, all others stay. hit_spans are the stretches of words inside any occurrence of
    ``window`` consecutive words of an item, or of a whole item that is shorter; item_matches
    has an item's longest match (length, at: the place in the document, item_at: in the item),
    the first one on ties. NULL texts have no words; items without words match nothing, and
    repeated rows of the benchmark count once. It is searched in blocks, each of which is
    broadcast and goes over all documents.
    """
    docs = docs.drop("n_words", "hit_spans", "item_matches")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    benchmark = stored(benchmark.select("item_id", "text").distinct(), "items")
    blocks = item_blocks(benchmark, block_words)
    of_block = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(blocks))
    span = "array<struct<`from`:bigint,`to`:bigint>>"
    match = f"array<struct<item_id:{kind},length:bigint,at:bigint,item_at:bigint>>"
    for block in range(blocks):
        rows = sorted(benchmark.where(of_block == block).collect(), key=repr)  # about block_words
        names = [fresh(docs, x) for x in ("n_words", "block_spans", "block_matches")]
        extra = f"{names[0]} bigint, {names[1]} {span}, {names[2]} {match}"
        docs = _one_block(docs, Items([tuple(r) for r in rows], window), extra)
        if block:
            n, spans, found = names
            both = F.concat(F.col("hit_spans"), F.col(spans))
            docs = docs.withColumns({"hit_spans": _merged(both), "item_matches": F.concat("item_matches", F.col(found))})
            docs = docs.drop(n, spans, found)
        else:
            docs = docs.withColumnsRenamed(dict(zip(names, ("n_words", "hit_spans", "item_matches"), strict=True)))
        if blocks > 1:
            docs = stored(docs, "matches")
    return docs


def _merged(spans: Column) -> Column:
    """Spans that overlap or touch as one, in order."""

    def join(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["from"].alias("from"), F.greatest(last["to"], span["to"]).alias("to"))
        touches = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["to"] >= span["from"])
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), join)


def _one_block(docs: DataFrame, items: Items, extra: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(extra)
    arrow, held = to_arrow_schema(added), docs.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            full = np.arange(SHARD_BYTES, sizes.sum() + SHARD_BYTES, SHARD_BYTES)
            cuts = np.searchsorted(np.cumsum(sizes), full, "right")
            bounds = sorted({0, *map(int, cuts), batch.num_rows})
            for a, b in zip(bounds, bounds[1:], strict=False):
                found = _searched(text.slice(a, b - a).to_pylist(), held.value)
                new = [pa.array(x, f.type) for x, f in zip(found, arrow, strict=True)]
                rows = batch.slice(a, b - a).columns
                yield pa.RecordBatch.from_arrays([*rows, *new], schema=pa.schema([*batch.schema, *arrow]))

    return docs.mapInArrow(search, StructType([*docs.schema.fields, *added.fields]))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs; all columns stay."""
    row = "row"
    packed = docs.select(F.col("text"), F.struct("*").alias(row))
    return matches(packed, benchmark, window).where(F.size("hit_spans") == 0).select(f"{row}.*")
