"""Byte-pair encoding through a lexicon of the corpus's common words, and decoding.

The lexicon is a minimal acyclic automaton: words with equal endings share the states of
those endings. It is a transducer, as each arc adds the number of words that the arcs before
it accept; the sum along a word is its place among all words, where its ids lie. All parts
are arrays of one file, which each executor fetches once and its workers map into memory;
the distinct words of a batch walk through the automaton together, a letter at a time. Words
that aren't in it are merged pair by pair, by rank, exactly as the vocabulary says.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from matchlake.llm.common import by_size, stored
from matchlake.session import shared_folder

#: Words that the lexicon holds at most, and bytes of the longest; together they bound its file.
LEXICON_WORDS, LEXICON_BYTES = 200_000, 48
#: Letters of a text that are cut into words at once.
PORTION = 1 << 18
#: Letters before this one are cut into words by spelled-out classes.
NEAR = 0x180
#: Words outside the lexicon whose ids a worker remembers.
REMEMBERED = 100_000


def byte_letters() -> list[str]:
    """The letter for each byte: printable ones stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, others = [], 0
    for byte in range(256):
        letters.append(chr(byte if byte in plain else 256 + others))
        others += byte not in plain
    return letters


def _unassigned() -> regex.Pattern:
    """Letters that this Python's Unicode tables don't know; newer tables may treat them otherwise."""
    unknown = [c for c in range(0x250, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for c in unknown if c == 0x250 or unicodedata.category(chr(c - 1)) != "Cn"]
    ends = [c for c in unknown if c == 0x10FFFF or unicodedata.category(chr(c + 1)) != "Cn"]
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True)) + "]")


def _near_pattern(pattern: str) -> re.Pattern | None:
    """The pattern with the classes of letters, numbers and white space spelled out for the first letters of Unicode.

    The standard library's patterns are several times as fast. These letters are composed as
    they are, and their lower-case forms are no letters or numbers beyond.
    """
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = "".join(f"\\x{c:02x}" if c < 256 else f"\\u{c:04x}" for c in range(NEAR) if regex.match(name, chr(c)))
        pattern = re.sub(r"\[([^\]]*)\]", lambda m, n=name, x=members: m[0].replace(n, x), pattern)
    return None if re.search(r"\\[a-tv-wyzA-Z]", pattern) else re.compile(pattern)


class Vocabulary:
    """A tokenizers file of lower-case words with word ends: its words, its merges and its letters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        layout = json.loads(self.tokenizer.to_str())
        steps = [(s["type"], s.get("pattern"), s.get("content")) for s in (layout["normalizer"] or {}).get("normalizers", [])]
        split, spell = ((layout["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}])[:2]
        model = layout["model"]
        if not (
            steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
            and (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
            and (spell.get("type"), spell.get("add_prefix_space"), spell.get("use_regex")) == ("ByteLevel", False, False)
            and (model["type"], model["unk_token"], model["dropout"], model["continuing_subword_prefix"]) == ("BPE", None, None, None)
            and layout["decoder"] is None
        ):
            raise ValueError(f"{path}: not a vocabulary of lower-case words with word ends")
        vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        self.inner = [vocab.get(x) for x in self.letters]
        self.last = [vocab.get(x + self.end) for x in self.letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in layout["added_tokens"]}
        self.spelled = {i: x for x, i in (*vocab.items(), *self.special.items())}
        self.special_texts = regex.compile("(" + "|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) + ")")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.near_word = _near_pattern(split["pattern"]["Regex"])
        self.beyond, self.far, self.unassigned = re.compile(f"[^\x00-{chr(NEAR - 1)}]"), re.compile(r"[^\x00-\u024f]"), _unassigned()

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens; all its letters must be assigned."""
        if self.near_word and (text.isascii() or not self.beyond.search(text)):
            return self.near_word.findall(text.lower())
        return self.word.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def known_letters(self, text: str) -> bool:
        return text.isascii() or not self.far.search(text) or not self.unassigned.search(text)

    def merged(self, word: str) -> list[int]:
        """The ids of a word: its letters' ids, merged by the smallest rank, the leftmost of equal ones first.

        A letter that the vocabulary lacks has no id.
        """
        data = word.encode()
        ids = [x for x in (*(self.inner[b] for b in data[:-1]), self.last[data[-1]]) if x is not None] if data else []
        return self._merged_long(ids) if len(ids) > LEXICON_BYTES else self._merged_short(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        """Looks for the best pair again after each merge."""
        best, never = self.merges.get, (len(self.merges), 0)
        pairs = [best(pair, never) for pair in zip(ids, ids[1:], strict=False)]
        while pairs:
            least = min(pairs)
            if least is never:
                break
            at = pairs.index(least)
            ids[at : at + 2] = [least[1]]
            del pairs[at]
            if at:
                pairs[at - 1] = best((ids[at - 1], ids[at]), never)
            if at < len(pairs):
                pairs[at] = best((ids[at], ids[at + 1]), never)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """Keeps the pairs in a heap, so that n letters take n log n steps."""
        merges, after = self.merges, [*range(1, len(ids)), -1]
        before, live = list(range(-1, len(ids) - 1)), [True] * len(ids)
        heap = [(merges[pair][0], at, merges[pair][1], *pair) for at, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in merges]
        heapq.heapify(heap)
        while heap:
            _, at, new, a, b = heapq.heappop(heap)
            right = after[at]
            if not live[at] or right < 0 or ids[at] != a or ids[right] != b:
                continue  # one of the pair was merged elsewhere
            ids[at], live[right], after[at] = new, False, after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    pair = (ids[left], ids[after[left]])
                    if pair in merges:
                        heapq.heappush(heap, (merges[pair][0], left, merges[pair][1], *pair))
        return [x for x, alive in zip(ids, live, strict=True) if alive]


def compiled(words: Iterable[str], ids_of) -> np.ndarray:
    """The lexicon of some words as one array of 64-bit integers: a header, then its parts.

    Words are added in byte order; what the next word doesn't share with the last one is
    finished from its end, where a state with the same finality and arcs is used again.
    """
    entries = sorted({w.encode(): w for w in words}.items())
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs: list[tuple] = []
    path: list[list] = [[False, []]]  # of each open state: whether a word ends in it, and its arcs

    def finish(depth: int, label: bytes) -> None:
        while len(path) > depth + 1:
            final, out = path.pop()
            key = (final, tuple(out))
            if key not in register:
                register[key] = len(finals)
                finals.append(final)
                arcs.append(key[1])
            path[-1][1].append((label[len(path) - 1], register[key]))

    last = b""
    for word, _ in entries:
        shared = next((k for k, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
        finish(shared, last)
        path.extend([False, []] for _ in range(len(word) - shared))
        path[-1][0] = True
        last = word
    finish(0, last)
    root = len(finals)
    finals.append(path[0][0])
    arcs.append(tuple(path[0][1]))

    accepted = []  # words below each state; a state's arcs lead to states before it
    labels, targets, outputs, first = [], [], [], []
    for final, out in zip(finals, arcs, strict=True):
        first.append(len(labels))
        passed = int(final)
        for label, target in out:
            labels.append(label)
            targets.append(target)
            outputs.append(passed)
            passed += accepted[target]
        accepted.append(passed)
    ids = [ids_of(word) for _, word in entries]
    ends = np.cumsum([0, *map(len, ids)])
    sources = np.repeat(np.arange(len(finals)), np.diff([*first, len(labels)]))
    parts = [sources * 256 + np.array(labels, np.int64), targets, outputs, finals, ends, [x for word in ids for x in word]]
    parts = [np.asarray(p, np.int64) for p in parts]
    return np.concatenate([[root, *map(len, parts)], *parts]).astype("<i8")


class Lexicon:
    """The arrays of ``compiled``, looked up for many words at once."""

    def __init__(self, array: np.ndarray):
        self.root, *sizes = array[:7].tolist()
        cuts = np.cumsum([7, *sizes])
        self.keys, self.targets, self.outputs, self.finals, self.ends, self.ids = (array[a:b] for a, b in zip(cuts, cuts[1:], strict=False))

    def places(self, words: pa.Array) -> np.ndarray:
        """Each word's place among the lexicon's, -1 for others; ``words`` are large strings."""
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        found = np.full(len(words), -1, np.int64)
        alive, states, place = np.arange(len(words)), np.full(len(words), self.root), np.zeros(len(words), np.int64)
        lengths, step = np.diff(offsets), 0
        while len(alive):
            done = lengths[alive] == step
            ended = done & (self.finals[states] == 1)
            found[alive[ended]] = place[ended]
            alive, states, place = alive[~done], states[~done], place[~done]
            if not len(alive) or not len(self.keys):
                break
            keys = states * 256 + letters[offsets[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[arc] == keys
            alive, states, place = alive[hit], self.targets[arc[hit]], place[hit] + self.outputs[arc[hit]]
            step += 1
        return found


def common_words(docs: DataFrame, pattern: str, words: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent words of all texts, as far as they have at most 48 bytes: at most ``words``.

    They are those with a count from a bound on, where bounds are eight to a doubling. So what is
    gathered is one row for each of these steps, and the words. This only says what the
    lexicon holds, so it may cut rare letters otherwise than the tokenizer.
    """
    split = F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(0))
    counted = docs.select(F.explode(split).alias("word")).groupBy("word").count().where(F.octet_length("word") <= LEXICON_BYTES)
    counted = stored(counted.select("word", F.floor(8 * F.log2("count")).alias("step")), "words")
    steps = counted.groupBy("step").count()
    down = steps.withColumn("above", F.sum("count").over(Window.orderBy(F.desc("step"))))  # at most 512 rows
    bound = down.where(F.col("above") <= words).agg(F.min("step")).first()[0]
    return counted.where(F.col("step") >= F.lit(bound)).select("word")


def lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> str:
    """Compiles the lexicon of all texts and has Spark bring its file to every executor; returns the file's name.

    The driver gets at most ``words`` words of 48 bytes; the file is below 100 bytes for each of
    their letters. Other words cost more time and give the same ids.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(tokenizer)
    array = compiled([r["word"] for r in common_words(docs, vocabulary.word.pattern, words).collect()], vocabulary.merged)
    name = f"lexicon-{uuid.uuid4().hex}"
    path = f"{shared_folder(spark, 'lexicon')}/{name}"
    _write(spark, path, array.tobytes())
    spark.sparkContext.addFile(path)
    return name


def _write(spark: SparkSession, path: str, data: bytes) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    for at in range(0, len(data), 1 << 20):
        out.write(data[at : at + (1 << 20)])
    out.close()


class Encoder:
    """Ids of texts: common words through the lexicon, the others by merging."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.unseen: dict[str, list[int]] = {}

    def rare(self, word: str) -> list[int]:
        ids = self.unseen.get(word)
        if ids is None:
            ids = self.vocabulary.merged(word)
            if len(self.unseen) < REMEMBERED and len(word) <= LEXICON_BYTES:
                self.unseen[word] = ids
        return ids

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many each has."""
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        places = self.lexicon.places(coded.dictionary)
        ends = self.lexicon.ends
        lengths = np.where(places >= 0, ends[places + 1] - ends[places], 0)
        starts = np.where(places >= 0, ends[places], 0)
        others, more, at = np.flatnonzero(places < 0), [], len(self.lexicon.ids)
        rare = coded.dictionary.take(pa.array(others)).to_numpy(zero_copy_only=False).tolist()
        for word, text in zip(others.tolist(), rare, strict=True):
            ids = self.rare(text)
            starts[word], lengths[word], at = at, len(ids), at + len(ids)
            more.extend(ids)
        pool = np.concatenate((self.lexicon.ids, np.array(more, np.int64))) if more else self.lexicon.ids
        index = coded.indices.to_numpy()
        counts = lengths[index]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return pool[np.repeat(starts[index], counts) + within].astype("<u4"), counts

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        found: list[list] = [[] for _ in texts]
        words: list[str] = []
        spans: list[tuple[int, int, int, int]] = []  # a text, a part of it, and the words from where to where
        letters = 0

        def flush() -> None:
            nonlocal words, spans, letters
            ids, counts = self.ids(words)
            ends = np.concatenate(([0], np.cumsum(counts)))
            for text, part, first, last in spans:
                found[text][part] = ids[ends[first] : ends[last]].tobytes()
            words, spans, letters = [], [], 0

        for n, text in enumerate(texts):
            for piece, special in self._pieces(text):
                if special is not None:
                    found[n].append(np.array([special], "<u4").tobytes())
                elif not self.vocabulary.known_letters(piece):
                    found[n].append(np.array(self.vocabulary.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes())
                else:
                    first = len(words)
                    words += self.vocabulary.words(piece)
                    spans.append((n, len(found[n]), first, len(words)))
                    found[n].append(b"")
                    letters += len(piece)
                    if letters >= PORTION:
                        flush()
        flush()
        return [b"".join(parts) for parts in found]

    def _pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Special tokens with their ids, and what lies between, in parts that end before white space."""
        special = self.vocabulary.special
        for part in self.vocabulary.special_texts.split(text) if any(x in text for x in special) else [text]:
            if part in special:
                yield part, special[part]
                continue
            at = 0
            while len(part) - at > PORTION:
                cut = min((x for x in (part.find(" ", at + PORTION), part.find("\n", at + PORTION)) if x > 0), default=len(part))
                yield part[at:cut], None
                at = cut
            yield part[at:], None


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def _encoder(path: str, name: str) -> Encoder:
    """The worker's encoder: the lexicon's file is mapped, so that workers of a machine share its pages."""
    return Encoder(_vocabulary(path), Lexicon(np.memmap(SparkFiles.get(name), "<i8", "r")))


def encode(docs: DataFrame, tokenizer: str, lexicon_name: str) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id and ids, little-endian unsigned 32-bit integers.

    The ids are those that the tokenizer gives without added special tokens; special tokens
    in a text are one id. NULL and empty texts have no ids; rows of one doc_id are rows of their
    own, also if it is NULL; nothing depends on order, so there are no ties; other columns
    are left out; an empty table gives no rows. Very long texts are cut before white space, so that a
    task holds the words of a part only, and their ids. Parts with letters that Python's
    Unicode tables lack go to the tokenizer itself.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType())])
    arrow = pa.schema([("doc_id", to_arrow_type(kind)), ("ids", pa.binary())])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, lexicon_name)
        for batch in by_size(batches, "text", 1 << 20):
            ids = encoder.texts([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(arrow.field("doc_id").type), pa.array(ids, pa.binary())], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(follow, schema)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text of the ids: the vocabulary's entries, special ones too, with single spaces between.

    An id that the vocabulary lacks is left out. NULL ids give an empty text.
    """
    kind = encoded.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    arrow = pa.schema([("doc_id", to_arrow_type(kind)), ("ids", pa.binary()), ("decoded", pa.string())])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _entries(tokenizer)
        for batch in by_size(batches, "ids", 1 << 20):
            texts = [entries(ids or b"") for ids in batch["ids"].to_pylist()]
            columns = [batch["doc_id"].cast(arrow.field("doc_id").type), batch["ids"], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return encoded.select("doc_id", "ids").mapInArrow(follow, schema)


@cache
def _entries(tokenizer: str):
    """A function from ids to text: takes entries, each with a space after it, from one array of all."""
    spelled = _vocabulary(tokenizer).spelled
    entries = pa.array([f"{spelled[i]} " if i in spelled else "" for i in range(max(spelled) + 1)], pa.large_string())

    def text(ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        taken = entries.take(pa.array(numbers[numbers < len(entries)]))
        end = np.frombuffer(taken.buffers()[1], np.int64)[len(taken)] if len(taken) else 0
        return taken.buffers()[2][: end - 1].to_pybytes() if end else b""

    return text
