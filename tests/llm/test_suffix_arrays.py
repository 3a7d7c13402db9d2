import random
import re

import numpy as np
import pytest

from matchlake.llm import suffix_arrays
from matchlake.llm.suffix_arrays import Items, _searched, matches, suffix_array, words_of


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(text, items, window):
    """Hit places and the items with occurring windows, by comparing every window with every place."""
    doc, hit, found = words(text), set(), set()
    for item_id, item in items:
        item = words(item)
        n = min(window, len(item))
        for j in range(len(item) - n + 1 if item else 0):
            for p in range(len(doc) - n + 1):
                if doc[p : p + n] == item[j : j + n]:
                    hit |= set(range(p, p + n))
                    found.add(item_id)
    return len(doc), len(hit), found


def made(seed, documents=60, items=12):
    pick = random.Random(seed)
    vocabulary = ["a", "b", "C", "d9", "é", "日本"]
    passages = [[pick.choice(vocabulary) for _ in range(pick.randint(1, 14))] for _ in range(items)]
    texts = []
    for _ in range(documents):
        text = [pick.choice([*vocabulary, "unseen", "x"]) for _ in range(pick.randint(0, 30))]
        if pick.random() < 0.5:
            at = pick.randint(0, len(text))
            text[at:at] = pick.choice(passages)
        texts.append(pick.choice([" ", ", ", "\n"]).join(text))
    return texts, [(n, " ".join(p)) for n, p in enumerate(passages)]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("window", [3, 10])
def test_search_against_every_place(seed, window):
    texts, items = made(seed)
    counts, spans, found = _searched([*texts, None, ""], Items(items, window))
    for n, text in enumerate([*texts, None, ""]):
        want = brute(text, items, window)
        assert (counts[n], sum(s["to"] - s["from"] for s in spans[n]), {m["item_id"] for m in found[n]}) == want
        for m in found[n]:  # a longest match is one, and can't be longer
            doc, item = words(text), words(dict(items)[m["item_id"]])
            n_, at, start = m["length"], m["at"], m["item_at"]
            assert doc[at : at + n_] == item[start : start + n_]
            longest = max(k for k in range(len(item) + 1) for j in range(len(item) - k + 1) for p in range(len(doc) - k + 1) if doc[p : p + k] == item[j : j + k])
            assert n_ == longest


def test_suffix_array_is_in_order():
    text = np.random.default_rng(3).integers(0, 4, 300)
    order = suffix_array(text, 300)
    assert [text[p:].tolist() for p in order] == sorted(text[p:].tolist() for p in range(300))


def test_occurrences_are_followed_in_portions(monkeypatch):
    monkeypatch.setattr(suffix_arrays, "AT_ONCE", 7)
    texts, items = made(1)
    _, spans, _ = _searched(texts, Items(items, 3))
    assert [sum(s["to"] - s["from"] for s in x) for x in spans] == [brute(t, items, 3)[1] for t in texts]


@pytest.mark.parametrize("block_words", [20, 1_000_000])
def test_blocks_of_the_benchmark_give_the_same(frame, block_words):
    texts, items = made(11)
    items += [(100, None), (101, "..."), (102, items[0][1]), (None, items[1][1])]
    docs = frame([(n, t, 1, 2) for n, t in enumerate([*texts, None, ""])], "doc_id long, text string, n_words int, block_spans int")
    got = matches(docs.repartition(3), frame(items, "item_id long, text string"), 3, block_words).collect()
    for r in got:
        n, hit, found = brute(r["text"], items, 3)
        assert (r["n_words"], sum(s["to"] - s["from"] for s in r["hit_spans"])) == (n, hit)
        assert {m["item_id"] for m in r["item_matches"]} == found and r["block_spans"] == 2


def test_removal_keeps_clean_rows_and_columns(frame):
    passage = " ".join(f"w{n}" for n in range(12))
    rows = [(1, f"Before {passage.upper()} after", 7), (2, "clean", 8), (2, "clean", 8), (3, None, 9), (None, "", 9)]
    docs = frame(rows, "doc_id long, text string, row int")
    got = suffix_arrays.decontaminated(docs, frame([(1, passage)], "item_id long, text string"))
    assert got.columns == docs.columns and sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()[1:]))


def test_empty_tables_and_long_texts(frame):
    items = frame([(1, "a a a")], "item_id long, text string")
    none = frame([], "doc_id long, text string")
    assert matches(none, items).collect() == []
    one = frame([(1, "a " * 50_000)], "doc_id long, text string")
    assert matches(one, items.limit(0)).first()["hit_spans"] == []
    assert matches(one, items).first()["hit_spans"][0].asDict() == {"from": 0, "to": 50_000}


def test_words():
    assert words_of("Ab-c É9_ß\x00z") == ["ab".encode(), b"c", "É9".encode(), "ß".encode(), b"z"]


def test_copies_of_an_item_come_to_the_driver_once(frame, monkeypatch):
    item, given, init = "one two three four", [], Items.__init__

    def recorded(self, items, window):
        given.append(items)
        init(self, items, window)

    monkeypatch.setattr(Items, "__init__", recorded)
    docs = frame([(1, f"zero {item} five"), (2, "none")], "doc_id long, text string")
    rows = [(1, item)] * 300 + [(2, f"other {n}") for n in range(3)]
    found = [r["item_matches"] for r in matches(docs, frame(rows, "item_id long, text string"), 3, 400).orderBy("doc_id").collect()]
    assert sum(map(len, given)) == 4 and [[m["item_id"] for m in x] for x in found] == [[1], []]
