import random

import numpy as np
import pytest

from matchlake.llm import near_dedup
from matchlake.llm.common import stored
from matchlake.llm.near_dedup import Shingler, Similarity, components, near_duplicates


def sets_of(rows, size):
    sets = {}
    for doc_id, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        shingles = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets[doc_id] = shingles
    return sets


def expected(rows, size, percent):
    """Smallest id reachable over all pairs that are similar on their full sets."""
    sets = sets_of(rows, size)
    label = {d: d for d in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) > 0]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d]) for d in sets}


def made(seed, groups=6):
    """Groups of copies around the threshold, exact copies and loners."""
    pick, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{pick.randrange(5000)}" for _ in range(pick.randint(30, 120))]
        for _ in range(pick.randint(1, 14)):
            text = list(base)
            for _ in range(pick.randint(0, 4)):
                text[pick.randrange(len(text))] = f"x{pick.randrange(5000)}"
            rows.append((len(rows), pick.choice([" ", "\n", "  "]).join(text).upper() if g % 2 else " ".join(text)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \t"), (len(rows) + 3, "one"), (len(rows) + 4, "ONE"), (len(rows) + 5, "one two")]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_against_all_pairs(frame, size, percent):
    rows = made(size)
    docs = frame([(*r, 1) for r in rows], "doc_id long, text string, node int").repartition(4)
    got = near_duplicates(docs, Similarity(words=size, percent=percent)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected(rows, size, percent)


def test_chunks_of_a_large_bucket_lose_no_link(frame, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 300)
    pick = random.Random(9)
    base = [f"w{n}" for n in range(100)]
    rows = []
    for n in range(70):
        text = list(base)
        for _ in range(pick.randint(0, 5)):
            text[pick.randrange(100)] = f"x{pick.randrange(9999)}"
        rows.append((n, " ".join(text)))
    got = near_duplicates(frame(rows, "doc_id long, text string"), Similarity(words=3, percent=85)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected(rows, 3, 85)


def test_one_of_each_group_stays_with_its_columns(frame):
    text = " ".join(f"w{n}" for n in range(60))
    rows = [(5, text, 1), (3, text + " end", 2), (3, text + " end", 2), (9, "other", 3), (None, text, 4), (None, text, 5), (7, None, 6), (8, None, 7)]
    docs = frame(rows, "doc_id long, text string, label int")
    got = near_dedup.without_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = sorted(map(repr, map(tuple, got.collect())))
    assert kept == sorted(map(repr, [rows[1], rows[3], *rows[4:]]))


def test_rows_of_one_id_are_judged_by_their_own_texts(frame):
    texts = {name: " ".join(f"{name}{n}" for n in range(60)) for name in "abc"}
    copy = [(1, texts["a"]), (5, texts["a"]), (5, texts["b"]), (5, texts["c"]), (5, texts["c"] + " end"), (5, texts["b"]), (6, texts["b"] + " end")]
    docs = frame([*copy, (5, ""), (5, None), (1, texts["c"] + "  more")], "doc_id long, text string")
    for tasks in (1, 5):
        kept = near_dedup.without_near_duplicates(docs.repartition(tasks)).collect()
        assert sorted((r["doc_id"], (r["text"] or "-")[:1]) for r in kept) == [(1, "a"), (1, "c"), (5, "-"), (5, "-"), (5, "b")]


def test_empty_table(frame):
    none = frame([], "doc_id long, text string")
    assert near_duplicates(none).collect() == [] and near_dedup.without_near_duplicates(none).collect() == []


def test_very_long_text(frame):
    rows = [(1, "long text " * 100_000), (2, "long text " * 100_000 + "end")]
    got = near_duplicates(frame(rows, "doc_id long, text string"), Similarity(words=1, percent=60)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1)}


def test_components_of_chains_and_stars(frame):
    pick = random.Random(4)
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(500, n) for n in range(501, 560)]
    edges = chain + star + [(7, 7), (2, 1), (1, 2)]
    pick.shuffle(edges)
    got = {r["node"]: r["label"] for r in components(frame(edges, "a long, b long")).collect()}
    assert got == {n: 100 for n in range(101, 161)} | {n: 500 for n in range(501, 560)} | {2: 1}


def test_signatures_estimate_similarity():
    shingler = Shingler(Similarity(words=1))
    a, b = (shingler(" ".join(f"w{n}" for n in range(lo, lo + 400))) for lo in (0, 80))
    equal = (shingler.signature(a) == shingler.signature(b)).mean()
    assert abs(equal - 320 / 480) < 0.15


@pytest.mark.parametrize("percent", [30, 50, 60, 80, 85, 95, 100])
def test_bands_keep_to_the_stated_probability(percent):
    how = Similarity(percent=percent)
    assert (1 - (percent / 100) ** how.rows) ** how.bands <= how.unmet <= 1.5e-5
    assert Similarity(percent=85).bands == 24 and Similarity(percent=80, bands=20, rows=5).bands == 20


def test_pruning_keeps_to_the_miss_probability():
    how = Similarity(percent=80, miss=1e-3)
    for n, least in how.least:
        equal = np.random.default_rng(n).beta(1, 1, 200_000)
        similar = equal[equal >= 0.8]
        matches = np.random.default_rng(n + 1).binomial(n, similar)
        assert (matches < least).mean() < 0.01


def test_components_that_are_stars_already_are_not_worked_on(frame, monkeypatch):
    written = []
    monkeypatch.setattr(near_dedup, "stored", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    star = [(1, n) for n in range(2, 30)] + [(41, 40)]
    assert sorted(map(tuple, components(frame(star, "a long, b long")).collect())) == [*((n, 1) for n in range(2, 30)), (41, 40)]
    assert written == ["links"]
    assert sorted(map(tuple, components(frame([(1, 2), (2, 3), (3, 4)], "a long, b long")).collect())) == [(2, 1), (3, 1), (4, 1)]


def test_a_shingler_keeps_no_words_and_gives_sorted_sets():
    shingler = near_dedup.Shingler(near_dedup.Similarity(words=2, percent=80))
    before = dict(vars(shingler))
    text = " ".join(f"w{i % 700}" for i in range(3000))
    found = shingler(text)
    assert vars(shingler) == before
    assert len(found) == 700 and (found[1:] > found[:-1]).all()
    assert (found == shingler(text.upper())).all() and not len(shingler(None)) and len(shingler("w")) == 1
