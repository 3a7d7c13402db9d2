import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm.periodic_runs import periodic_runs, planted, runs


def by_definition(words):
    """All lags at every place; longest stretches of a lag that no smaller lag covers."""
    n, found = len(words), []
    for period in range(1, n // 3 + 1):
        begin = 0
        for i in range(period, n + 1):
            if i == n or words[i] != words[i - period]:
                start, length = begin, i - begin
                whole = any(all(words[k] == words[k - q] for k in range(start + q, i)) for q in range(1, period))
                if length >= max(24, 3 * period) and not whole:
                    found.append((start, length, period))
                begin = i - period + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def word_by_word(words):
    """Every earlier occurrence makes its lag's match longer; no contexts and no limits."""
    seen, active, ended = {}, {}, []
    for i in range(len(words) + 1):
        now = {i - j: active.get(i - j, 0) + 1 for j in seen.get(words[i], ())} if i < len(words) else {}
        gone = {lag: m for lag, m in active.items() if lag not in now and m + lag >= max(24, 3 * lag)}
        ended += [(i - m - lag, m + lag, lag) for lag, m in gone.items() if not any(lag % q == 0 and q < lag and gone[q] + q >= m + lag for q in gone)]
        active = now
        if i < len(words):
            seen.setdefault(words[i], []).append(i)
    return sorted(ended, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=5))
def test_runs_equal_their_definition(parts):
    words = [w for period, times in parts for w in period * times]
    assert runs(np.array(words, np.int64)) == by_definition(words) == word_by_word(words)


def test_long_periods_within_others():
    random.seed(3)
    for _ in range(60):
        unit = random.choices(range(50), k=random.randint(1, 70))
        inner = random.choices([0, 1], k=random.randint(1, 4)) * random.randint(6, 20)
        words = random.choices(range(9), k=random.randint(0, 20)) + (unit + inner) * random.randint(1, 5) + unit[: random.randint(0, len(unit))]
        assert runs(np.array(words)) == word_by_word(words)


@pytest.mark.parametrize("words", [[7] * 300_000, [0, 1] * 150_000, list(range(1000)) * 300])
def test_one_run_of_a_very_long_text(words):
    assert [(s, n) for s, n, _ in runs(np.array(words))] == [(0, len(words))]


def test_many_occurrences_without_runs_take_no_squares():
    assert len(runs(np.random.default_rng(1).integers(0, 2, 400_000))) < 100


def test_documents(spark, frame):
    line = "all the same words again "
    texts = [None, "", " \t\n", "x " * 23, "x " * 24, "a\x0bb\x85 " * 30, line * 9 + "end", "é " * 40 + line * 6]
    rows = [(n, text, "r", n) for n, text in enumerate(texts)] + [(None, "y " * 30, "r", 0), (4, "x " * 24, "r", 1)]
    docs = frame(rows, "doc_id long, text string, runs string, n_words int").repartition(2)
    found = periodic_runs(docs).collect()
    assert len(found) == len(rows)
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["n_words"], r["collapsed"]) for r in found}
    assert got[0] == got[1] == got[2] == ([], 0, "")
    assert got[3] == ([], 23, "x " * 22 + "x")
    assert got[4] == ([(0, 24, 1)], 24, "x")
    assert got[5] == ([(0, 60, 2)], 60, "a b\x85")
    assert got[6] == ([(0, 45, 5)], 46, line + "end")
    assert got[7] == ([(0, 40, 1), (40, 30, 5)], 70, "é " + line.strip())
    assert got[None] == ([(0, 30, 1)], 30, "y")


def test_no_documents(spark, frame):
    assert periodic_runs(frame([], "doc_id string, text string")).collect() == []


def test_planted_tails(spark, frame):
    from pyspark.sql import functions as F

    def tailed(doc_id, words):
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 or not n:
            return words
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]

    rows = [(n, "  ".join(f"w{k}" for k in range(n % 97))) for n in range(-50, 800)] + [(None, "a"), (25, None)]
    docs = frame(rows, "doc_id long, text string")
    got = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")).collect()
    for (doc_id, text), row in zip(sorted(rows, key=repr), sorted(map(tuple, got), key=repr), strict=True):
        if doc_id is not None and text is not None:
            assert row[1].split() == tailed(doc_id, text.split())
