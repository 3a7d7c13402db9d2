import math

import pytest

from matchlake.llm import mixing
from matchlake.llm.common import placed

SCHEMA = "doc_id long, text string, source string"


def levels(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = sum(w for s, w in weight.items() if s not in capped)
        share = {s: left * w / open_ for s, w in weight.items() if s not in capped} if open_ else {}
        above = {s for s, x in share.items() if x > most * sizes[s]}
        if not above:
            return {s: share.get(s, most * sizes[s]) for s in sizes}
        capped |= above


def rows_of(counts):
    rows, n = [], 0
    for source, texts in counts.items():
        for words in texts:
            rows.append((n, " ".join(["w"] * words) if words is not None else None, source))
            n += 1
    return rows


def test_targets_and_taken_words(spark, frame):
    counts = {"b": [10, 20, 30, 40] * 20, "a": [3, 5, 0] * 5, None: [7] * 30, "Z": [100, 1, 1, 1], "ä": [None, None]}
    rows = rows_of(counts)
    got = mixing.copies(frame(rows, SCHEMA)).collect()
    sizes = {s: sum(x or 0 for x in texts) for s, texts in counts.items()}
    want = levels(sizes)
    assert len(got) == len(rows)
    for source in counts:
        own = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == sizes[source] and math.isclose(r["target"], want[source]) for r in own)
        assert all(0 <= r["copies"] <= 3 for r in own)
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - want[source]) <= max([x or 0 for x in counts[source]], default=0) * 2


def test_copies_are_the_crossings_of_the_staircase(frame):
    rows = rows_of({"x": [5] * 7 + [3] * 6, "y": [50] * 9, "z": [1] * 300})
    got = mixing.copies(frame(rows, SCHEMA), seed=3).orderBy("source", mixing.F.desc("size"), "doc_id").collect()
    for source in "xyz":
        own = [r for r in got if r["source"] == source]
        rate = own[0]["target"] / own[0]["source_size"]
        total = sum(r["copies"] for r in own)
        assert math.floor(rate * len(own)) <= total <= math.ceil(rate * len(own))
        for k in range(len(own)):  # any stretch holds its share, to one copy
            for j in range(k + 1, len(own) + 1):
                assert abs(sum(r["copies"] for r in own[k:j]) - rate * (j - k)) < 1 + 1e-3


def test_mix_repeats_rows_and_keeps_all_columns(spark, frame):
    rows = [(1, "a b", "s", 1, 2), (1, "a b", "s", 1, 2), (2, "", "s", 1, 2), (None, None, None, 1, 2), (3, "w " * 50, "t", 5, 6)]
    docs = frame(rows, "doc_id long, text string, source string, size int, copies int")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    again = sorted(map(repr, mixing.mix(docs.repartition(3)).collect()))
    assert sorted(map(repr, mixed.collect())) == again
    assert {r["size"] for r in mixed.collect()} <= {1, 5}


def test_empty_table(frame):
    assert mixing.copies(frame([], SCHEMA)).collect() == []
    assert mixing.mix(frame([], SCHEMA)).collect() == []


def test_places_of_ties_and_nulls(frame):
    df = frame([(x,) for x in [3, None, 1, 1, 2, None]], "v int")
    got = placed(df, [mixing.F.col("v").asc_nulls_last()], "place").orderBy("place").collect()
    assert [tuple(r) for r in got] == [(1, 0), (1, 1), (2, 2), (3, 3), (None, 4), (None, 5)]


def test_very_long_text(frame):
    got = mixing.copies(frame([(1, "word \t\n" * 300_000, "a")], SCHEMA)).first()
    assert got["size"] == 300_000 and got["copies"] == 1


@pytest.mark.parametrize("sizes", [{"a": 0, "b": 0}, {"a": 10}, {"a": 1, "b": 1000, "c": 5}])
def test_targets_by_resharing(frame, sizes):
    got = {r["source"]: r["target"] for r in mixing.targets(frame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(levels(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes})
