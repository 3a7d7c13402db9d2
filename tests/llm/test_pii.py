import hashlib
import random
import re
import time
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from matchlake.llm import pii
from matchlake.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def long_text(n):
    """Texts on which careless patterns take quadratic time or deep recursion."""
    return ["9" * n, "a." * n, "1 " * n, "+1" + " " * n, "a@" + "b." * n + "c", "1." * (n // 4) + "x", "+1" * n]


def made():
    pick = random.Random(3)
    parts = ["a", "b.c", "@", "x@y.co", "_", ".", "1", "255", "256.1", "1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112"]
    parts += ["+1 (555) 555-1234", "+49", " ", "-", "é", "日", "(", "%", "call 555-123-4567", "me at home dot com", "+", "007.08.9.10"]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 20))) for _ in range(1500)]
    return [*texts, None, "", *(long_text(2000))]


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pii")
    rows = [(n, t, "x", 1) for n, t in enumerate(made())]
    schema = "doc_id long, text string, spans string, candidates int"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return {r["doc_id"]: r for r in QUERIES["op3_weak_supervision_pii"](spark, str(folder)).collect()}


def test_base_spans_are_those_of_the_plain_patterns(found):
    for n, text in enumerate(made()):
        want = base(text)
        got = found[n]
        assert [got[f"n_{k}"] for k in PLAIN] == [sum(s.startswith(f"{k}:") for s in want) for k in PLAIN], text
        assert got["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()


def test_added_spans_are_ordered_and_overlap_no_other(found):
    added = 0
    for n, text in enumerate(made()):
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in found[n]["spans"].split(",") if s)]
        assert spans == sorted(spans, key=lambda s: (list(PLAIN).index(s[0]), s[1:]))
        written = {f"{k}:{a}:{b}" for k, a, b in spans}
        known = set(base(text))
        assert known <= written
        for k, a, b in (s for s in spans if f"{s[0]}:{s[1]}:{s[2]}" not in known):
            added += 1
            assert "555-123-4567" in text[a:b] or "home dot com" in text[a:b] or "555) 555-1234" in text[a:b] or k == "card"
            assert not any(x < b and a < y for key, x, y in spans if f"{key}:{x}:{y}" in known)
    assert added > 20


def test_very_long_texts(frame):
    rows = list(enumerate([*long_text(100_000), "x " * 200_000 + "me@a.org"]))
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(rows, "doc_id long, text string")).collect()}
    assert [len([s for s in got[n] if s["kind"] == "email"]) for n in (0, 1, 4, 7)] == [0, 0, 1, 1]
    assert got[7][0]["begin"] == 400_000 and got[7][0]["match"] == "me@a.org" and len([s for s in got[5] if s["base"]]) == 6250


def test_texts_without_candidates_and_empty_tables(frame):
    docs = frame([(1, "nothing", 1), (2, None, 2)], "doc_id long, text string, row_id int")
    got = pii.personal_data(docs)
    assert got.columns == ["doc_id", "row_id", "spans"] and all(r["spans"] == [] for r in got.collect())
    assert pii.personal_data(docs.limit(0)).collect() == []


def test_repeated_rows_keep_their_own_spans(frame):
    rows = [(1, "mail me at x@y.org now"), (1, "mail me at x@y.org now"), (None, "x@y.org")]
    got = pii.personal_data(frame(rows, "doc_id long, text string")).collect()
    assert sorted(len(r["spans"]) for r in got) == [1, 1, 1]


def test_reliabilities_tell_good_labelers_from_bad_ones(frame):
    pick, rows = random.Random(8), []
    for _ in range(4000):
        real = pick.random() < 0.4
        good = [(1 if real else -1) * (1 if pick.random() < 0.95 else -1) for _ in range(3)]
        rows.append(("email", *good, 0, pick.choice([-1, 0, 1]), pick.choice([-1, 1])))
    names = [f"vote_{k}" for k in pii.LABELERS]
    df = frame(rows, "kind string, " + ", ".join(f"{c} int" for c in names)).groupBy("kind", *names).agg(F.count(F.lit(1)).alias("n"))
    known = pii.reliabilities(df)["email"]
    assert known["share"] == pytest.approx(0.4, abs=0.03)
    assert known["rates"]["vote_form", 1][0] == pytest.approx(0.95, abs=0.03)
    assert known["rates"]["vote_around", 1][0] == pytest.approx(0.5, abs=0.05)


def test_luhn(frame):
    numbers = ["4111111111111111", "4111111111111112", "0", "18", "79927398713", ""]
    got = frame([(n,) for n in numbers], "n string").select(pii.luhn(F.col("n"))).collect()
    assert [r[0] for r in got][:5] == [luhn(n) for n in numbers][:5]


def test_many_matches_in_one_text(frame):
    text = " ".join(f"x{n}" for n in range(400_000)) + " a@b.co" * 50_000 + " call 555-123-4567," * 50_000
    start = time.monotonic()
    spans = pii.personal_data(frame([(1, text)], "doc_id long, text string")).first()["spans"]
    assert time.monotonic() - start < 60
    got = [f"{s['kind']}:{s['begin']}:{s['end']}" for s in spans if s["base"]]
    assert got == base(text) and len(got) == 50_000 and all(text[s["begin"] : s["end"]] == s["match"] for s in spans)


def test_running_totals(frame):
    lists = [[], [5], [3, 1, 4, 1, 5, 9, 2, 6], list(range(1000, 0, -1))]
    both = [F.transform(F.array("n"), lambda n: pii.running(n, lambda x, y: x + y)), F.transform(F.array("n"), lambda n: pii.running(n, F.greatest))]
    for values, row in zip(lists, frame([(n,) for n in lists], "n array<int>").select("n", *both).collect(), strict=True):
        assert row[1][0] == list(accumulate(values)) and row[2][0] == list(accumulate(values, max))


def brute_added(added, base_spans):
    done = []
    for span in sorted(added):
        if not any(b < span[1] and span[0] < e for b, e in base_spans) and not (done and done[-1][1] > span[0]):
            done.append(span)
    return done


def test_overlaps_against_all_pairs(frame):
    pick, rows = random.Random(4), []
    for _ in range(300):
        spans = [sorted(pick.sample(range(60), 2)) for _ in range(pick.randint(0, 24))]
        cut = pick.randint(0, len(spans))
        rows.append(([(b, e, "ip", False, 0.95, "") for b, e in spans[:cut]], [(b, e, "ip", True, 1.0, "") for b, e in spans[cut:]]))
    df = frame(rows, f"added {pii._ADDED}, base {pii._ADDED}")
    kept = df.select("added", "base", pii._first(F.array_sort(pii._clear(F.col("added"), F.col("base")))).alias("kept")).collect()
    for (added, base_spans), row in zip(rows, kept, strict=True):
        want = brute_added([s[:2] for s in added], [s[:2] for s in base_spans])
        assert [(s["begin"], s["end"]) for s in row["kept"]] == want
