import hashlib
import random
import re

from matchlake.llm import cuckoo
from matchlake.llm.cuckoo import CuckooIndex
from matchlake.llm.common import stored


def digest(n):
    return hashlib.sha256(str(n).encode()).digest()


def test_index_follows_insertions_and_deletions():
    random.seed(5)
    index, live = CuckooIndex(buckets=2), {}
    for _ in range(20_000):
        n = random.randrange(3000)
        if random.random() < 0.6:
            index.add(digest(n), n)
            live[n] = live.get(n, 0) + 1
        else:
            assert index.remove(digest(n)) == (n in live)
            if n in live:
                live[n] -= 1
                if not live[n]:
                    del live[n]
    assert len(index) == len(live)
    for n in range(3000):
        number = index.find(digest(n))
        assert (number is not None) == (n in live)
        assert number is None or index.live[number] == live[n]


def test_false_hits_are_verified_and_overflow_grows():
    index = CuckooIndex(buckets=1)
    for n in range(5000):
        index.add(digest(n), n)
    assert index.buckets * cuckoo.SLOTS >= 5000
    same_print = digest(1)[:10] + bytes(22)  # same fingerprint and buckets, other content
    assert index.find(same_print) is None
    index.add(same_print, 9)
    assert index.kept[index.find(same_print)] == 9 and index.kept[index.find(digest(1))] == 1


def test_restored_index_is_the_same():
    index = CuckooIndex(buckets=4)
    for n in range(500):
        index.add(digest(n), n)
    again = CuckooIndex()
    for row in index.rows():
        again.restore(row)
    assert again.prints == index.prints and all(again.find(digest(n)) is not None for n in range(500))
    assert again.find(digest(501)) is None


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub("[ \t-\r]+", " ", text or ""), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        normal = re.sub("[ \t-\r]+", " ", text or "")
        ids = [x for x in groups[normal] if x is not None]
        keep = min(ids) if ids else None
        out.append((doc_id, keep, len(groups[normal]), doc_id == keep, hashlib.sha256(normal.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_duplicates_against_grouping(frame, rows):
    texts = [(9, "a  b"), (2, "a\tb"), (2, "a\tb"), (5, None), (4, ""), (None, "c"), (None, "a b"), (7, " a b"), (8, "x y"), (1, "long " * 100_000)]
    texts += [(100 + n, "hot") for n in range(300)]
    docs = frame([(*t, 1, 2) for t in texts], "doc_id long, text string, digest int, kept int").repartition(5)
    got = cuckoo.duplicates(docs)
    assert "digest" in got.columns
    assert rows(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == expected(texts)


def test_duplicates_of_an_empty_table(frame):
    assert cuckoo.duplicates(frame([], "doc_id long, text string")).collect() == []


def test_index_is_updated_from_its_table(spark, frame):
    def digests(pairs):
        return frame([(d, bytearray(digest(t))) for d, t in pairs], "doc_id long, digest binary")

    first = stored(cuckoo.update(3, added=digests([(n, n % 50) for n in range(100)])), "index")
    assert first.count() == 50 and first.agg({"live": "sum"}).first()[0] == 100
    second = cuckoo.update(3, first, digests([(1000, 7), (1001, 77)]), digests([(0, 0), (50, 0), (8, 8), (1, 999)]))
    live = {bytes(r["digest"]): (r["keep_id"], r["live"]) for r in second.collect()}
    assert digest(0) not in live and live[digest(7)] == (7, 3) and live[digest(77)] == (1001, 1)
    assert live[digest(8)] == (8, 1) and len(live) == 50
