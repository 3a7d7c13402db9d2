import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from matchlake.llm.prefix_trie import PIECE, DoubleArray, prefix_nodes, spliced, turn_lists


def test_double_array_walks_its_sequences_only():
    random.seed(5)
    for _ in range(40):
        wide = random.randint(1, 30)
        sequences = sorted({tuple(random.choices(range(wide), k=random.randint(0, 6))) for _ in range(random.randint(1, 200))})
        trie = DoubleArray([list(s) for s in sequences])
        prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
        states = {}
        for prefix in prefixes:
            walked = trie.walk(list(prefix))
            assert len(walked) == len(prefix) + 1
            states[prefix] = walked[-1]
        assert len(set(states.values())) == len(prefixes) == (trie.check >= 0).sum()
        for prefix in prefixes:
            for turn in range(wide):
                assert (len(trie.walk([*prefix, turn])) == len(prefix) + 2) == ((*prefix, turn) in prefixes)


def by_hand(rows, splice):
    """Nodes of rows (conv_id, turn, role, text) by sets of prefixes."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        turns[conv_id].append((role or "", text or ""))
    convs = dict(turns)
    if splice:
        for c in turns:
            h = zlib.crc32(str(c).encode()) % 6
            convs[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, sequence in convs.items():
        for depth in range(len(sequence) + 1):
            members[tuple(sequence[:depth])].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)

    def below(prefix):
        yield prefix
        for child in children[prefix]:
            yield from below(child)

    found = []
    for prefix, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if tuple(convs[c]) == prefix)
        under = list(below(prefix))
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p)
        parent = min(members[prefix[:-1]]) if prefix else None
        leaves = sum(not children[p] for p in under)
        found.append((min(ids), len(prefix), parent, len(ids), len(children[prefix]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def some_rows(seed):
    random.seed(seed)
    rows = []
    for c in range(600):
        if c % 100 == 0 and c % 300:
            continue
        for turn in range(random.randint(1, 9)):
            rows.append((c, turn, "user" if turn % 2 == 0 else None, random.choice(["", "a", "bb", None, "ccc" * (turn + 1)])))
    return rows


@pytest.fixture
def many_shards(spark):
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "9")
    yield
    for n, value in old.items():
        spark.conf.set(n, value)


SCHEMA = "conv_id long, turn long, role string, text string, turns string, node int, depth int"


def extended(rows):
    return [(*r, "x", 7, 8) for r in rows]


@pytest.mark.parametrize("splice", [True, False])
def test_nodes_over_many_shards(spark, frame, rows, many_shards, splice):
    data = some_rows(11) + [(None, 0, "user", "nobody"), (900, None, "user", "first"), (900, 1, "user", "second"), (5000, 1, None, None)]
    data += [(c, t, "user", "same") for c in range(1000, 1400) for t in range(3)]
    data += [(c, t, "user", "same" if t < 40 else f"own {c}") for c in range(1400, 1420) for t in range(41)]
    lists = turn_lists(frame(extended(data), SCHEMA).repartition(5))
    nodes = prefix_nodes(spliced(lists) if splice else lists)
    assert rows(nodes) == by_hand(data, splice)


def test_one_shard_and_ties(spark, frame, rows):
    data = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (-3, None, None, None)]
    assert rows(prefix_nodes(turn_lists(frame(extended(data), SCHEMA)))) == by_hand(data, False)


def test_ends_in_several_pieces(spark, rows, many_shards):
    assert PIECE > 1024
    data = [(c, 0, "user", "hello") for c in range(70_000)]
    docs = spark.range(70_000).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'hello' as text")
    assert rows(prefix_nodes(turn_lists(docs))) == by_hand(data, False)


def test_very_long_conversation_and_no_conversations(spark, frame, rows):
    data = [(7, t, "user", f"turn {t % 50}") for t in range(3000)]
    nodes = prefix_nodes(turn_lists(frame(extended(data), SCHEMA)))
    assert nodes.count() == 3001 and nodes.where("n_leaves <> 1").count() == 0
    assert prefix_nodes(turn_lists(frame([], SCHEMA))).collect() == []
