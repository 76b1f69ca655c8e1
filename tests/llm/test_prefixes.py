"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tissueframe.llm import prefixes, queries

TURNS = "conv_id long, turn long, role string, text string"


def node_rows(conversations):
    """Nodes of ``{conv_id: [(role, text), ...]}`` as tuples in the order of the output columns."""
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    rows = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode().split()) for p in below if p)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        rows.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]),
            sum(not children[p] for p in below), saved, digest,
        ))
    return sorted(rows, key=repr)


def grouped(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in found.items()}


def grafted(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + turns[h:]
    return out


def make(seed, convs=120, choices=4):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1000), convs):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn if turn or rng.random() < 0.7 else None, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a b", "ä  b\nc", "x" * 50][:choices])))
    return rows


@pytest.mark.parametrize("unit", [1, 2, 7, 1 << 15])
@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, unit, seed, monkeypatch):
    monkeypatch.setattr(prefixes, "PACK", 3)
    rows = make(seed)
    rows += [(2000 + i, t, r, x) for i in range(60) for t, r, x in ((0, "user", "hot"), (1, "assistant", "same"))]  # many copies
    rows += [(3000 + i, 0, "user", "hot") for i in range(10)] + [(None, 0, "user", "lost")]
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    got = prefixes.prefix_trie(prefixes.conversation_rows(frame), unit).collect()
    assert sorted(map(tuple, got), key=repr) == node_rows(grouped(rows))


def test_query_equals_brute_force(spark, tmp_path):
    rows = make(3, 300, 3) + [(1020, 0, "system", "long " * 500), (1040, 7, None, None), (1043, 0, "a", "b"), (None, 1, "a", "b")]
    frame = spark.createDataFrame(rows, TURNS)
    frame.selectExpr("*", "role AS base", "text AS turns", "conv_id AS h").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_radix_conversations(spark, str(tmp_path)).collect()
    expected = node_rows(grafted(grouped(rows)))
    assert sorted(map(tuple, got), key=repr) == expected
    assert any(r.depth == 0 and r.ends_sha256 != prefixes.EMPTY_SHA for r in got)  # turnless conversations


def test_turns_of_equal_number_and_repeated_rows(spark):
    rows = [(1, 0, "u", "b"), (1, 0, "u", "a"), (2, 0, "u", "a"), (2, 0, "u", "b"), (3, 0, "u", "a"), (3, 0, "u", "a")]
    got = prefixes.prefix_trie(prefixes.conversation_rows(spark.createDataFrame(rows, TURNS))).collect()
    assert sorted((r.depth, r.n_convs) for r in got if r.conv_id == 1 and r.depth == 2) == [(2, 2)]
    assert {(r.depth, r.n_convs) for r in got if r.depth == 0} == {(0, 3)}


def test_long_conversation(spark):
    rows = [(1, t, "u", str(t)) for t in range(3000)] + [(2, t, "u", str(t)) for t in range(2999)]
    got = prefixes.prefix_trie(prefixes.conversation_rows(spark.createDataFrame(rows, TURNS)), 1).collect()
    assert len(got) == 3001 and {r.n_convs for r in got} == {1, 2}
    assert next(r for r in got if not r.depth).saved_tokens == 2999


def test_empty_conversations(spark):
    frame = spark.createDataFrame([], TURNS)
    assert prefixes.prefix_trie(prefixes.conversation_rows(frame)).count() == 0


def test_layouts_grow_and_keep_order():
    rng = random.Random(1)
    tree, keys = prefixes.RadixTree(), {}
    for i in range(3000):
        wide = [rng.randrange(4) for _ in range(rng.randrange(4))]
        key = b"".join(bytes([0] * 14 + [x, rng.randrange((3, 12, 40, 256)[x])]) for x in wide)
        keys[key] = i
        tree.insert(key, i)
    seen, layouts, stack = {}, set(), [(tree.root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.path
        layouts.add(node.layout)
        assert [b for b, _ in node.ordered()] == sorted(b for b, _ in node.ordered())
        if node.value is not None:
            seen[path] = node.value
        stack += [(kid, path + bytes([b])) for b, kid in node.ordered()]
    assert seen == keys and layouts == {4, 16, 48, 256}
    nodes = {k[: 16 * d] for k in keys for d in range(len(k) // 16 + 1)}
    walk = list(tree.turns())
    assert len(walk) == len(nodes) and [v for _, _, v in walk if v is not None] == [keys[k] for k in sorted(keys)]
