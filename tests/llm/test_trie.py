"""Prefix tries against tries built the plain way."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from tradeloom.llm import queries, trie
from tradeloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turns in convs.items():
        path = tuple(turns)
        ends[path].append(conv)
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
            if depth:
                children[path[: depth - 1]].add(path[:depth])
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += own
    return sorted(
        (
            min(convs_here),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(convs_here),
            len(children[path]),
            leaves[path],
            saved[path],
            brute.sha256(",".join(map(str, sorted(ends[path])))),
        )
        for path, convs_here in members.items()
    )


def result(frame) -> list[tuple]:
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def frame_of(spark, convs):
    rows = [(c, n, role, text) for c, turns in convs.items() for n, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def tries(spark, convs, **options):
    return result(trie.prefix_trie(trie.conversations(frame_of(spark, convs)), **options))


def branching(seed: int, count: int, choices: int, longest: int) -> dict:
    rng = random.Random(seed)
    return {
        c: [(rng.choice("ua"), "é" * rng.randrange(choices)) for _ in range(rng.randint(1, longest))]
        for c in rng.sample(range(-100, 200_000), count)
    }


def test_the_registered_query(spark):
    own = defaultdict(list)
    for r in table(spark, FOLDER, "conversations").orderBy("conv_id", "turn").collect():
        own[r.conv_id].append((r.role or "", r.text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    found = result(queries.op11_conversation_trie(spark, FOLDER))
    assert found == plain_trie(rebuilt)
    assert sum(row[3] > 1 for row in found) > 50


@pytest.mark.parametrize("most_turns, at_once", [(trie.MOST_TURNS, trie.AT_ONCE), (3, 5), (40, 1)])
def test_branching(spark, monkeypatch, most_turns, at_once):
    """Shards of any size give the same nodes, also those cut at some depth."""
    monkeypatch.setattr(trie, "AT_ONCE", at_once)
    convs = branching(2, 150, 2, 9)
    assert tries(spark, convs, most_turns=most_turns) == plain_trie(convs)


def test_copies_and_a_common_start(spark):
    """A third are copies, another third share 20 turns and part late."""
    convs = branching(3, 60, 4, 5)
    start = [("user", f"turn {i}") for i in range(20)]
    convs |= {300_000 + i: [("user", "same"), ("assistant", "answer")] for i in range(70)}
    convs |= {400_000 + i: start + [("user", str(i % 30)), ("user", "x")][: i % 3] for i in range(60)}
    assert tries(spark, convs, most_turns=100) == plain_trie(convs)


def test_a_long_conversation(spark):
    convs = {1: [("user", str(i % 50)) for i in range(400)], 2: [("user", str(i % 50)) for i in range(300)], 3: [("user", "0")]}
    assert tries(spark, convs) == plain_trie(convs)


def test_odd_rows(spark):
    """Nulls, empty texts, ties, repeated rows, clashing and missing turns."""
    rows = [
        (None, 1, "user", "lost"),
        (1, None, "user", "null turn first"),
        (1, 0, None, None),
        (1, 1, "", ""),
        (2, 5, "user", "null turn first"),
        (2, 9, "", None),
        (3, 1, "user", "same"),
        (3, 1, "user", "same"),
        (4, 2, "a", "b" * 200_000),
        (5, 2, "ab", "b" * 199_999),
    ]
    schema = "conv_id bigint, turn bigint, role string, text string"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS turns", "2 AS keys", "3 AS n", "4 AS `ends.a`")
    convs = {
        1: [("user", "null turn first"), ("", ""), ("", "")],
        2: [("user", "null turn first"), ("", "")],
        3: [("user", "same"), ("user", "same")],
        4: [("a", "b" * 200_000)],
        5: [("ab", "b" * 199_999)],
    }
    assert result(trie.prefix_trie(trie.conversations(frame))) == plain_trie(convs)
    assert trie.prefix_trie(trie.conversations(frame.limit(0))).collect() == []


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(c, 1, "user", f"text {i}") for c in (1, 2, 3) for i in random.Random(c).sample(range(30), 30)]
    nodes = result(trie.prefix_trie(trie.conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))))
    assert len(nodes) == 31 and {n[3] for n in nodes} == {3}


def test_conversations_without_turns(spark):
    rows = spark.sql(f"SELECT id AS conv_id, CAST(array() AS array<{trie.TURN}>) AS turns FROM range(3)")
    assert result(trie.prefix_trie(rows)) == plain_trie({0: [], 1: [], 2: []})


@pytest.mark.parametrize("seed", range(20))
def test_double_array_holds_its_rows_and_no_others(seed):
    rng = np.random.default_rng(seed)
    alphabet = int(rng.integers(2, 40))
    lead = rng.integers(0, alphabet, 60)
    size = rng.integers(0, 6, 60)
    symbols = rng.integers(0, alphabet, size.sum())
    built = trie.packed(lead, size, symbols, alphabet)
    first = np.cumsum(size) - size
    words = {(int(lead[i]), *map(int, symbols[first[i] : first[i] + size[i]])) for i in range(60)}
    paths = {w[:k] for w in words for k in range(len(w) + 1)}
    assert int((built.check >= 0).sum()) == len(paths) - 1
    for path in paths:
        node = np.zeros(1, np.int64)
        for symbol in path:
            node = built.step(node, np.array([symbol]))
        for symbol in range(alphabet):
            assert (built.step(node, np.array([symbol]))[0] >= 0) == ((*path, symbol) in paths)


def test_ids_come_in_runs(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN_BITS", 2)
    ids = [-9, -1, 0, 3, 4, 5, 100, 2**40, 10, 11]
    rows = [(i, (n % 3, 7)) for i in ids for n in (i,)]
    frame = spark.createDataFrame(rows, f"conv_id bigint, ends {trie.KEY}")
    found = {r.ends.a: r.ends_sha256 for r in trie.ends_digests(frame).collect()}
    assert found == {k: brute.sha256(",".join(str(i) for i in sorted(ids) if i % 3 == k)) for k in {i % 3 for i in ids}}


def test_double_array_grows_with_its_rows():
    """Children whose ids lie far apart take no more places for that."""
    rng = np.random.default_rng(1)
    rows, alphabet = 4000, 30_000
    lead, size = np.repeat(np.arange(rows // 4), 4), np.full(rows, 4)
    symbols = rng.integers(rows // 4, alphabet, size.sum())
    built = trie.packed(lead, size, symbols, alphabet)
    assert len(built.check) < 10 * (rows + len(symbols))
    node = built.step(np.zeros(rows, np.int64), lead)
    for depth in range(4):
        other = built.step(node, (symbols[depth::4] + 1) % alphabet)
        node = built.step(node, symbols[depth::4])
        assert (node >= 0).all() and (other >= 0).mean() < 0.01
    paths = {(lead[i], *symbols[4 * i : 4 * i + 4]) for i in range(rows)}
    assert len(set(node.tolist())) == len(paths)


def test_a_batch_is_taken_in_portions(monkeypatch):
    monkeypatch.setattr(trie, "AT_ONCE", 10)
    turns = [3, 0, 5, 40, 1, 2, 9, 10, 0, 0]
    batch = pa.RecordBatch.from_pydict({"rest": [list(range(n)) for n in turns]})
    parts = [part["rest"].to_pylist() for part in trie.portions(batch)]
    assert [len(row) for part in parts for row in part] == turns
    assert all(len(part) == 1 or sum(len(row) + 1 for row in part) <= 10 for part in parts)
    assert len(parts) == 7
