"""Merkle manifests against trees built the plain way."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import merkle, queries
from tradeloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def plain_leaf(values) -> str:
    texts = [None if v is None else str(v).encode() for v in values]
    return brute.sha256(b"".join(b"-" if t is None else b"%d:%s" % (len(t), t) for t in texts))


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([brute.sha256("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def steps_of(levels: list[list[str]], place: int) -> list[tuple[str, bool]]:
    steps = []
    for level in levels[:-1]:
        other = place ^ 1
        steps.append((level[other] if other < len(level) else "", bool(place & 1)))
        place >>= 1
    return steps


def plain_manifest(rows, presented) -> list[tuple]:
    """Rows are ``doc_id, source, lang, n_chars, text``."""
    langs = defaultdict(list)
    for row, seen in zip(rows, presented):
        langs[row[2]].append((row[0] is not None, row[0] or 0, plain_leaf(row), plain_leaf(seen), row[0]))
    order = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels_of([leaf for _, _, leaf, _, _ in sorted(langs[lang], key=lambda r: r[:3])]) for lang in order}
    top = levels_of([trees[lang][-1][0] for lang in order])
    out = []
    for number, lang in enumerate(order):
        for place, (_, _, leaf, seen, doc_id) in enumerate(sorted(langs[lang], key=lambda r: r[:3])):
            steps = steps_of(trees[lang], place) + steps_of(top, number)
            node = seen
            for sibling, left in steps:
                node = brute.sha256(sibling + node if left else node + sibling)
            proof = brute.sha256("".join(sibling for sibling, _ in steps))
            out.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def tampered(row):
    doc_id, source, lang, n_chars, text = row
    hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
    return (doc_id, source, lang, n_chars + 1 if hit and n_chars is not None else n_chars, text)


def result(frame) -> list[tuple]:
    columns = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_the_registered_query(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select(*merkle.FIELDS).collect()]
    found = result(queries.op13_merkle_manifest(spark, FOLDER).withColumnRenamed("doc_id", "id"))
    assert found == sorted(plain_manifest(rows, map(tampered, rows)), key=str)
    assert {row[-1] for row in found} == {True, False}


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_several_passes(spark, bits):
    """Blocks of a few leaves, trees of one leaf up, more trees than a block holds."""
    sizes = [1, 2, 3, 4, 5, 8, 9, 17, 33]
    rows = [(100 * t + i, "s", f"lang {t}", i, f"text {i}") for t, size in enumerate(sizes) for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    changed = F.when(F.col("doc_id") % 3 == 0, F.lit("other")).otherwise(F.col("text"))
    made = merkle.manifest(docs.repartition(5), presented={"text": changed}, bits=bits)
    seen = [(*row[:4], "other") if row[0] % 3 == 0 else row for row in rows]
    assert result(merkle.proofs(made)) == sorted(plain_manifest(rows, seen), key=str)
    assert len(made.logs) > 1 and len(made.root_logs) > 1


def test_odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing names."""
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (None, "", "", 0, ""),
        (5, "s", "é", 3, "x" * 300_000),
        (5, "s", "é", 3, "y"),
        (7, "s", "z", None, None),
        (0, "-", "-", 2**63 - 1, "1:-"),
        (-3, "s", "=", 1, "t"),
    ]
    names = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    docs = spark.createDataFrame(rows, names).withColumns({n: F.lit(1) for n in ("tree", "leaf", "index", "row", "n", "part")})
    chars = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    found = result(merkle.proofs(merkle.manifest(docs, presented={"n_chars": chars})))
    assert found == sorted(plain_manifest(rows, map(tampered, rows)), key=str)
    assert merkle.proofs(merkle.manifest(docs.limit(0))).collect() == []


def test_one_document(spark):
    docs = spark.createDataFrame([(1, "s", "en", 1, "t")], "doc_id bigint, source string, lang string, n_chars int, text string")
    (row,) = merkle.proofs(merkle.manifest(docs)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root
    assert row.verified and row.proof_sha256 == brute.sha256("")


def test_places_in_the_log():
    """The computed place of a node is where the builder appended it."""
    for leaves in range(1, 70):
        nodes = [str(i) for i in range(leaves)]
        levels = levels_of(nodes)
        log = merkle.postorder(nodes, len(levels) - 1)
        assert len(log) == sum(map(len, levels)) == merkle.subtree_size(leaves, len(levels) - 1)
        for level, row in enumerate(levels):
            for index, node in enumerate(row):
                assert log[merkle.position(level, index, leaves)] == node


def test_a_block_goes_up_to_its_level():
    assert len(merkle.postorder(["a"], 3)) == 4
    assert merkle.postorder(["a"], 3)[-1] == brute.sha256(brute.sha256(brute.sha256("a")))
