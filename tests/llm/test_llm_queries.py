"""Registered queries on the given tables, against SQL or brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import compare
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tradeloom.llm import decontaminate, packing, queries, secrets, toxicity

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
LABELLED = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def texts():
    return dict(pd.read_parquet(f"{FOLDER}/documents.parquet")[["doc_id", "text"]].itertuples(index=False))


def result(spark, name, folder=FOLDER, key="doc_id"):
    return {row[key]: row for row in queries.QUERIES[name](spark, folder).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    found = compare.differences(spark, compare.connect(FOLDER), queries.QUERIES[name], queries.ORACLE[name], FOLDER)
    assert found is None, found


def test_repeated_bytes(spark, texts):
    found = result(spark, "op1_suffix_array_dedup")
    expected = brute.repeated_bytes([t.encode() for t in texts.values()], 400)
    for doc_id, (n_bytes, removed, runs, kept) in zip(texts, expected):
        row = found[doc_id]
        assert (row.n_bytes, row.n_removed, row.n_spans) == (n_bytes, removed, runs)
        assert row.kept_sha256 == brute.sha256(kept)
    assert any(removed for _, removed, _, _ in expected)


def test_near_duplicates(spark):
    texts = dict(pd.read_parquet(f"{LARGER}/documents.parquet")[["doc_id", "text"]].itertuples(index=False))
    found = result(spark, "op2_ngram_jaccard_join", LARGER)
    links = brute.jaccard_links(texts)
    groups = brute.components(texts, links)
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert {i: r.n_links for i, r in found.items()} == {i: count[i] for i in texts}
    assert {i: r.group_id for i, r in found.items()} == groups
    assert {i for i, r in found.items() if r.keeps} == set(groups.values())
    assert len(links) > 50


def test_base_secrets(spark, texts):
    found = result(spark, "op3_secret_scan")
    total = 0
    for doc_id, text in texts.items():
        base = brute.base_secrets(text)
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in base)
        row = found[doc_id]
        assert row.base_sha256 == brute.sha256(joined)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(
            sum(kind == own for _, _, own, _ in base) for kind in secrets.KINDS[:3]
        )
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))
        total += len(base)
    assert total


def test_benchmark_passages(spark, texts):
    items = dict(pd.read_parquet(f"{FOLDER}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False))
    rows = queries.op5_benchmark_decontamination(spark, FOLDER).collect()
    found = {(r.doc_id, r.item_id): r for r in rows}
    whole = {(d, i) for d, t in texts.items() for i, item in items.items() if item.lower() in t.lower()}
    assert {pair for pair, r in found.items() if r.distance == 0} == whole
    for (d, i), r in found.items():
        budget = decontaminate.error_budget(len(items[i]), 0.05, 16)
        assert brute.edit_distance_within(items[i].lower(), texts[d].lower()) == r.distance <= budget
        if not r.distance:
            assert texts[d][r.start : r.end].lower() == items[i].lower()


def test_shards(spark, texts):
    found = result(spark, "op6_minimax_sharding")
    assert set(found) == set(texts)
    shards, of_text = defaultdict(list), {}
    for doc_id, text in texts.items():
        row = found[doc_id]
        assert row.size == len(text.encode()) + 8 and row.text_crc32 == zlib.crc32(text.encode())
        assert of_text.setdefault(text, row.shard) == row.shard
        shards[row.shard].append(row)
    assert set(shards) <= set(range(24))
    for rows in shards.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_toxic_documents_held_out(spark):
    labels = dict(pd.read_parquet(f"{LABELLED}/labels.parquet")[["doc_id", "toxic"]].itertuples(index=False))
    found = result(spark, "op7_toxicity", LABELLED)
    held = {i for i in found if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in found.items() if r.held_out} == held
    pairs = [(found[i].score, labels[i]) for i in held if i in labels]
    toxic, clean = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    assert len(toxic) > 5
    better = np.mean([[(a > b) + (a == b) / 2 for b in clean] for a in toxic])
    assert better > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())


def test_packed_documents_round_trip(spark, texts):
    rows = queries.op8_sum_of_squares_packing(spark, FOLDER).collect()
    encode = packing.byte_bpe()
    pieces, windows = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
        windows[row.sequence_id].append(row)
    for doc_id, text in texts.items():
        ids = np.array([*encode([text])[0], 0], "<u4")
        at = 0
        for row in sorted(pieces.pop(doc_id), key=lambda r: r.start):
            assert row.start == at and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    assert not pieces
    for rows_ in windows.values():
        at = 0
        for row in sorted(rows_, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 1024
    tokens = sum(r.length for r in rows)
    assert len(windows) * 1024 - tokens < 8 * 1024


def test_pipeline_stages(spark, texts, monkeypatch):
    """Each stage on its own input, held against brute force; the network is trained once."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    network = queries.toxicity_network(spark, FOLDER)
    monkeypatch.setattr(corpus_pipeline, "toxicity_network", lambda *_: network)
    items = list(pd.read_parquet(f"{FOLDER}/benchmark.parquet")["text"])
    scores = {r.doc_id: r.score for r in toxicity.score(docs, network).collect()}
    inputs = texts
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, FOLDER).collect()
        if name == "packing":
            assert {r.doc_id for r in rows} == set(inputs)
            break
        outputs = {r.doc_id: r.text for r in rows}
        assert len(outputs) == len(rows)
        if name == "toxicity":
            assert set(outputs) == {i for i, s in scores.items() if s < 0.3}
        elif name == "line_dedup":
            assert outputs == brute.lines_kept(inputs)
        elif name == "ngram_jaccard":
            assert set(outputs) == set(brute.components(inputs, brute.jaccard_links(inputs)).values())
        elif name == "decontamination":
            hit = {d for d, t in inputs.items() if any(item.lower() in t.lower() for item in items)}
            assert set(outputs).isdisjoint(hit) and len(set(inputs) - hit - set(outputs)) <= 1
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        inputs = outputs
    whole = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in whole.collect()} == set(inputs)
