"""Byte-level BPE against the library the ranks are for, and against one merge at a time."""

from __future__ import annotations

import random

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken

from tradeloom.llm import bpe, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(bpe.NAME, None))


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bpe.Encoder(vocabulary, regex.compile(public_tokenizers.PATTERN))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def ids_of(encoder, texts):
    ids, sizes = encoder(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def one_by_one(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[part] for part in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_every_document(spark, library):
    texts = pd.read_parquet(f"{FOLDER}/documents.parquet").set_index("doc_id")["text"]
    found = queries.op12_byte_bpe(spark, FOLDER).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == brute.sha256(",".join(map(str, ids)))
        assert row.decoded_sha256 == brute.sha256(text)


def test_mixed_scripts_and_white_space(encoder, library):
    random.seed(3)
    parts = ["a", "é", "ß", "12", " ", "  ", "\n", "\t", "'s", "'re", "'", "!", "-", "漢字", "🙂", "́", "\xa0", "the", "ing"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 80))) for _ in range(1500)]
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_slices_do_not_show(encoder, library, monkeypatch):
    random.seed(4)
    parts = ["ab", " ", "   ", "\n", "'ll", "'", "1", "!?", "wordwordword"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 200))) for _ in range(500)]
    monkeypatch.setattr(bpe, "SLICE", 40)
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 20_000 + "x", "=" * 3_000, "abcab" * 4_000, "né" * 5_000])
def test_a_long_piece(encoder, library, text):
    assert ids_of(encoder, [text]) == [library.encode_ordinary(text)]


def test_a_long_random_word(encoder, library):
    random.seed(5)
    words = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=k)) for k in (255, 256, 257, 400, 20_000)]
    assert ids_of(encoder, words) == [library.encode_ordinary(w) for w in words]


@pytest.mark.parametrize("seed", range(40))
def test_ranks_in_any_order(seed):
    """Also ranks that no training gives, where a merge makes a pair of lower rank."""
    random.seed(seed)
    tokens = {bytes(random.choices(b"abc", k=random.randint(2, 6))) for _ in range(30)}
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(random.sample(sorted(tokens), len(tokens)))}
    vocabulary = bpe.Vocabulary(ranks)
    pieces = [bytes(random.choices(b"abc", k=random.randint(1, 60))) for _ in range(60)]
    ids, sizes = vocabulary.encoded(pieces)
    expected = [[ranks[p]] if p in ranks else one_by_one(ranks, p) for p in pieces]
    assert [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] == expected
    assert [vocabulary.merged_row(p).tolist() for p in pieces] == [one_by_one(ranks, p) for p in pieces]


def test_pairs_are_found_and_others_not():
    rng = np.random.default_rng(6)
    key = rng.choice(10**8, 5000, replace=False)
    left, right = key // 10**4, key % 10**4
    pairs = bpe.Pairs(left[:2500], right[:2500], np.arange(2500))
    assert pairs(left, right).tolist() == [*range(2500), *[bpe.NEVER] * 2500]


def test_a_task_forgets_and_goes_on(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "SLICE", 20)
    texts = [f"alpha beta {n} gammadelta" for n in range(50)]
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_odd_rows(spark, library):
    rows = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "<|endoftext|> \x00 z", "x"), (3, "w " * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").withColumnRenamed("doc_id", "n_tokens.x")
    out = bpe.decode(bpe.encode(docs))
    assert out.columns == ["n_tokens.x", "text", "ids", "n_tokens", "decoded"]
    found = sorted((bytes(r.decoded).decode(), r.ids, r.n_tokens) for r in out.collect())
    expected = sorted((t or "", library.encode_ordinary(t or ""), len(library.encode_ordinary(t or ""))) for _, t, _ in rows)
    assert found == expected
    assert bpe.decode(bpe.encode(docs.limit(0))).collect() == []


def test_ids_the_vocabulary_has_not(spark):
    ids = spark.createDataFrame([(1, [50, 51]), (2, None), (3, [50, None]), (4, [10**8]), (5, [])], "n int, ids array<int>")
    found = {r.n: r.decoded for r in bpe.decode(ids).collect()}
    assert found[2] is found[3] is found[4] is None
    assert len(found[1]) >= 2 and bytes(found[5]) == b""


def test_a_batch_is_taken_a_portion_at_a_time(spark, library, monkeypatch):
    """Texts of a batch are not Python values all at once; copies are encoded once."""
    import pyarrow as pa

    monkeypatch.setattr(bpe, "PORTION", 4)
    seen = []
    monkeypatch.setattr(bpe.Encoder, "__call__", spied(bpe.Encoder.__call__, seen))
    made = {}
    monkeypatch.setattr(bpe.F, "arrow_udf", lambda run, kind: made.setdefault(kind, run) and (lambda _: bpe.F.lit(None).cast(kind)))
    docs = spark.createDataFrame([("x", [1])], "text string, ids array<int>")
    bpe.encode(docs.select("text"))
    bpe.decode(docs)
    texts = [f"word {n % 11} é" for n in range(30)] + ["", "<|endoftext|>"]
    parts = list(made["array<int>"](iter([pa.array(texts)])))
    assert max(map(len, parts)) <= 4
    ids = pa.concat_arrays(parts)
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts]
    assert max(map(len, seen)) <= 4 and sum(map(len, seen)) == 13
    decoded = list(made["binary"](iter([ids])))
    assert max(map(len, decoded)) <= 4
    assert [d.decode() for part in decoded for d in part.to_pylist()] == texts
    (none,) = made["array<int>"](iter([pa.array([], pa.string())]))
    assert none.to_pylist() == []


def spied(call, seen):
    def wrapped(self, texts):
        seen.append(texts)
        return call(self, texts)

    return wrapped
