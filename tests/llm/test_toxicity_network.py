"""The network's forward pass against plain loops, its windows, and its ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tradeloom.llm import toxicity


def plain_logit(network: toxicity.Network, words: list[str]) -> float:
    p, h = {k: v.astype(np.float64) for k, v in network.p.items()}, toxicity.HIDDEN
    squash = lambda x: 1 / (1 + np.exp(-x))
    inputs = [toxicity.Features([word]) for word in words]
    rows = [
        np.concatenate([p["word"][f.word[0]], p["trigram"][f.trigrams].mean(axis=0)]) @ p["input"] + p["input_bias"]
        for f in inputs
    ]
    states = np.zeros((len(words), 2 * h))
    for direction, order in enumerate((range(len(words)), reversed(range(len(words))))):
        state = np.zeros(h)
        for t in order:
            x = rows[t][3 * h * direction : 3 * h * (direction + 1)]
            u = state @ p["recurrent"][direction]
            z, r = squash(x[:h] + u[:h]), squash(x[h : 2 * h] + u[h : 2 * h])
            new = np.tanh(x[2 * h :] + r * u[2 * h :])
            state = z * state + (1 - z) * new
            states[t, h * direction : h * (direction + 1)] = state
    weight = np.exp(np.tanh(states @ p["attend"] + p["attend_bias"]) @ p["attend_to"])
    return float((weight / weight.sum()) @ states @ p["out"] + p["out_bias"][0])


def test_forward_pass_equals_plain_loops():
    network = toxicity.Network.fresh(5)
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 7))) for _ in range(n)) for n in (1, 2, 17, 32)]
    windows = toxicity.windows_of(texts, known := {})
    found = network.read(network.projected(toxicity.Features(list(known))), windows.index, windows.length)
    expected = [plain_logit(network, text.split()) for text in texts]
    assert np.allclose(found, expected, atol=1e-4)
    assert np.allclose(toxicity.score_texts(network, texts), 1 / (1 + np.exp(-np.array(expected))), atol=1e-4)


def test_a_passage_of_half_a_window_lies_whole_in_one():
    words = [f"w{n}" for n in range(203)]
    windows = toxicity.windows_of([" ".join(words)], {})
    spans = [(row[0], row[0] + size) for row, size in zip(windows.index, windows.length)]
    half = toxicity.WINDOW // 2
    for start in range(len(words) - half + 1):
        assert any(low <= start and start + half <= high for low, high in spans)
    assert {n for low, high in spans for n in range(low, high)} == set(range(203))


def test_null_ids_are_not_held_out(spark):
    rows = spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id UNION ALL SELECT id FROM range(40)")
    found = {r.doc_id: r.held for r in rows.select("doc_id", toxicity.held_out().alias("held")).collect()}
    assert found[None] is False and set(found.values()) == {True, False}


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b", "kept", "also")], "doc_id int, text string, __text string, score string")
    (row,) = toxicity.score(docs, toxicity.Network.fresh(1)).select("__text", F.col("score") > 0).collect()
    assert tuple(row) == ("kept", True)
