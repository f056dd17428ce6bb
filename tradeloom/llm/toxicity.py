"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as an embedding of itself and the mean embedding of its character
trigrams, both hashed. A text is cut into overlapping windows of words; the
network reads each window in both directions, attention pools what it read, and
the text's score is that of its worst window. Training and scoring are numpy.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import col, id_key, replaced, single_threaded, text_of

WORDS = re.compile(r"\w+")
WORD_BUCKETS, TRIGRAM_BUCKETS = 4096, 8192
WORD_SIZE, TRIGRAM_SIZE, HIDDEN, ATTENTION = 8, 16, 8, 8
#: Words of a window, and from one window's start to the next: each word but
#: those at the ends of a text lies in two windows.
WINDOW, STEP = 32, 16
#: Words a task remembers the features of.
MOST_WORDS = 200_000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tanh(x: np.ndarray) -> np.ndarray:
    return 2 / (1 + np.exp(np.clip(-2 * x, -30, 30))) - 1


class Features:
    """Hashed features of distinct words: a bucket of the word, and buckets of
    the character trigrams of ``<word>`` with where each word's begin."""

    def __init__(self, words: list[str]):
        coded = [word.encode() for word in words]
        self.word = np.fromiter((zlib.crc32(c) % WORD_BUCKETS for c in coded), np.int64, len(coded))
        marked = b"".join(b"<%b>" % c for c in coded)
        bytes_ = np.frombuffer(marked, np.uint8).astype(np.uint32)
        sizes = np.fromiter((len(c) for c in coded), np.int64, len(coded))
        # A word of n bytes has n trigrams; those across two words are left out.
        mixed = bytes_[:-2] * np.uint32(0x9E3779B1) ^ bytes_[1:-1] * np.uint32(0x85EBCA77) ^ bytes_[2:] * np.uint32(0xC2B2AE3D)
        starts = np.cumsum(sizes + 2) - sizes - 2
        keep = np.ones(len(mixed), bool)
        keep[(starts[1:] - 1)] = False
        keep[(starts[1:] - 2)] = False
        self.trigrams = ((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(8)).astype(np.int64)[keep] % TRIGRAM_BUCKETS
        self.sizes = sizes
        self.starts = np.cumsum(sizes) - sizes


@dataclass
class Windows:
    """Windows of documents as places in a list of distinct words."""

    index: np.ndarray  # windows by WINDOW
    length: np.ndarray  # words in each
    document: np.ndarray  # which document each is from


def windows_of(texts: list[str], known: dict[str, int]) -> Windows:
    """All overlapping windows; new words are added to ``known``. A text
    without words is one window without words."""
    rows, lengths, documents = [], [], []
    for n, text in enumerate(texts):
        places = [known.setdefault(word, len(known)) for word in WORDS.findall(text.lower())]
        for start in range(0, max(1, len(places) - (WINDOW - STEP)), STEP):
            part = places[start : start + WINDOW]
            lengths.append(len(part))
            rows.append(part + [0] * (WINDOW - len(part)))
            documents.append(n)
    return Windows(np.array(rows, np.int64).reshape(-1, WINDOW), np.array(lengths), np.array(documents, np.int64))


def worst(logits: np.ndarray, windows: Windows, documents: int) -> np.ndarray:
    top = np.full(documents, -np.inf, np.float32)
    np.maximum.at(top, windows.document, logits)
    return top


@dataclass
class Network:
    """Parameters by name; recurrent ones have a first axis of directions."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        size, h = WORD_SIZE + TRIGRAM_SIZE, HIDDEN
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return cls(
            {
                "word": draw(WORD_BUCKETS, WORD_SIZE, scale=0.1),
                "trigram": draw(TRIGRAM_BUCKETS, TRIGRAM_SIZE, scale=0.2),
                "input": draw(size, 6 * h, scale=size**-0.5),
                "input_bias": np.zeros(6 * h, np.float32),
                "recurrent": draw(2, h, 3 * h, scale=h**-0.5),
                "attend": draw(2 * h, ATTENTION, scale=0.3),
                "attend_bias": np.zeros(ATTENTION, np.float32),
                "attend_to": draw(ATTENTION, scale=0.3),
                "out": draw(2 * h, scale=0.3),
                "out_bias": np.full(1, -2, np.float32),
            }
        )

    def inputs(self, f: Features) -> np.ndarray:
        """Word and character inputs of distinct words."""
        summed = np.add.reduceat(self.p["trigram"][f.trigrams], f.starts, axis=0) if len(f.word) else np.zeros((0, TRIGRAM_SIZE), np.float32)
        return np.concatenate([self.p["word"][f.word], summed / f.sizes[:, None].astype(np.float32)], axis=1)

    def projected(self, f: Features) -> np.ndarray:
        return self.inputs(f) @ self.p["input"] + self.p["input_bias"]

    def read(self, projected: np.ndarray, index: np.ndarray, length: np.ndarray, keep: bool = False):
        """Logits of windows; with ``keep`` also what training needs."""
        p, h, n = self.p, HIDDEN, len(index)
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((WINDOW, 2, n, h), np.float32)
        kept = []
        for t in range(WINDOW):
            places = (t, WINDOW - 1 - t)
            x = np.stack([projected[index[:, places[0]], : 3 * h], projected[index[:, places[1]], 3 * h :]])
            live = np.stack([places[0] < length, places[1] < length])[:, :, None].astype(np.float32)
            u = np.matmul(state, p["recurrent"])
            gates = sigmoid(x[:, :, : 2 * h] + u[:, :, : 2 * h])
            z, r = gates[:, :, :h], gates[:, :, h:]
            new = tanh(x[:, :, 2 * h :] + r * u[:, :, 2 * h :])
            if keep:
                kept.append((state, z, r, new, u[:, :, 2 * h :], live))
            state = state + live * (1 - z) * (new - state)
            states[places[0], 0], states[places[1], 1] = state[0], state[1]
        both = np.concatenate([states[:, 0], states[:, 1]], axis=2)
        seen = tanh(both @ p["attend"] + p["attend_bias"])
        live = np.arange(WINDOW)[:, None] < length[None, :]
        weight = np.where(live, np.exp(np.clip(seen @ p["attend_to"], -30, 30)), 0)
        weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        logits = pooled @ p["out"] + p["out_bias"][0]
        return (logits, (kept, both, seen, weight, pooled)) if keep else logits

    def gradient(self, f: Features, index: np.ndarray, length: np.ndarray, slope: np.ndarray, kept) -> dict[str, np.ndarray]:
        """Gradient of all parameters, given that of the logits."""
        p, h = self.p, HIDDEN
        steps, both, seen, weight, pooled = kept
        g = {"out": slope @ pooled, "out_bias": np.array([slope.sum()], np.float32)}
        d_pooled = slope[:, None] * p["out"]
        d_both = weight[:, :, None] * d_pooled
        d_weight = (both * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attend_to"] = np.einsum("tn,tna->a", d_score, seen)
        d_seen = d_score[:, :, None] * p["attend_to"] * (1 - seen * seen)
        g["attend"] = np.einsum("tnh,tna->ha", both, d_seen)
        g["attend_bias"] = d_seen.sum(axis=(0, 1))
        d_both = d_both + d_seen @ p["attend"].T
        d_state = np.zeros((2, len(index), h), np.float32)
        g["recurrent"] = np.zeros_like(p["recurrent"])
        d_projected = np.zeros((len(f.word), 6 * h), np.float32)
        for t in reversed(range(WINDOW)):
            places = (t, WINDOW - 1 - t)
            before, z, r, new, u_new, live = steps[t]
            d_state = d_state + np.stack([d_both[places[0], :, :h], d_both[places[1], :, h:]])
            d_live = d_state * live
            d_z = d_live * (before - new) * z * (1 - z)
            d_new = d_live * (1 - z) * (1 - new * new)
            d_r = d_new * u_new * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=2)
            d_x = np.concatenate([d_z, d_r, d_new], axis=2)
            g["recurrent"] += np.matmul(before.transpose(0, 2, 1), d_u)
            d_state = d_state - d_live * (1 - z) + np.matmul(d_u, p["recurrent"].transpose(0, 2, 1))
            np.add.at(d_projected, (index[:, places[0]], slice(0, 3 * h)), d_x[0])
            np.add.at(d_projected, (index[:, places[1]], slice(3 * h, None)), d_x[1])
        g["input"] = self.inputs(f).T @ d_projected
        g["input_bias"] = d_projected.sum(axis=0)
        d_inputs = d_projected @ p["input"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], f.word, d_inputs[:, :WORD_SIZE])
        g["trigram"] = np.zeros_like(p["trigram"])
        np.add.at(g["trigram"], f.trigrams, np.repeat(d_inputs[:, WORD_SIZE:] / f.sizes[:, None], f.sizes, axis=0))
        return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            self.p[k] -= size * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)


def train(
    texts: list[str], labels: list[int], steps: int = 400, rate: float = 0.01, batch: int = 16, top: int = 4, seed: int = 7
) -> Network:
    """Fit the network to labelled texts.

    A text is as toxic as its worst window, so the loss of a text is spread
    over its ``top`` worst windows, by softmax. The number of steps does not
    depend on the number of texts; few texts are seen more often.
    """
    network, rng = Network.fresh(seed), np.random.default_rng(seed)
    known: dict[str, int] = {}
    windows = windows_of(texts, known)
    vocabulary, labels_ = list(known), np.array(labels, np.float32)
    adam = Adam(network.p, rate)
    first = np.searchsorted(windows.document, np.arange(len(texts) + 1))
    while vocabulary and adam.t < steps:
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            adam.rate = rate * (1 if adam.t < steps * 2 // 3 else 0.3)
            chosen = order[low : low + batch]
            own = np.concatenate([np.arange(first[d], first[d + 1]) for d in chosen])
            words, index = np.unique(windows.index[own], return_inverse=True)
            index, length = index.reshape(-1, WINDOW), windows.length[own]
            features = Features([vocabulary[w] for w in words])
            projected = network.projected(features)
            logits = network.read(projected, index, length)
            picked, weights, of = [], [], []
            at = 0
            for n, d in enumerate(chosen):
                count = first[d + 1] - first[d]
                mine = at + np.argsort(-logits[at : at + count])[:top]
                share = np.exp(logits[mine] - logits[mine].max())
                picked.append(mine), weights.append(share / share.sum()), of.append(np.full(len(mine), n))
                at += count
            picked, weights, of = map(np.concatenate, (picked, weights, of))
            found, kept = network.read(projected, index[picked], length[picked], keep=True)
            score = np.bincount(of, weights * found, len(chosen))
            slope = (sigmoid(score) - labels_[chosen])[of] * weights / len(chosen)
            adam.step(network.gradient(features, index[picked], length[picked], slope.astype(np.float32), kept))
    return network


def score_texts(network: Network, texts: list[str]) -> np.ndarray:
    """Scores of texts, 0 to 1."""
    known: dict[str, int] = {}
    windows = windows_of(texts, known)
    projected = network.projected(Features(list(known))) if known else np.zeros((1, 6 * HIDDEN), np.float32)
    logits = np.empty(len(windows.index), np.float32)
    for low in range(0, len(logits), 1024):
        part = slice(low, low + 1024)
        logits[part] = network.read(projected, windows.index[part], windows.length[part])
    # What numpy adds up in another order for another batch is rounded away.
    return sigmoid(worst(logits, windows, len(texts)).astype(np.float64)).round(5)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> tuple[list[str], list[int]]:
    """At most ``rows`` labelled texts, those of the smallest hashes of ids; of
    several texts with an id the least."""
    known = (
        labels.select(col(id_col).cast("bigint").alias("i"), col(label_col).cast("int").alias("label"))
        .dropna()
        .groupBy("i")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("i"), "i")
        .limit(rows)
    )
    ids = docs.sparkSession.createDataFrame(known.toPandas(), "i bigint, label int")
    texts = docs.select(col(id_col).cast("bigint").alias("i"), text_of(text_col).alias("t"))
    found = texts.join(F.broadcast(ids), "i").groupBy("i", "label").agg(F.min("t").alias("t")).orderBy("i").collect()
    return [row.t for row in found], [row.label for row in found]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = 3000) -> Network:
    """Train on at most ``rows`` labelled documents."""
    return train(*labelled_sample(docs, labels, id_col, text_col, label_col, rows))


def score(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """Add ``score``, 0 to 1, to the input's columns (a column of that name
    makes room).

    All windows of the whole text count. Null and empty texts, and texts
    without words, get the score of an empty window. Repeated rows score alike;
    an empty table gives an empty table. No shuffle; a task holds 64 texts of a
    batch at a time.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        single_threaded()
        for texts in batches:
            parts = [score_texts(network, texts.iloc[low : low + 64].tolist()) for low in range(0, len(texts), 64)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return replaced(docs, score=scored(text_of(text_col)))


def held_out(id_col: str = "doc_id"):
    """The rows kept from training: crc32 of the id as text, mod 4, is 2. A null
    id is not held out."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
