"""Byte-level BPE: encoding in length-bucketed padded matrices, and decoding.

A text is cut by the vocabulary's pattern. Each distinct piece is encoded once:
pieces of about the same length are rows of a padded matrix of token ids, with
a matrix of the ranks of neighbouring pairs beside it. In a round every row
merges its leftmost pair of least rank, both matrices close the gap, so they
lose a column, and rows without a pair to merge leave. The ranks of the two new
pairs of each row come from a hash table of all pairs the vocabulary can merge.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import repeat
from typing import Iterator as Batches

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import col, replaced, single_threaded, text_of

NAME = "byte_bpe_multi_50k"
PAD = -1
#: Rank of a pair that does not merge.
NEVER = np.iinfo(np.int32).max
#: Characters cut into pieces at a time, and cells of a matrix.
SLICE, CELLS = 1 << 19, 1 << 19
#: Rows of a batch taken as Python values at a time.
PORTION = 256
#: Pieces of more bytes are rows of their own.
WIDE = 256
#: Distinct pieces a task remembers before it starts anew.
REMEMBERED = 200_000


#: Numbers of pieces, how many ids each has, and the ids one after another.
Encoded = tuple[np.ndarray, np.ndarray, np.ndarray]


class Pairs:
    """Open-addressing hash table from two neighbouring ids to their rank."""

    EMPTY = np.uint64(2**64 - 1)
    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(4 * len(rank)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, self.EMPTY, np.uint64)
        self.ranks = np.full(1 << bits, NEVER, np.int32)
        key, rank = self.key(left, right), rank.astype(np.int32)
        slot = key * self.SPREAD >> self.shift
        while len(key):
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.ranks[slot[placed]] = rank[placed]
            key, rank, slot = key[~placed], rank[~placed], slot[~placed] + np.uint64(1) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = self.key(left, right)
        found = np.full(len(key), NEVER, np.int32)
        slot, asked = key * self.SPREAD >> self.shift, np.arange(len(key))
        while len(asked):
            held = self.keys[slot]
            hit = held == key
            found[asked[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held != self.EMPTY)
            asked, key, slot = asked[on], key[on], slot[on] + np.uint64(1) & self.mask
        return found


class Vocabulary:
    """Tokens by rank; every single byte must be one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.pairs = Pairs(*np.array(splits, np.int64).reshape(-1, 3).T)

    def matrix(self, pieces: list[bytes]) -> np.ndarray:
        """The pieces' bytes as ids, a padded row for each."""
        sizes = np.array([len(p) for p in pieces])
        rows = np.full((len(pieces), sizes.max()), PAD, np.int32)
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        return rows

    def merged(self, pieces: list[bytes]) -> Iterator[Encoded]:
        """Ids of pieces of about the same length, as their rows finish."""
        rows, number = self.matrix(pieces), np.arange(len(pieces))
        ranks = np.full((len(rows), rows.shape[1] - 1), NEVER, np.int32)
        real = rows[:, 1:] != PAD
        ranks[real] = self.pairs(rows[:, :-1][real], rows[:, 1:][real])
        while len(rows):
            if ranks.shape[1]:
                best = ranks.argmin(axis=1)
                token = ranks[np.arange(len(rows)), best]
                on = token != NEVER
            else:
                on = np.zeros(len(rows), bool)
            if not on.all():
                real = rows[~on] != PAD
                yield number[~on], real.sum(axis=1), rows[~on][real]
                rows, ranks, number = rows[on], ranks[on], number[on]
                if not len(rows):
                    break
                best, token = best[on], token[on]
            each = np.arange(len(rows))
            rows[each, best] = token
            rows = without(rows, best + 1)
            ranks = without(ranks, best)
            if not ranks.shape[1]:
                continue
            # The pairs of the new token with what is left and right of it.
            at = np.flatnonzero(best > 0)
            ranks[at, best[at] - 1] = self.pairs(rows[at, best[at] - 1], token[at])
            at = np.flatnonzero(best < ranks.shape[1])
            after = rows[at, best[at] + 1]
            ranks[at[after == PAD], best[at[after == PAD]]] = NEVER
            at, after = at[after != PAD], after[after != PAD]
            ranks[at, best[at]] = self.pairs(token[at], after)

    def merged_row(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece.

        A round merges all pairs of the least rank, from the left and as far as
        no new pair has a lower rank: what merging them one by one gives.
        """
        ids = self.bytes[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != NEVER:
            at = np.flatnonzero(ranks == least)
            # Of pairs that share a token the left one merges.
            new = np.append(True, np.diff(at) != 1)
            at = at[(at - at[new][np.cumsum(new) - 1]) % 2 == 0]
            token = np.full(len(at), least, np.int32)
            after_merged = np.append(False, at[:-1] + 2 == at[1:])
            left = np.where(after_merged, token, ids[np.maximum(at - 1, 0)])
            right = ids[np.minimum(at + 2, len(ids) - 1)]
            before = np.where(at > 0, self.pairs(left, token), NEVER)
            behind = np.where(at + 2 < len(ids), self.pairs(token, right), NEVER)
            lower = np.flatnonzero((before < least) | (behind < least))
            if len(lower):
                at = at[: lower[0] + 1]
            ids[at] = least
            ids, ranks = np.delete(ids, at + 1), np.delete(ranks, at)
            at = at - np.arange(len(at))
            for pair in (at[at > 0] - 1, at[at < len(ranks)]):
                ranks[pair] = self.pairs(ids[pair], ids[pair + 1])
        return ids

    def encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has. A piece
        that is a token is that token."""
        whole = np.array([self.ranks.get(piece, PAD) for piece in pieces], np.int32)
        known = np.flatnonzero(whole != PAD)
        parts: list[Encoded] = [(known, np.ones(len(known), np.int64), whole[known])]
        buckets: dict[int, list[int]] = {}
        for n in np.flatnonzero(whole == PAD).tolist():
            if len(pieces[n]) > WIDE:
                ids = self.merged_row(pieces[n])
                parts.append((np.array([n]), np.array([len(ids)]), ids))
            else:
                buckets.setdefault((len(pieces[n]) - 1).bit_length(), []).append(n)
        for width, bucket in buckets.items():
            size = CELLS >> width
            for low in range(0, len(bucket), size):
                some = np.array(bucket[low : low + size])
                for number, sizes, ids in self.merged([pieces[n] for n in some]):
                    parts.append((some[number], sizes, ids))
        number, sizes, ids = map(np.concatenate, zip(*parts))
        order = np.argsort(number)
        return ranges(ids, (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]


def ranges(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges ``values[first : first + size]``, one after another."""
    ahead = np.cumsum(size) - size
    return values[np.repeat(first - ahead, size) + np.arange(size.sum())]


def without(rows: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The matrix without one cell of each row."""
    stays = np.ones(rows.shape, bool)
    stays[np.arange(len(rows)), column] = False
    return rows[stays].reshape(len(rows), rows.shape[1] - 1)


def slices(pattern, text: str) -> Iterator[list[str]]:
    """The pieces of a text, a slice at a time. The last pieces of a slice are
    cut again with what follows, as the pattern looks ahead."""
    at, size, margin = 0, SLICE, 4
    while len(text) - at > size:
        found, end = pattern.findall(text, at, at + size), at + size
        while found and end > at + size - margin:
            end -= len(found.pop())
        if found:
            yield found
            at, size = end, SLICE
        else:
            size *= 2
    yield pattern.findall(text, at)


class Encoder:
    """Encodes texts, and remembers the ids of the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary, pattern):
        self.vocabulary, self.pattern = vocabulary, pattern
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def part(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        piece = np.fromiter(map(known.get, pieces, repeat(PAD)), np.int64, len(pieces))
        missing = np.flatnonzero(piece == PAD).tolist()
        if missing:
            new = list(dict.fromkeys(pieces[n] for n in missing))
            ids, sizes = self.vocabulary.encoded([p.encode() for p in new])
            known.update(zip(new, range(len(known), len(known) + len(new))))
            piece[missing] = [known[pieces[n]] for n in missing]
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
        first, size = self.ends[piece], self.ends[piece + 1] - self.ends[piece]
        return ranges(self.ids, first, size), size

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and how many each has."""
        found, sizes = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
        waiting, owners, held = [], [], 0

        def flush() -> None:
            pieces = [piece for part in waiting for piece in part]
            ids, size = self.part(pieces)
            found.append(ids)
            np.add.at(sizes, np.repeat(owners, [len(part) for part in waiting]), size)

        for n, text in enumerate(texts):
            for part in slices(self.pattern, text):
                waiting.append(part)
                owners.append(n)
                held += sum(map(len, part))
                if held >= SLICE:
                    flush()
                    waiting, owners, held = [], [], 0
        if waiting:
            flush()
        return np.concatenate(found), sizes


def read_ranks(name: str, folder: str | None) -> dict[bytes, int]:
    import public_tokenizers

    with open(f"{folder}/{name}.tiktoken" if folder else public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def encode(docs: DataFrame, text_col: str = "text", name: str = NAME, folder: str | None = None) -> DataFrame:
    """Add ``ids`` (array of int) and ``n_tokens`` of each text by the ranks in
    ``name.tiktoken`` of ``folder`` (by default that of the public tokenizers).

    The ids are those of ordinary text: special tokens' strings count as text.
    Null and empty texts have no ids. Columns named ``ids`` or ``n_tokens`` make
    room, others stay; repeated rows and null ids of rows make no difference.
    An empty table gives an empty table.

    At scale: no shuffle, one pass over the texts. A task holds a batch, its
    ids, and at most 200,000 distinct pieces. A text is cut half a million
    characters at a time; a piece of n bytes without a break, as of one letter repeated,
    takes as many rounds over it as it has different ranks to merge.
    """

    def run(batches: Batches[pa.Array]) -> Batches[pa.Array]:
        import public_tokenizers
        import regex

        single_threaded()
        encoder = Encoder(Vocabulary(read_ranks(name, folder)), regex.compile(public_tokenizers.PATTERN))
        for batch in batches:
            # Each different text of a batch is encoded once, a few at a time.
            texts = batch.dictionary_encode()
            lists = pa.concat_arrays([ids_of(encoder, part) for part in portions(texts.dictionary)])
            for rows in portions(texts.indices):
                yield lists.take(rows)
            del batch, texts, lists, rows
            pa.default_memory_pool().release_unused()

    ids = F.arrow_udf(run, "array<int>")(text_of(text_col))
    return replaced(replaced(docs, ids=ids), n_tokens=F.size("ids").cast("bigint"))


def decode(docs: DataFrame, ids_col: str = "ids", name: str = NAME, folder: str | None = None) -> DataFrame:
    """Add ``decoded``, the bytes the ids stand for.

    Null ids, and ids that hold null or a number the vocabulary has not, give
    null; no ids give no bytes. A column of that name makes room.
    """

    def run(batches: Batches[pa.Array]) -> Batches[pa.Array]:
        single_threaded()
        tokens = {rank: token for token, rank in read_ranks(name, folder).items()}
        for batch in batches:
            for rows in portions(batch):
                yield pa.array([joined(tokens, row) for row in rows], pa.binary())
            del batch, rows
            pa.default_memory_pool().release_unused()

    return replaced(docs, decoded=F.arrow_udf(run, "binary")(col(ids_col)))


def portions(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch in portions of rows (one at least): as Python values texts and
    ids take up several times their size."""
    for low in range(0, max(len(batch), 1), PORTION):
        yield batch.slice(low, PORTION)


def ids_of(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    ids, sizes = encoder(texts.to_pylist())
    ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32()))


def joined(tokens: dict[int, bytes], row: pa.ListScalar) -> bytes | None:
    if not row.is_valid or row.values.null_count:
        return None
    try:
        return b"".join(map(tokens.__getitem__, row.values.to_numpy().tolist()))
    except KeyError:
        return None


def ids_text(ids: Column) -> Column:
    """Decimal ids, joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
