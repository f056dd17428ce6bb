"""Sum-of-squares online packing of token sequences.

Each task packs the documents of its partition as they come. A document fills
whole windows first; its rest goes to the fill level that keeps the sum of
squares of the numbers of partially filled windows smallest (Csirik et al.),
tracked in an array over levels. At the end of the partition the emptiest open
windows are cut up to fill the fullest, so one partial window is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tradeloom.llm.common import col, single_threaded, text_of

LENGTH = 1024
END = 0
#: Open windows a task keeps; beyond it they are closed as at the end.
MOST_OPEN = 4096
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)

Encoder = Callable[[list[str]], list[list[int]]]


def byte_bpe(name: str = "byte_bpe_50k", folder: str | None = None) -> Encoder:
    """Ids of a public byte-level BPE, as ``tokenizers`` gives them for
    ``name.json`` without added special tokens.

    ``tiktoken`` reads the same vocabulary as ranks and is several times
    faster. A text that holds the string of a special token goes to
    ``tokenizers``, which knows it.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = (lambda file: f"{folder}/{file}") if folder else public_tokenizers.path
    plain = Tokenizer.from_file(path(f"{name}.json"))
    special = [token.content for token in plain.get_added_tokens_decoder().values()]
    with open(path(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        known: dict[str, list[int]] = {}
        for text in texts:
            if text not in known:
                if any(token in text for token in special):
                    known[text] = plain.encode(text, add_special_tokens=False).ids
                else:
                    known[text] = fast.encode_ordinary(text)
        return [known[text] for text in texts]

    return encode


@dataclass
class Piece:
    """Part of a document: its ids from ``start`` on."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


@dataclass
class Window:
    level: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.level += len(piece.ids)


class SumOfSquares:
    """Open windows by fill level, and ``counts``, how many each level has."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.counts = np.zeros(length + 1, np.int64)
        self.open: list[list[Window]] = [[] for _ in range(length + 1)]

    def level_for(self, size: int) -> int:
        """The level (0: a new window) that keeps the sum of squares smallest;
        of equal ones the fullest."""
        change = np.where(self.counts[: self.length - size + 1] > 0, 1 - 2 * self.counts[: self.length - size + 1], self.length**3)
        change[0] = 0
        change = change + 2 * self.counts[size:] + 1
        change[-1] -= 2 * self.counts[self.length] + 1  # a full window is not open
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> Window | None:
        """Put a piece into a window; the window, if that fills it."""
        level = self.level_for(len(piece.ids))
        window = Window()
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        window.put(piece)
        if window.level == self.length:
            return window
        self.open[window.level].append(window)
        self.counts[window.level] += 1
        return None

    def close(self) -> Iterator[Window]:
        """All open windows, after the emptiest were cut up to fill the fullest."""
        left = [window for windows in self.open for window in windows]
        self.__init__(self.length)
        while left:
            full = left.pop()
            while full.level < self.length and left:
                donor = left[0]
                piece, room = donor.pieces.pop(), self.length - full.level
                n = len(piece.ids)
                if n > room:
                    donor.pieces.append(Piece(piece.doc_id, piece.start, piece.ids[: n - room], piece.doc_tokens))
                    piece = Piece(piece.doc_id, piece.start + n - room, piece.ids[n - room :], piece.doc_tokens)
                donor.level -= len(piece.ids)
                full.put(piece)
                if not donor.pieces:
                    left.pop(0)
            yield full


def pack_partition(
    documents: Iterator[tuple[int | None, list[int]]], length: int = LENGTH
) -> Iterator[Window]:
    """Windows of a stream of documents, each as it closes."""
    packer = SumOfSquares(length)
    for doc_id, ids in documents:
        ids, total = np.asarray(ids, dtype="<u4"), len(ids)
        whole = total - total % length
        for start in range(0, whole, length):
            window = Window()
            window.put(Piece(doc_id, start, ids[start : start + length], total))
            yield window
        if whole < total:
            full = packer.place(Piece(doc_id, whole, ids[whole:], total))
            if full:
                yield full
            if packer.counts.sum() >= MOST_OPEN:
                yield from packer.close()
    yield from packer.close()


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    encoder: Callable[[], Encoder] = byte_bpe,
) -> DataFrame:
    """Pack documents into sequences of at most ``length`` tokens.

    A document is its text's ids and then id 0. Returns a row for each piece:
    ``doc_id, start`` (ids of the document before it), ``length, ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers), ``doc_tokens`` (with
    the final id), ``sequence_id`` and ``offset`` (ids before it there). Null
    and empty texts are the one id 0. Null ids and repeated rows are documents
    of their own. An empty table gives an empty table; other columns are not
    read.

    At scale: no shuffle. A task packs its own partition and holds one batch
    and its open windows, at most 4,096. Each partition leaves one sequence
    that is not full. A sequence number is the partition's number and a count,
    so a task that is run again gives the same rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        encode = encoder()

        def documents() -> Iterator[tuple[int | None, list[int]]]:
            for batch in batches:
                for low in range(0, len(batch), 64):
                    part = batch.iloc[low : low + 64]
                    ids = [None if missing else int(i) for i, missing in zip(part["i"], part["i"].isna())]
                    for doc_id, tokens in zip(ids, encode(part["t"].tolist())):
                        yield doc_id, [*tokens, END]

        rows, number = [], TaskContext.get().partitionId() << 40
        for window in pack_partition(documents(), length):
            offset = 0
            for piece in window.pieces:
                n = len(piece.ids)
                rows.append((piece.doc_id, piece.start, n, zlib.crc32(piece.ids.tobytes()), piece.doc_tokens, number, offset))
                offset += n
            number += 1
            if len(rows) >= 10_000:
                yield frame(rows)
                rows = []
        yield frame(rows)

    return docs.select(col(id_col).cast("bigint").alias("i"), text_of(text_col).alias("t")).mapInPandas(run, SCHEMA)


def frame(rows: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({name: "Int64" if name == "doc_id" else "int64" for name in names})
