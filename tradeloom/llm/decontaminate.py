"""Benchmark decontamination by pigeonhole edit matching.

A text that holds an item with at most e edits holds one of e + 1 pieces of the
item unchanged. Pieces are found with an automaton over all of them in one pass
over the text, and each hit is verified with the bit-parallel edit distance of
Myers, in a window as long as the item and its error budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import col, one_by_one, text_of

SCHEMA = "doc_id bigint, item_id bigint, distance int, start int, end int"


@dataclass(frozen=True)
class Item:
    item_id: int
    text: str
    errors: int

    def pieces(self) -> Iterator[tuple[int, str]]:
        """``errors + 1`` pieces of about equal length, with their places."""
        n, parts = len(self.text), self.errors + 1
        for k in range(parts):
            yield n * k // parts, self.text[n * k // parts : n * (k + 1) // parts]


def folded(text: str) -> str:
    """Lower case with all places kept: U+0130, the one character whose lower
    case is two, becomes ``i``."""
    return text.replace("\u0130", "i").lower()


def error_budget(length: int, error_rate: float, least_piece: int) -> int:
    return max(0, min(int(length * error_rate), length // least_piece - 1))


def best_end(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a piece of ``text``, and where the
    first such piece ends (Myers 1999: a column of the table as two bit rows)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


def verified(item: Item, text: str, place: int) -> tuple[int, int, int] | None:
    """``distance, start, end`` of the item about ``place``, if within budget."""
    low = max(0, place - item.errors)
    window = text[low : place + len(item.text) + item.errors]
    if window[place - low : place - low + len(item.text)] == item.text:
        return 0, place, place + len(item.text)
    distance, end = best_end(item.text, window)
    if distance > item.errors:
        return None
    back, begin = best_end(item.text[::-1], window[:end][::-1])
    return distance, low + end - begin, low + end


class Matcher:
    """All items' pieces in one automaton."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.automaton, self.owners = ahocorasick.Automaton(), {}
        self.items = items
        for number, item in enumerate(items):
            for place, piece in item.pieces():
                self.owners.setdefault(piece, []).append((number, place))
        for piece, owners in self.owners.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if self.owners:
            self.automaton.make_automaton()

    def search(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Per item the best ``distance, start, end``, the first of equal ones."""
        found: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, tuple[int, int]] = {}
        if not self.owners:
            return found
        text = folded(text)
        for last, (length, owners) in self.automaton.iter(text):
            for number, offset in owners:
                item, place = self.items[number], last + 1 - length - offset
                low, high = tried.get(number, (0, -1))
                if found.get(number, (1,))[0] == 0 or low <= place <= high:
                    continue
                hit = verified(item, text, place)
                # Pieces of one occurrence give nearly the same place.
                tried[number] = (place, place)
                if hit and (number not in found or hit < found[number]):
                    found[number] = hit
        return found


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.05,
    least_piece: int = 16,
    block_bytes: int = 16 * 2**20,
) -> DataFrame:
    """Which documents hold which benchmark items, whole, up to a few edits.

    An item of n characters may differ by ``error_rate * n`` edits, as long as
    its pieces keep ``least_piece`` characters; shorter items must be found
    unchanged. Case makes no difference. Returns ``doc_id, item_id, distance,
    start, end``: for each document and item the occurrence of the smallest
    distance, the first of equal ones, in code points. Null and empty texts
    hold nothing, null and empty items are found nowhere; null ids are
    reported as null. Repeated documents are reported as often, repeated items
    too. An empty table on either side gives an empty table.

    At scale: the items go to the tasks in blocks of ``block_bytes``, cut by
    their running size, and each block is one pass over the documents; neither
    is shuffled. The driver holds one block at a time, a task one batch of texts
    and one block.
    """
    items = benchmark.select(
        col(item_id_col).cast("bigint").alias("item_id"), text_of(item_text_col).alias("text")
    ).filter("text <> ''")
    texts = docs.select(col(id_col).cast("bigint").alias("i"), text_of(text_col).alias("t"))
    passes = (
        texts.mapInPandas(
            matcher([Item(i, folded(t), error_budget(len(t), error_rate, least_piece)) for i, t in block]), SCHEMA
        )
        for block in blocks_of(items, block_bytes)
    )
    return one_by_one(passes, "benchmark-hits") or docs.sparkSession.createDataFrame([], SCHEMA)


def blocks_of(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items in order, in blocks of about ``block_bytes`` each."""
    block, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        block.append((row.item_id, row.text))
        size += 2 * len(row.text) + 100
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def matcher(items: list[Item]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = Matcher(items).search
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [
                (None if pd.isna(doc) else int(doc), items[n].item_id, *hit)
                for doc, text in zip(batch["i"], batch["t"])
                for n, hit in search(text).items()
            ]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"doc_id": "Int64", "item_id": "Int64", "distance": "int32", "start": "int32", "end": "int32"})

    return run
