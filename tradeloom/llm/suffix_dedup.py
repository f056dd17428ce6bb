"""Suffix-array dedup: remove every byte of a string that occurs elsewhere too.

The sorted suffixes of all texts are never built as one array. They are merged
from shards, each a Burrows-Wheeler transform: right contexts in sorted order,
with the bytes to their left as columns. Three steps keep the work small.

1. Anchors. Each window of ``length`` bytes owns one anchor, the position of the
   smallest hash among its first positions, so equal windows own equal anchors
   at the same offset. All windows of an anchor hold the same bytes after it
   (its core). An anchor whose core occurs nowhere else has no repeated window
   and leaves here; one whose windows all occur together elsewhere is settled.
2. Merge. What is left are anchors with a shared core and different
   surroundings. Shards of them, sorted by what follows the core, are merged by
   refining their interleave one word at a time: only blocks that still hold
   several suffixes are looked at again, and the word at which a block splits
   gives the common prefix of its neighbours.
3. Steps to the left. From the merged order the byte before each suffix leads,
   as in a BWT, to the order of the suffixes one byte longer: a stable
   partition, with the common prefix of new neighbours the least one between
   them. A window is repeated if its neighbour shares enough to the right.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tradeloom.llm.common import id_key, replaced, single_threaded, text_of
from tradeloom.llm.rolling import Substrings, mixed
from tradeloom.operators.stage import staged

LENGTH = 400
#: Bytes taken into numpy at a time; longer texts overlap by ``length``.
PIECE = 1 << 19
#: Anchors of one core that are merged in one group; more go window by window.
MOST_MERGED = 50_000
MERGED_AT_ONCE = 20_000
BITS = 10

#: What becomes of an anchor.
SETTLED, OPEN, SETTLED_PARTNER = 1, 2, 3


class Anchors:
    """How anchors are chosen for windows of ``length`` bytes."""

    def __init__(self, length: int):
        if length < 8:
            raise ValueError("length must be at least 8 bytes")
        self.length = length
        self.gram = 1 << min(4, (length // 4).bit_length() - 1)
        self.width = min(length * 2 // 5, 1 << BITS - 1)
        self.core = length - self.width + 1

    def grams(self, data: np.ndarray) -> np.ndarray:
        """A 32-bit hash of the ``gram`` bytes from each position."""
        h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        size = 1
        while size < self.gram:
            h = self._joined(h, h, size)
            size *= 2
        h = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA77)
        return (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE3D)

    @staticmethod
    def _joined(left: np.ndarray, right: np.ndarray, by: int) -> np.ndarray:
        out = left * np.uint32(0x2C1B3C6D)
        out ^= out >> np.uint32(16)
        if by < len(right):
            out[: len(out) - by] += right[by:]
        return out

    def runs(self, data: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchor, first and last window start of each run of windows with the
        same anchor; pieces lie in ``data`` from ``starts`` to ``ends``."""
        key = self.grams(data).astype(np.uint64) << np.uint64(32) | np.arange(len(data), dtype=np.uint64)
        size = 1
        while size * 2 <= self.width:
            key[: len(key) - size] = np.minimum(key[: len(key) - size], key[size:])
            size *= 2
        rest = self.width - size
        if rest and rest < len(key):
            key[: len(key) - rest] = np.minimum(key[: len(key) - rest], key[rest:])
        anchor = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        counts = np.maximum(ends - starts - self.length + 1, 0)
        window = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        own = anchor[window]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(own)) - 1 if len(first) else first
        return own[first], window[first], window[last]


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of bytes with where their pieces start and end, which text each is
    from, and its place there."""
    block, size = [], 0
    for n, text in enumerate(texts):
        for low in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[low : low + PIECE + length - 1]
            if len(part) < length:
                continue
            block.append((n, low, part))
            size += len(part)
            if size >= PIECE:
                yield as_block(block)
                block, size = [], 0
    if block:
        yield as_block(block)


def as_block(block: list[tuple[int, int, bytes]]):
    sizes = np.array([len(part) for _, _, part in block])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(part for _, _, part in block), np.uint8)
    return data, ends - sizes, ends, np.array([n for n, _, _ in block]), np.array([low for _, low, _ in block])


def find_anchors(length: int):
    """``core, whole, doc, at, weight`` of the anchors of all texts.

    ``at`` packs the first window start, and how far before the anchor the
    first and the last window start. Equal anchors with equal surroundings of
    one batch become one row of weight 2; the others are settled, and go on
    under a core of their own.
    """
    chosen = Anchors(length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        for batch in batches:
            docs = batch["doc"].to_numpy(np.int64)
            found = []
            for data, starts, ends, texts, lows in pieces([bytes(t) for t in batch["t"]], length):
                anchor, first, last = chosen.runs(data, ends, starts)
                if not len(anchor):
                    continue
                strings = Substrings(data)
                most, least = anchor - first, anchor - last
                core = strings.hashes(anchor, anchor + chosen.core)
                whole = mixed(strings.hashes(first, last + length) + (most << BITS | least).astype(np.uint64))
                piece = np.searchsorted(ends, anchor, side="right")
                at = (lows[piece] + first - starts[piece]) << 2 * BITS | most << BITS | least
                found.append((core, whole, docs[texts[piece]], at))
            if not found:
                continue
            core, whole, doc, at = map(np.concatenate, zip(*found))
            order = np.lexsort((whole, core))
            core, whole, doc, at = core[order], whole[order], doc[order], at[order]
            same = np.zeros(len(core), bool)
            same[1:] = (core[1:] == core[:-1]) & (whole[1:] == whole[:-1])
            weight = np.where(np.append(same[1:], False) | same, 2, 1).astype(np.int32)
            core = np.where(same, mixed(doc.astype(np.uint64) * np.uint64(31) + at.astype(np.uint64), 3), core)
            yield pd.DataFrame(
                {"core": core.astype(np.int64), "whole": whole.astype(np.int64), "doc": doc, "at": at, "weight": weight}
            )

    return run


def surroundings(length: int):
    """For the open anchors of a text the bytes left of the anchor (nearest
    first) and right of the core, each shard sorted by the latter; or, for
    cores of very many anchors, a row for each window."""
    chosen = Anchors(length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        for batch in batches:
            rows = []
            for doc, text, anchors in zip(batch["doc"], batch["t"], batch["anchors"]):
                text = bytes(text)
                for anchor in anchors:
                    at, core, kind = anchor["at"], anchor["core"], anchor["kind"]
                    first, most, least = at >> 2 * BITS, at >> BITS & (1 << BITS) - 1, at & (1 << BITS) - 1
                    place = first + most
                    if anchor["crowd"] > MOST_MERGED:
                        last = place - least
                        data = np.frombuffer(text[first : last + length], np.uint8)
                        begin = np.arange(last - first + 1)
                        strings = Substrings(data)
                        keys = strings.hashes(begin, begin + length)
                        halves = strings.hashes(begin, begin + length // 2)
                        rows += [
                            (int(k), int(h), None, None, doc, int(first + b), 0, 0, kind)
                            for k, h, b in zip(keys.astype(np.int64), halves.astype(np.int64), begin)
                        ]
                        continue
                    left = text[first:place][::-1]
                    right = text[place + chosen.core : place - least + length]
                    rows.append((core, 0, left, right, doc, place, most, least, kind))
            rows.sort(key=lambda row: (row[0], row[1], row[3] or b""))
            out = pd.DataFrame(rows, columns=["core", "half", "left", "right", "doc", "place", "most", "least", "kind"])
            yield out.astype({"core": "int64", "half": "int64", "doc": "int64", "place": "int64", "most": "int32", "least": "int32", "kind": "int32"})

    return run


def as_matrix(strings: list[bytes], width: int) -> np.ndarray:
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)


def refined_interleave(group: np.ndarray, right: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted shards of each group: the order of all right contexts, and
    the length of the common prefix with the one before (-1 at a new group).

    The interleave starts as the shards one after another. For each word, the
    blocks that hold several contexts equal so far are partitioned by it.
    """
    words = right.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = group[order][1:] != group[order][:-1]
    common = np.where(new, -1, 0)
    for k in range(words.shape[1]):
        block = np.cumsum(new) - 1
        busy = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(busy):
            break
        word = words[order[busy], k]
        within = np.lexsort((word, block[busy]))
        order[busy] = order[busy][within]
        word = word[within]
        follows = ~new[busy]
        apart = np.zeros(len(busy), bool)
        apart[1:] = (word[1:] != word[:-1]) & follows[1:]
        equal = 8 * k + common_bytes(word[1:], word[:-1])
        common[busy[1:]] = np.where(follows[1:], equal, common[busy[1:]])
        new[busy[apart]] = True
    # Contexts that are equal to the end: the shorter one first.
    block = np.cumsum(new) - 1
    order = order[np.lexsort((size[order], block))]
    inside = common >= 0
    least = np.minimum(size[order][1:], size[order][:-1])
    common[1:] = np.where(inside[1:], np.minimum(common[1:], least), common[1:])
    return order, common


def common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes two big-endian words share."""
    differ = a ^ b
    n = np.zeros(len(differ), np.int64)
    for shift in range(56, -8, -8):
        n += differ < np.uint64(1 << shift) if shift else differ == 0
    return n


class LeastBetween:
    """Least value over ranges, from tables of doubling width."""

    def __init__(self, values: np.ndarray):
        self.tables, size = [values], 1
        while size * 2 <= len(values):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-size], last[size:]))
            size *= 2
        self.flat = np.concatenate([np.pad(t, (0, len(values) - len(t))) for t in self.tables])
        self.n = len(values)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Over ``low .. high``, both inclusive."""
        level = np.log2(high - low + 1).astype(np.int64)
        base = level * self.n
        return np.minimum(self.flat[base + low], self.flat[base + high + 1 - (1 << level)])


def repeated_windows(
    group: np.ndarray, left: list[bytes], right: list[bytes], most: np.ndarray, least: np.ndarray, width: int
) -> np.ndarray:
    """``hit[i, o]``: whether the window that starts ``o`` bytes before anchor
    ``i`` occurs at another anchor of its group."""
    n, reach = len(group), width - 1
    hit = np.zeros((n, width), bool)
    if n < 2:
        return hit
    sizes = np.array([len(r) for r in right])
    order, common = refined_interleave(group, as_matrix(right, reach), sizes)
    between = LeastBetween(common)
    lefts = np.ascontiguousarray(as_matrix(left, reach).T)
    place = np.arange(n)  # in the merged order, of what is still active
    new = common < 0
    for o in range(width):
        if o:
            # One step to the left: a stable partition by the byte before.
            stays = most[order[place]] >= o
            block = np.cumsum(new) - 1
            place, block = place[stays], block[stays]
            byte = lefts[o - 1][order[place]]
            new = np.ones(len(place), bool)
            new[1:] = block[1:] != block[:-1]
            if ((byte[1:] != byte[:-1]) & ~new[1:]).any():
                within = np.lexsort((byte, block))
                place, block, byte = place[within], block[within], byte[within]
                new[1:] = (block[1:] != block[:-1]) | (byte[1:] != byte[:-1])
        # A suffix alone in its class has no partner now or later.
        with_next = np.append(~new[1:], False)
        busy = ~new | with_next
        place, new = place[busy], new[busy]
        if not len(place):
            break
        shared = np.full(len(place), -1)
        inner = np.flatnonzero(~new)
        shared[inner] = between(place[inner - 1] + 1, place[inner])
        enough = shared >= reach - o
        hit[order[place[enough]], o] = True
        hit[order[place[np.flatnonzero(enough) - 1]], o] = True
    offsets = np.arange(width)
    return hit & (offsets >= least[:, None]) & (offsets <= most[:, None])


def spans_of(hit: np.ndarray, doc: np.ndarray, place: np.ndarray, length: int) -> pd.DataFrame:
    """Byte spans that runs of repeated windows cover."""
    edge = np.zeros((len(hit), hit.shape[1] + 2), np.int8)
    edge[:, 1:-1] = hit
    change = np.diff(edge, axis=1)
    row, low = np.nonzero(change == 1)
    high = np.nonzero(change == -1)[1] - 1
    return pd.DataFrame({"doc": doc[row], "start": place[row] - high, "end": place[row] - low + length})


def merge_shards(length: int):
    """Spans of the repeated windows of open anchors; rows come sorted by core."""
    width = Anchors(length).width

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        group = np.unique(rows["core"].to_numpy(), return_inverse=True)[1]
        hit = repeated_windows(
            group, list(rows["left"]), list(rows["right"]), rows["most"].to_numpy(), rows["least"].to_numpy(), width
        )
        hit &= (rows["kind"] == OPEN).to_numpy()[:, None]
        return spans_of(hit, rows["doc"].to_numpy(), rows["place"].to_numpy(), length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        waiting, held, before = [], 0, None
        for batch in batches:
            single = batch["left"].isna().to_numpy()
            if single.any():
                # Windows one by one: a row is repeated if its neighbour is equal.
                rows = batch[single] if before is None else pd.concat([before, batch[single]])
                same = (rows["core"].to_numpy()[1:] == rows["core"].to_numpy()[:-1]) & (
                    rows["half"].to_numpy()[1:] == rows["half"].to_numpy()[:-1]
                )
                repeated = np.append(same, False) | np.append(False, same)
                found = rows[repeated & (rows["kind"] != SETTLED_PARTNER).to_numpy()]
                yield pd.DataFrame({"doc": found["doc"], "start": found["place"], "end": found["place"] + length})
                before = rows.iloc[-1:]
            batch = batch[~single]
            if not len(batch):
                continue
            waiting.append(batch)
            held += len(batch)
            if held >= MERGED_AT_ONCE:
                rows = pd.concat(waiting, ignore_index=True)
                last = rows["core"].to_numpy() == rows["core"].iloc[-1]
                yield merged(rows[~last])
                waiting, held = [rows[last]], int(last.sum())
        if waiting:
            yield merged(pd.concat(waiting, ignore_index=True))

    return run


def cut(text: bytes, spans) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs, and what is left."""
    kept, removed, runs, at = [], 0, 0, 0
    reached = -1
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if start > reached:
            runs += 1
            kept.append(text[at:start])
        if end > at:
            removed += end - max(start, at)
            at = end
        reached = max(reached, end)
    kept.append(text[at:])
    return removed, runs, b"".join(kept)


def without_spans(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = [(0, 0, bytes(t)) if s is None else cut(bytes(t), s) for t, s in zip(texts, spans)]
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept"])


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """``doc, spans`` for texts of ``doc, t`` that hold repeated bytes."""
    found = docs.filter(F.length("t") >= length).mapInPandas(
        find_anchors(length), "core bigint, whole bigint, doc bigint, at bigint, weight int"
    )
    by_core = Window.partitionBy("core")
    in_order = by_core.orderBy("whole")
    first = F.coalesce(F.lag("whole").over(in_order) != F.col("whole"), F.lit(True))
    again = F.coalesce(F.lead("whole").over(in_order) == F.col("whole"), F.lit(False))
    kinds = (
        found.select("core", "doc", "at", first.alias("first"), (again | ~first | (F.col("weight") > 1)).alias("twice"))
        .withColumn("crowd", F.sum(F.col("first").cast("int")).over(by_core))
        .filter("twice OR crowd > 1")
        .select(
            "core",
            "doc",
            "at",
            "crowd",
            F.when(~F.col("twice"), OPEN)
            .when(F.col("first") & (F.col("crowd") > 1), SETTLED_PARTNER)
            .otherwise(SETTLED)
            .alias("kind"),
        )
    )
    kinds = staged(kinds, "anchors")
    first_start = F.shiftright("at", 2 * BITS)
    last_start = first_start + F.shiftright("at", BITS).bitwiseAND(F.lit((1 << BITS) - 1)) - F.col("at").bitwiseAND(F.lit((1 << BITS) - 1))
    settled = kinds.filter(F.col("kind") != OPEN).select(
        "doc", first_start.alias("start"), (last_start + length).alias("end")
    )
    open_ = (
        kinds.filter(F.col("kind") != SETTLED)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("core", "at", "crowd", "kind")).alias("anchors"))
    )
    shards = docs.join(open_.hint("shuffle_hash"), "doc").select("doc", "t", "anchors").mapInPandas(
        surroundings(length),
        "core bigint, half bigint, left binary, right binary, doc bigint, place bigint, most int, least int, kind int",
    )
    merged = shards.repartition("core").sortWithinPartitions("core", "half").mapInPandas(
        merge_shards(length), "doc bigint, start bigint, end bigint"
    )
    return settled.union(merged).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def dedup_substrings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove each byte that a string of ``length`` bytes covers which also
    starts anywhere else, in the same text or another.

    Texts are their UTF-8 bytes, null is empty; strings never cross texts and
    are judged on the input. Adds ``n_bytes, n_removed, n_spans`` (maximal
    removed runs) and ``kept``, the bytes left, to the input's columns (columns
    of these names make room). ``kept`` may start or end within a character.
    Texts shorter than ``length`` stay. Repeated rows are copies of each other;
    ids may be null or repeat. An empty table gives an empty table.

    At scale: an anchor, about one for 80 bytes, is a row of a few numbers, and
    equal anchors of a batch are one row before the shuffle. Texts are shuffled
    twice, to meet their open anchors and their spans. A task merges the cores
    it was dealt about 20,000 anchors at a time; a core with more than 50,000
    different surroundings is compared window by window instead, which needs no
    group. Nothing is collected or broadcast.
    """
    keyed = docs.withColumn("__t", text_of(text_col).cast("binary")).withColumn(
        "__doc", F.xxhash64(id_key(id_col), "__t")
    )
    cut_out = F.pandas_udf(without_spans, "n_removed bigint, n_spans bigint, kept binary")
    spans = repeated_spans(keyed.select(F.col("__doc").alias("doc"), F.col("__t").alias("t")), length)
    joined = keyed.join(
        spans.select(F.col("doc").alias("__doc"), F.col("spans").alias("__spans")).hint("shuffle_hash"), "__doc", "left"
    ).withColumn("__cut", cut_out("__t", "__spans"))
    return replaced(
        joined,
        n_bytes=F.length("__t").cast("bigint"),
        n_removed=F.col("__cut.n_removed"),
        n_spans=F.col("__cut.n_spans"),
        kept=F.col("__cut.kept"),
    ).drop("__t", "__doc", "__spans", "__cut")
