"""Minimax contiguous sharding (DataFrame functions only).

Equal texts are one atomic group. Groups stand in the order of a 64-bit hash of
their text, and each shard takes a contiguous piece of that order. The smallest
capacity that a greedy pass can keep within the number of shards is found by
binary search, and the order is cut under that capacity.

The search needs the sizes of all groups in order, which do not fit the driver.
It works on segments of the hash range instead: at first 4,096 of them, with
their bytes. A segment of one group is atomic. Greedy passes that may cut the
other segments anywhere, and passes that may not cut them at all, bound each
cut from both sides; only segments between the bounds are split into 256 and
counted again. The search ends when no bound depends on an unsplit segment, so
the result is that of a greedy pass over all groups.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import col, id_key, text_of
from tradeloom.operators.stage import staged

FIRST_BITS, MORE_BITS = 12, 8
RECORD_BYTES = 8


@dataclass(frozen=True)
class Segment:
    """Groups whose hash starts with ``prefix`` in ``bits`` bits."""

    prefix: int
    bits: int
    size: int
    low: int
    high: int

    @property
    def atomic(self) -> bool:
        return self.low == self.high


def segments_of(sized: DataFrame, bits: int, within: list[int] | None = None, outer: int = 0) -> list[Segment]:
    """Segments of ``bits`` bits, all or within some of ``outer`` bits; their
    number is bounded by the bits, not by the data."""
    if within is not None:
        sized = sized.filter(F.shiftright("h", 64 - outer).isin(within))
    rows = (
        sized.groupBy(F.shiftright("h", 64 - bits).alias("prefix"))
        .agg(F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high"))
        .collect()
    )
    return sorted((Segment(r.prefix, bits, r.size, r.low, r.high) for r in rows), key=lambda s: s.low)


class Line:
    """The segments in order, as positions in bytes."""

    def __init__(self, segments: list[Segment]):
        self.segments = segments
        self.ends = list(accumulate(s.size for s in segments))
        self.starts = [end - s.size for end, s in zip(self.ends, segments)]
        self.total = self.ends[-1] if segments else 0

    def at(self, position: int) -> int:
        """Index of the segment that holds the byte at ``position``."""
        return min(bisect_right(self.ends, position), len(self.segments) - 1)

    def reach(self, start: int, capacity: int, divisible: bool) -> int:
        """Where a shard from ``start`` ends; ``divisible``: segments of
        several groups can be cut anywhere."""
        end = start + capacity
        if end >= self.total:
            return self.total
        k = self.at(end)
        if divisible and not self.segments[k].atomic:
            return end
        return max(start, self.starts[k])

    def cuts(self, capacity: int, shards: int, divisible: bool, start: int = 0) -> list[int]:
        cuts = []
        for _ in range(shards):
            start = self.reach(start, capacity, divisible)
            cuts.append(start)
        return cuts

    def smallest(self, shards: int, divisible: bool) -> int:
        """Binary search of the smallest capacity that suffices."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, divisible)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return high


def refined(sized: DataFrame, line: Line, wanted: set[int]) -> Line:
    """The line with the wanted segments split; one job for each depth."""
    kept = [s for i, s in enumerate(line.segments) if i not in wanted]
    for bits in sorted({line.segments[i].bits for i in wanted}):
        prefixes = [line.segments[i].prefix for i in wanted if line.segments[i].bits == bits]
        kept += segments_of(sized, min(64, bits + MORE_BITS), prefixes, bits)
    return Line(sorted(kept, key=lambda s: s.low))


def smallest_capacity(sized: DataFrame, line: Line, shards: int) -> tuple[int, Line]:
    while True:
        least, most = line.smallest(shards, True), line.smallest(shards, False)
        unsure = set()
        for near, far in zip(line.cuts(least, shards, False), line.cuts(most, shards, True)):
            if near < line.total:
                span = range(line.at(near), line.at(max(near, far)) + 1)
                unsure.update(k for k in span if not line.segments[k].atomic)
        if least == most or not unsure:
            return most, line
        line = refined(sized, line, unsure)


def spread_cuts(sized: DataFrame, line: Line, shards: int, capacity: int) -> list[int]:
    """Segment index at which each shard but the first starts.

    Each cut is the boundary nearest to an equal share of what is left, as far
    as the shard keeps the capacity and the rest can keep it.
    """
    while True:
        start, cuts, unsure = 0, [], set()
        for left in range(shards, 1, -1):
            aim = start + (line.total - start) // left
            k = line.at(aim) if line.segments else 0
            if line.segments and not line.segments[k].atomic:
                unsure.add(k)
            near = sorted({line.starts[k], line.ends[k]}, key=lambda p: abs(p - aim)) if line.segments else [0]
            fits = [
                p
                for p in near
                if start <= p <= start + capacity and line.cuts(capacity, left - 1, False, p)[-1] >= line.total
            ]
            start = fits[0] if fits else line.reach(start, capacity, False)
            cuts.append(start)
        if not unsure:
            return [bisect_right(line.ends, p) for p in cuts]
        line_next = refined(sized, line, unsure)
        line.segments, line.starts, line.ends, line.total = (
            line_next.segments, line_next.starts, line_next.ends, line_next.total,
        )


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    slots_per_task: int = 250_000,
) -> DataFrame:
    """Put each row into one of ``shards`` shards of nearly equal bytes.

    Returns ``doc_id, size, text_crc32, shard, slot``, one row per input row.
    ``size`` is the text's UTF-8 bytes plus 8 for the record; null text has no
    bytes and is equal to empty text. Equal texts share a shard. ``slot``
    numbers the rows of a shard from 0 without gaps. Repeated rows and null ids
    are rows like any other. Fewer groups than shards leave shards empty; an
    empty table gives an empty table. Extra columns are not read.

    The law is ``bytes``: no cut of the hash order has a smaller largest shard.
    A group larger than the mean share sets that largest shard, and the other
    rows spread over the other shards.
    """
    text = text_of(text_col)
    sized = staged(
        docs.select(
            col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        ),
        "shard-sizes",
    )
    capacity, line = smallest_capacity(sized, Line(segments_of(sized, FIRST_BITS)), shards)
    cuts = spread_cuts(sized, line, shards, capacity)
    lows = [line.segments[k].low for k in cuts if k < len(line.segments)]
    shard = reduce(lambda n, low: n + (F.col("h") >= low).cast("int"), lows, F.lit(0)).cast("int")
    return with_slots(sized.withColumn("shard", shard), slots_per_task)


def with_slots(sharded: DataFrame, slots_per_task: int) -> DataFrame:
    """Number the rows of each shard from 0: rows are numbered within a lane of
    the shard, and the rows of the lanes before are added. Lanes are dealt by
    the id, so a large group of equal texts falls into many of them."""
    lanes = max(1, -(-sharded.count() // slots_per_task))
    laned = sharded.withColumn("lane", F.pmod(F.xxhash64(id_key("doc_id"), "size", F.lit(7)), F.lit(lanes * 8)))
    counts = laned.groupBy("shard", "lane").agg(F.count("*").alias("rows"))
    before = counts.selectExpr(
        "shard",
        "lane",
        "sum(rows) OVER (PARTITION BY shard ORDER BY lane) - rows AS before",
    )
    numbered = laned.selectExpr("*", "row_number() OVER (PARTITION BY shard, lane ORDER BY doc_id, h) - 1 AS own")
    return numbered.join(before, ["shard", "lane"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("own") + F.col("before")).cast("bigint").alias("slot")
    )
