"""N-gram Jaccard join with Bayesian candidate pruning.

Each text is a set of shingles of five words. MinHash bands propose pairs; the
MinHash values of a pair are compared a few at a time, and the pair is dropped
as soon as the posterior probability that it reaches the threshold falls below
a tolerance (BayesLSH). What remains is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import LAST_ID, id_key, numbered, single_threaded, text_of
from tradeloom.llm.rolling import Substrings, mixed
from tradeloom.operators.stage import staged

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8**4)**24 < 4e-6.
BANDS, ROWS, CHECK = 24, 4, 8
TOLERANCE = 1e-6
#: Buckets up to this size are written out as pairs, larger ones go in blocks.
SMALL, BLOCK = 32, 256
SEEDS = np.random.default_rng(5).integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
DESCRIBED = "r bigint, k bigint, n int, sa bigint, sb bigint, v binary, bands array<int>, packed binary"
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PIECE = 1 << 20


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word; words stand between ASCII blanks, in lower case.
    Long texts are taken a piece at a time, cut at blanks."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if len(data) <= _PIECE:
        return Substrings(data).hashes(starts, ends)
    parts, low = [], 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + _PIECE)))
        begin = starts[low]
        parts.append(Substrings(data[begin : ends[high - 1]]).hashes(starts[low:high] - begin, ends[low:high] - begin))
        low = high
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The set of shingles, sorted; a shorter text is one shingle of its words."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    joined = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        joined = joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(joined)]
    return np.unique(mixed(joined))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (16 bits of each), sets by hash functions."""
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sets), BANDS * ROWS), np.uint64)
    if len(full):
        joined = np.concatenate([sets[i] for i in full])
        starts = np.cumsum(sizes[full]) - sizes[full]
        for k, seed in enumerate(SEEDS):
            out[full, k] = np.minimum.reduceat(joined * seed, starts)
    return mixed(out)


def bands_of(values: np.ndarray) -> np.ndarray:
    """A 32-bit key of each band."""
    keys = np.zeros((len(values), BANDS), np.uint64)
    for row in range(ROWS):
        keys = mixed(keys + values[:, row::ROWS][:, :BANDS])
    return (keys >> np.uint64(32)).astype(np.uint32).astype(np.int32)


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """After how many values compared, how many must be equal.

    With a uniform prior the posterior probability of reaching ``threshold``
    after m of n values is that of at most m successes in n + 1 trials.
    """
    steps = []
    for n in range(CHECK, BANDS * ROWS + 1, CHECK):
        total = 0.0
        for m in range(n + 2):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
        steps.append((n, m))
    return steps


def plausible(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of value pairs survive the incremental comparison."""
    alive, matches, at = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for n, least in steps:
        matches = matches + (left[alive, at:n] == right[alive, at:n]).sum(axis=1, dtype=np.int32)
        stays = matches >= least
        alive, matches, at = alive[stays], matches[stays], n
    return alive


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size, 128-bit hash, MinHash values and bands of each set, and the text."""
    import zstandard

    single_threaded()
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for low in range(0, len(batch), 256):
            part = batch.iloc[low : low + 256]
            texts = part["t"].tolist()
            sets = [shingles(text) for text in texts]
            values = signatures(sets)
            yield pd.DataFrame(
                {
                    "r": part["r"].array,
                    "k": part["k"].array,
                    "n": np.array([len(s) for s in sets], np.int32),
                    "sa": np.array([mixed(s, 1).sum(dtype=np.uint64) for s in sets], np.uint64).astype(np.int64),
                    "sb": np.array([mixed(s, 2).sum(dtype=np.uint64) for s in sets], np.uint64).astype(np.int64),
                    "v": [v.tobytes() for v in values.astype(np.uint16)],
                    "bands": list(bands_of(values)),
                    "packed": [packer.compress(t.encode("utf-8", "surrogatepass")) for t in texts],
                }
            )


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return shingles(zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass"))


def values_of(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), -1)


def prune(threshold: float, tolerance: float):
    steps = least_matches(threshold, tolerance)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        for batch in batches:
            if len(batch):
                yield batch.iloc[plausible(values_of(batch["va"]), values_of(batch["vb"]), steps)][["a", "b"]]

    return run


def verify(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_threaded()
        last, held = None, None
        for batch in batches:
            found = []
            for a, b, pa, pb in zip(batch["a"], batch["b"], batch["pa"], batch["pb"]):
                if b != last:
                    last, held = b, unpacked(pb)
                if similarity(unpacked(pa), held) >= threshold:
                    found.append((a, b))
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def join_blocks(threshold: float, tolerance: float):
    """Links within a bucket between two of its blocks: for each text their
    number, and the smallest text that links within the group lead to."""
    steps = least_matches(threshold, tolerance)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        single_threaded()
        group = group.sort_values(["block", "r"], ignore_index=True)
        own, other = int(group["x"].iloc[0]), int(group["y"].iloc[0])
        split = int((group["block"] == own).sum())
        values, sets = values_of(group["v"]), {}
        buckets = [set(b) for b in group["big"]]
        order = [list(b) for b in group["big"]]
        key, ids, copies = group["key"].iloc[0], group["r"].to_numpy(), group["copies"].to_numpy()
        links, weight = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        root = list(range(len(group)))

        def top(place: int) -> int:
            while root[place] != place:
                root[place] = root[root[place]]
                place = root[place]
            return place

        for i in range(split):
            rest = np.arange(i + 1, split) if own == other else np.arange(split, len(group))
            if not len(rest):
                continue
            for j in rest[plausible(np.broadcast_to(values[i], (len(rest), values.shape[1])), values[rest], steps)]:
                # A pair that shares several large buckets counts in the first.
                if next(b for b in order[i] if b in buckets[j]) != key:
                    continue
                for place in (i, j):
                    if place not in sets:
                        sets[place] = unpacked(group["packed"].iloc[place])
                if similarity(sets[i], sets[j]) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    weight[i] += copies[j]
                    weight[j] += copies[i]
                    one, two = top(i), top(j)
                    root[max(one, two, key=ids.__getitem__)] = min(one, two, key=ids.__getitem__)
        found = np.flatnonzero(links)
        return pd.DataFrame({"r": ids[found], "links": weight[found], "near": [ids[top(i)] for i in found]})

    return run


def linked(reps: DataFrame, wide: DataFrame, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """``r, links`` (sums to be added up) and ``a, b``, links that connect."""
    keys = reps.filter("n > 0").select(
        "r", F.posexplode("bands").alias("band", "value")
    ).select("r", (F.col("band").cast("bigint") * F.lit(1 << 32) + F.col("value")).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    members = staged(keys.join(shared.hint("merge"), "key"), "bucket-members")

    small = members.filter(F.col("m") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    pairs = (
        small.select("rs", F.posexplode("rs").alias("i", "a"))
        .select("a", F.explode(F.expr("slice(rs, i + 2, size(rs))")).alias("b"))
        .distinct()
    )
    in_big = members.filter(F.col("m") > SMALL)
    big = in_big.groupBy("r").agg(F.sort_array(F.collect_list("key")).alias("big"))
    needed = members.select("r").distinct().join(big, "r", "left").join(reps.select("r", "copies"), "r")
    full = staged(wide.join(needed.hint("shuffle_hash"), "r").select("r", "copies", "big", "v", "packed"), "bucket-texts")

    side = lambda name: full.select(
        F.col("r").alias(name), F.col("v").alias(f"v{name}"), F.col("big").alias(f"g{name}")
    )
    apart = ~F.coalesce(F.arrays_overlap("ga", "gb"), F.lit(False))
    kept = staged(
        pairs.join(side("a"), "a").join(side("b"), "b").filter(apart).select("a", "b", "va", "vb")
        .mapInPandas(prune(threshold, tolerance), "a bigint, b bigint"),
        "kept-pairs",
    )
    text = lambda name: full.select(F.col("r").alias(name), F.col("packed").alias(f"p{name}"))
    exact = staged(
        kept.join(text("a"), "a").join(text("b").hint("merge"), "b").select("a", "b", "pa", "pb")
        .mapInPandas(verify(threshold), "a bigint, b bigint"),
        "links",
    )

    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("r"), blocks).cast("int")
    dealt = in_big.withColumn("blocks", blocks).withColumn("block", own).select(
        "key", "r", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    ).select("key", "r", "block", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"))
    in_blocks = staged(
        dealt.join(full, "r")
        .groupBy("key", "x", "y")
        .applyInPandas(join_blocks(threshold, tolerance), "r bigint, links bigint, near bigint"),
        "block-links",
    )

    copies = reps.select("r", "copies")
    both = exact.select("a", "b").union(exact.select(F.col("b"), F.col("a")))
    counted = both.join(copies.withColumnRenamed("r", "b"), "b").select(F.col("a").alias("r"), F.col("copies").alias("links"))
    counts = counted.union(in_blocks.select("r", "links"))
    edges = exact.union(in_blocks.filter("near < r").select("near", "r"))
    return counts, edges


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``r, root``: each linked text with the smallest of its component.

    In each round every text takes the smallest root among its neighbours, and
    then that root's root, so long chains shorten by half or more.
    """
    both = staged(edges.union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    roots = staged(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("r"), F.least("a", "b").alias("root")), "roots")
    for _ in range(most_rounds):
        near = both.join(roots.select(F.col("r").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        met = roots.join(near.withColumnRenamed("a", "r"), "r").select(
            "r", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        jump = roots.select(F.col("r").alias("root"), F.col("root").alias("further"))
        new = staged(
            met.join(jump, "root", "left").select("r", "old", F.least("root", F.coalesce("further", "root")).alias("root")),
            "roots",
        )
        changed = new.filter("old <> root").limit(1).count()
        roots = new.select("r", "root")
        if not changed:
            return roots
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Group documents whose shingle sets are similar.

    A shingle is five words in lower case, words being what stands between
    ASCII blanks; a shorter text is one shingle. Documents of equal sets are
    one class. Returns a row for each input row: ``doc_id, class_id, n_links,
    group_id, keeps``. ``class_id`` is the smallest id of the class;
    ``n_links`` how many other rows are at least ``threshold`` similar, the
    class included; ``group_id`` the smallest id that links lead to; ``keeps``
    marks one row of each group, one of the smallest id.

    Null and empty texts are empty sets, equal to each other and similar to
    nothing else. A null id is the largest. Repeated rows are copies of each
    other. An empty table gives an empty table; other columns are not read.

    At scale: copies are counted before anything is paired. A bucket of up to
    32 texts is written out as pairs. A larger one is cut into blocks of about
    256 texts, and each two blocks are a group of their own that gives counts
    and connecting links instead of pairs, so no group and no list of pairs
    grows with a bucket. The comparisons within a large bucket are still as
    many as its pairs of different texts: that is what an exact count costs.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("r"), id_key(id_col).alias("k"), text_of(text_col).alias("t")
    )
    return grouped_rows(texts, threshold, tolerance).drop("r")


def grouped_rows(texts: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``near_duplicates`` of rows ``r, k, t`` (number, id key, text), with ``r``."""
    rows = staged(texts.mapInPandas(describe, DESCRIBED), "shingle-sets")
    same = ["sa", "sb", "n"]
    classes = staged(
        rows.groupBy(*same)
        .agg(F.min(F.struct("k", "r")).alias("first"), F.count("*").alias("copies"))
        .select(*same, F.col("first.k").alias("class_id"), F.col("first.r").alias("r"), "copies"),
        "classes",
    )
    reps = staged(
        rows.select("r", "bands").join(classes.select("r", "n", "copies"), "r"), "representatives"
    )
    counts, edges = linked(reps, rows.select("r", "v", "packed"), threshold, tolerance)
    roots = components(edges)
    found = (
        classes.join(counts.groupBy("r").agg(F.sum("links").alias("links")), "r", "left")
        .join(roots, "r", "left")
        .withColumn("root", F.coalesce("root", "r"))
    )
    found = staged(found, "linked-classes")
    heads = staged(found.groupBy("root").agg(F.min(F.struct("class_id", "r")).alias("head")), "heads")
    grouped = staged(
        found.join(heads, "root").select(
            *same,
            "class_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.col("head.class_id").alias("group_id"),
            F.col("head.r").alias("head"),
        ),
        "groups",
    )
    shown = lambda key: F.nullif(F.col(key), F.lit(LAST_ID)).alias(key)
    return rows.select("k", "r", *same).join(grouped, same).select(
        "r",
        F.nullif(F.col("k"), F.lit(LAST_ID)).alias("doc_id"),
        shown("class_id"),
        "n_links",
        shown("group_id"),
        (F.col("r") == F.col("head")).alias("keeps"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents ``near_duplicates`` keeps, with all their columns; rows
    that repeat a kept id stay with it, and null ids are one id.
    ``one_of_each_group`` decides row by row."""
    kept = near_duplicates(docs, id_col, text_col, **options).filter("keeps").select(id_key("doc_id").alias("__k"))
    return (
        docs.withColumn("__k", id_key(id_col)).join(kept.distinct().hint("shuffle_hash"), "__k", "left_semi").drop("__k")
    )


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The one row of each group that ``near_duplicates`` marks, with all its
    columns, whatever other rows have its id: copies under one id, and near
    duplicates without an id, leave one row as well. The documents are written
    once more, with a number for each row."""
    rows = numbered(docs, "__row")
    texts = rows.select(F.col("__row").alias("r"), id_key(id_col).alias("k"), text_of(text_col).alias("t"))
    kept = grouped_rows(texts, threshold, tolerance).filter("keeps").select(F.col("r").alias("__row"))
    return rows.join(kept.hint("shuffle_hash"), "__row", "left_semi").drop("__row")
