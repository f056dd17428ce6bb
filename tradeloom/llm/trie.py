"""Prefix trie of conversations, in double arrays.

A conversation is a row of turns, each a 128-bit hash of role and text; a
prefix has a hash of its own. Equal conversations are one sequence with a
count. Sequences are dealt to shards by a prefix, deeper where many share it,
so each node at or below a shard's prefix lies in that shard alone. A task
packs its shards into BASE and CHECK arrays over dense ids of their turns
(child = BASE[node] + id, and CHECK[child] = node), walks all sequences through
them, and sums up the nodes. A large id is taken in digits, one step each, so
that the arrays grow with the turns and not with the ids a node's children span. The few nodes above the shards are shared; their
parts are merged by prefix over all shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from typing import Iterator as Batches

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import col, single_threaded, text_of
from tradeloom.llm.rolling import mixed
from tradeloom.operators.stage import staged

#: Turns of a shard; a prefix shared by sequences of more is cut deeper.
MOST_TURNS = 200_000
#: Turns packed into one double array, whole shards each.
AT_ONCE = 200_000
#: Bits of an id that one step takes: children lie within 64 places.
DIGIT = 6
#: Places at the end in which a node with several children may find free ones.
RECENT = 512
#: Ids that are listed in one piece before their digest is taken.
RUN_BITS = 16

FREE, TOP = -1, -2
TURN = "struct<a: bigint, b: bigint, bytes: int>"
KEY = "struct<a: bigint, b: bigint>"
ROOT = f"CAST(named_struct('a', 0, 'b', 0) AS {KEY})"
NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    f"saved bigint, ends {KEY}, key {KEY}, above array<{KEY}>"
)


def conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turns`` of each conversation, its turns as ``a, b`` (hash of
    role and text) and ``bytes`` of the text.

    Turns ascend by number, null first, equal numbers by hash. Null role and
    text are empty. A row without a conversation id belongs to none.
    """
    content = [text_of(role_col), text_of(text_col)]
    a, b = (F.xxhash64(F.lit(half), *content) for half in (1, 2))
    rows = turns.select(
        col(id_col).cast("bigint").alias("conv_id"),
        F.struct(
            col(turn_col).alias("turn"), a.alias("a"), b.alias("b"), F.octet_length(content[1]).alias("bytes")
        ).alias("t"),
    )
    return (
        rows.filter("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select("conv_id", F.transform("t", lambda t: F.struct(t["a"], t["b"], t["bytes"])).cast(f"array<{TURN}>").alias("turns"))
    )


def prefix_keys(batches: Batches[pa.Array]) -> Batches[pa.Array]:
    """The 128-bit hash of each prefix of a row of turns, shortest first."""
    for batch in batches:
        size = pc.list_value_length(batch).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        turns, place = batch.flatten(), np.arange(size.sum()) - np.repeat(ends - size, size)
        halves = []
        for half, name in enumerate("ab"):
            turn = turns.field(name).to_numpy().astype(np.uint64)
            each = mixed(turn ^ mixed(place.astype(np.uint64) + np.uint64(1), 5 + half), half)
            sums = np.append(np.uint64(0), np.bitwise_xor.accumulate(each))
            halves.append(pa.array((sums[1:] ^ np.repeat(sums[ends - size], size)).astype(np.int64)))
        yield pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays(halves, ["a", "b"]))


class DoubleArray:
    """A trie over dense symbols; node 0 is the top.

    A symbol is a few digits, the highest first, and takes a step for each. A
    node with several children puts them among the last places or behind them,
    so it adds at most 64 places, however many symbols there are.
    """

    def __init__(self, size: int, alphabet: int):
        self.base, self.check = np.zeros(size, np.int64), np.full(size, FREE, np.int64)
        self.check[0], self.end = TOP, 1
        self.shifts = range(0, max(1, int(alphabet - 1).bit_length()), DIGIT)[::-1]

    def digits(self, symbol: np.ndarray) -> Iterator[np.ndarray]:
        return ((symbol >> shift) & ((1 << DIGIT) - 1) for shift in self.shifts)

    def reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, len(self.check) * 3 // 2) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, FREE, np.int64))

    def insert(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Add children to nodes that have none; the child of each pair."""
        for digit in self.digits(symbol):
            node = self.insert_digit(node, digit)
        return node

    def insert_digit(self, node: np.ndarray, digit: np.ndarray) -> np.ndarray:
        order = np.lexsort((digit, node))
        n, s = node[order], digit[order]
        new = np.append(True, (n[1:] != n[:-1]) | (s[1:] != s[:-1]))
        n, s = n[new], s[new]
        first = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
        count = np.diff(np.append(first, len(n)))
        several = np.flatnonzero(count > 1)
        for k in several[np.argsort(-count[several], kind="stable")]:
            digits = s[first[k] : first[k] + count[k]]
            self.put(n[first[k]], digits, self.fit(digits))
        # A node with one child takes any place: those behind the last.
        one = first[count == 1]
        self.reserve(self.end + len(one))
        places = np.arange(self.end, self.end + len(one))
        self.base[n[one]], self.check[places] = places - s[one], n[one]
        self.end += len(one)
        return self.base[node] + digit

    def fit(self, digits: np.ndarray) -> int:
        """A base that puts all digits on free places: the first that fits among
        the last places, else behind them."""
        span = digits - digits[0]
        self.reserve(self.end + int(span[-1]) + 1)
        low = max(0, self.end - RECENT)
        at = low + np.flatnonzero(self.check[low : self.end] == FREE)
        fits = (self.check[at[:, None] + span] == FREE).all(axis=1)
        return int((at[fits.argmax()] if fits.any() else self.end) - digits[0])

    def put(self, node: int, digits: np.ndarray, base: int) -> None:
        self.base[node], self.check[base + digits] = base, node
        self.end = max(self.end, base + int(digits[-1]) + 1)

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The child of each node by a symbol, or FREE."""
        for digit in self.digits(symbol):
            child = self.base[node] + digit
            inside = (node >= 0) & (child >= 0) & (child < len(self.check))
            child = np.where(inside, child, 0)
            node = np.where(inside & (self.check[child] == node), child, FREE)
        return node


def packed(lead: np.ndarray, size: np.ndarray, symbols: np.ndarray, alphabet: int) -> DoubleArray:
    """The double array of rows of symbols: ``lead``, then ``size`` others."""
    trie = DoubleArray(len(symbols) + len(lead) + 1, alphabet)
    first = np.cumsum(size) - size
    node = trie.insert(np.zeros(len(lead), np.int64), lead)
    for depth in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > depth)
        node[on] = trie.insert(node[on], symbols[first[on] + depth])
    return trie


def shard_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of whole shards; rows are sequences, sorted by shard."""
    key = [pc.struct_field(rows["shard"], name).to_numpy() for name in "ab"]
    new = np.append(True, (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]))
    shard = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    turns = rows["rest"].combine_chunks()
    size = pc.list_value_length(turns).to_numpy(zero_copy_only=False)
    turns = turns.flatten()
    a, b, length = (turns.field(name).to_numpy() for name in ("a", "b", "bytes"))

    # Dense ids: shards first, then the different turns.
    order = np.lexsort((b, a))
    other = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))[: len(order)]
    symbols = np.empty(len(order), np.int64)
    symbols[order] = len(head) + np.cumsum(other) - 1
    bytes_of = np.append(rows["root_bytes"].to_numpy()[head], length[order[other]]).astype(np.int64)
    trie = packed(shard, size, symbols, len(bytes_of))

    # Walk all sequences through the arrays: the root of the shard, then a step
    # for each turn. A sequence's steps lie one behind the other.
    first = np.cumsum(size + 1) - size - 1
    level = np.arange((size + 1).sum()) - np.repeat(first, size + 1)
    symbol = np.empty(len(level), np.int64)
    symbol[level == 0], symbol[level > 0] = shard, symbols
    place, at = np.empty(len(level), np.int64), np.zeros(len(shard), np.int64)
    for d in range(int(size.max(initial=0)) + 1):
        on = np.flatnonzero(size >= d)
        place[first[on] + d] = at[on] = trie.step(at[on], symbol[first[on] + d])

    # Nodes are numbered from the shards' roots down.
    places, node = np.unique(place, return_inverse=True)
    depth = np.empty(len(places), np.int64)
    depth[node] = level
    order = np.argsort(depth, kind="stable")
    number = np.empty(len(places), np.int64)
    number[order] = np.arange(len(places))
    node, depth = number[node], depth[order]
    inner = np.flatnonzero(level > 0)
    parent = np.full(len(places), -1)
    parent[node[inner]] = node[inner - 1]
    members, smallest = np.zeros(len(places), np.int64), np.full(len(places), np.iinfo(np.int64).max)
    np.add.at(members, node, np.repeat(rows["n"].to_numpy(), size + 1))
    np.minimum.at(smallest, node, np.repeat(rows["conv_id"].to_numpy(), size + 1))
    roots, is_root = len(head), depth == 0
    children = np.bincount(parent[roots:], minlength=len(places))
    leaves, saved = (children == 0).astype(np.int64), np.empty(len(places), np.int64)
    saved[node] = bytes_of[symbol]
    saved *= members - 1
    bounds = np.searchsorted(depth, np.arange(depth.max(initial=0) + 2))
    for low, high in reversed(list(zip(bounds[1:-1], bounds[2:]))):
        np.add.at(leaves, parent[low:high], leaves[low:high])
        np.add.at(saved, parent[low:high], saved[low:high])

    own = np.zeros(len(places), np.int64)
    own[node[first[head]]] = head
    top = pa.array(own, mask=~is_root)
    down = rows["depth"].to_numpy()[own].astype(np.int64)
    for low, high in zip(bounds[1:-1], bounds[2:]):
        down[low:high] = down[parent[low:high]] + 1
    row = np.full(len(places), -1)
    row[node[first + size]] = np.arange(len(size))
    return pa.table(
        {
            "conv_id": smallest,
            "depth": down,
            "parent_conv_id": pa.array(smallest[parent], mask=is_root),
            "n_convs": members,
            "n_children": children,
            "n_leaves": leaves,
            "saved": saved,
            "ends": rows["ends"].combine_chunks().take(pa.array(row, mask=row < 0)),
            "key": rows["shard"].combine_chunks().take(top),
            "above": rows["above"].combine_chunks().take(top),
        }
    )


def portions(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Slices of at most ``AT_ONCE`` turns, or of one row."""
    held = np.append(0, np.cumsum(pc.list_value_length(batch["rest"]).to_numpy(zero_copy_only=False) + 1))
    low = 0
    while low < len(batch):
        high = max(low + 1, int(np.searchsorted(held, held[low] + AT_ONCE, "right")) - 1)
        yield pa.Table.from_batches([batch.slice(low, high - low)])
        low = high


def pack_shards(batches: Batches[pa.RecordBatch]) -> Batches[pa.RecordBatch]:
    single_threaded()
    waiting: list[pa.Table] = []
    held = 0
    for part in (part for batch in batches for part in portions(batch)):
        waiting.append(part)
        held += len(part) + int(pc.sum(pc.list_value_length(part["rest"])).as_py() or 0)
        if held >= AT_ONCE:
            rows = pa.concat_tables(waiting)
            last = rows["shard"][-1].as_py()
            key = [pc.struct_field(rows["shard"], name).to_numpy() for name in "ab"]
            whole = int(((key[0] != last["a"]) | (key[1] != last["b"])).sum())
            if whole:
                yield from shard_nodes(rows.slice(0, whole)).to_batches()
            waiting = [rows.slice(whole)]
            held = len(waiting[0]) + int(pc.sum(pc.list_value_length(waiting[0]["rest"])).as_py() or 0)
    rows = pa.concat_tables(waiting) if waiting else None
    if rows is not None and len(rows):
        yield from shard_nodes(rows).to_batches()


def dealt(sequences: DataFrame, most: int) -> DataFrame:
    """Add ``depth``, the length of the prefix that is a sequence's shard: the
    least of 1, 2, 4, .. that at most ``most`` turns of other sequences share.
    A sequence that is shorter lies above all shards."""
    done, left, depth = [], sequences, 1
    while True:
        long = left.filter(F.size("turns") >= depth)
        key = F.element_at("keys", depth)
        heavy = staged(
            long.select(key.alias("heavy"), F.size("turns").alias("size"))
            .groupBy("heavy")
            .agg(F.sum("size").alias("turns"), F.count("*").alias("rows"))
            .filter((F.col("turns") > most) & (F.col("rows") > 1))
            .select("heavy"),
            "trie-heavy",
        )
        if heavy.isEmpty():
            return reduce(DataFrame.union, [*done, left.withColumn("depth", F.lit(depth))])
        done.append(left.filter(F.size("turns") < depth).withColumn("depth", F.lit(depth)))
        is_heavy = key == F.col("heavy")
        done.append(long.join(heavy, is_heavy, "left_anti").withColumn("depth", F.lit(depth)))
        left = staged(long.join(heavy, is_heavy, "left_semi"), "trie-left")
        depth *= 2


def shared_nodes(sequences: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes above all shards, from the sequences and the shards' roots."""
    root = F.expr(ROOT)

    def node(depth: Column) -> Column:
        before = F.slice("keys", 1, depth)
        path = F.concat(F.array(root), before)
        return F.struct(
            depth.alias("depth"),
            path.alias("path"),
            F.when(depth > 0, F.get(F.col("turns"), depth - 1)["bytes"]).otherwise(0).alias("bytes"),
            (depth == F.size("turns")).alias("is_end"),
        )

    depths = F.sequence(F.lit(0), F.least(F.size("turns"), F.col("depth") - 1))
    merged = (
        sequences.select("n", "conv_id", F.explode(F.transform(depths, node)).alias("node"))
        .select("n", "conv_id", "node.*")
        .withColumn("key", F.element_at("path", -1))
        .groupBy("key")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.sum("n").alias("n_convs"),
            F.max("bytes").alias("bytes"),
            F.max("is_end").alias("is_end"),
            F.any_value("path").alias("path"),
        )
        .withColumn("parent", F.when(F.col("depth") > 0, F.get(F.col("path"), F.size("path") - 2)))
    )
    merged = staged(merged, "trie-shared")
    children = (
        merged.filter("depth > 0")
        .select("parent")
        .union(roots.select(F.element_at("above", -1)))
        .groupBy("parent")
        .agg(F.count("*").alias("n_children"))
        .withColumnRenamed("parent", "key")
    )
    own = merged.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    parts = own.select(
        F.explode("path").alias("key"),
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    ).union(roots.select(F.explode("above"), "n_leaves", "saved"))
    sums = parts.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    parents = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return own.join(sums, "key").join(parents, "parent", "left")


def ends_digests(sequences: DataFrame) -> DataFrame:
    """``ends, ends_sha256`` of ``conv_id, ends``: the digest of the ids of each
    key, ascending, joined by commas. Ids are listed in runs; one task reads the
    runs of a key in order and holds one batch of them."""

    def run(batches: Batches[pa.RecordBatch]) -> Batches[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for own, ids in zip(batch["ends"].to_pylist(), batch["ids"].to_pylist()):
                if own != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows_of(done, batch.schema)
        if key is not None:
            yield rows_of([(key, state.hexdigest())], batch.schema)

    def rows_of(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        keys, digests = zip(*done) if done else ((), ())
        columns = [pa.array(keys, schema.field("ends").type), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["ends", "ends_sha256"])

    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    runs = sequences.groupBy("ends", F.shiftright("conv_id", RUN_BITS).alias("run")).agg(ids.alias("ids"))
    return (
        runs.repartition("ends").sortWithinPartitions("ends", "run").mapInArrow(run, f"ends {KEY}, ends_sha256 string")
    )


def prefix_trie(sequences: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """A row for each node of the trie of ``conv_id, turns`` (one row for each
    conversation, turns as ``conversations`` gives them).

    A node is a different sequence of first turns; the root has depth 0 and
    every conversation, also one without turns. ``conv_id`` is the smallest
    member, ``parent_conv_id`` that of the parent (root: null), ``n_convs`` the
    members, ``n_children`` the children, ``n_leaves`` the nodes without
    children at and below it, ``saved_tokens`` the sum over the same nodes of
    the bytes of the last text times the members but one, and ``ends_sha256``
    the digest of the ids, ascending and joined by commas, of conversations that
    end there. Equal conversations are members each. Without rows there is no
    root.

    At scale: texts leave before the first shuffle, a turn is 20 bytes. Equal
    conversations are counted before their turns move. A shard has at most
    200,000 turns, or one sequence; the nodes above shards are merged by partial
    sums. A conversation is one row, so its turns, 36 bytes each, must fit into
    a task. The ids that end at one node are digested in order by one task,
    which reads them in runs.
    """
    keyed = sequences.select("conv_id", "turns", F.arrow_udf(prefix_keys, f"array<{KEY}>")("turns").alias("keys"))
    keyed = staged(
        keyed.withColumn("ends", F.coalesce(F.try_element_at("keys", F.lit(-1)), F.expr(ROOT))), "trie-sequences"
    )
    counts = keyed.groupBy("ends").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    different = staged(keyed.join(counts.drop("ends"), "conv_id"), "trie-different")
    dealt_out = dealt(different, most_turns)

    inside = dealt_out.filter(F.size("turns") >= F.col("depth")).select(
        F.get(F.col("keys"), F.col("depth") - 1).alias("shard"),
        "depth",
        "n",
        "conv_id",
        "ends",
        F.get(F.col("turns"), F.col("depth") - 1)["bytes"].alias("root_bytes"),
        F.slice("turns", F.col("depth") + 1, F.size("turns")).alias("rest"),
        F.concat(F.array(F.expr(ROOT)), F.slice("keys", 1, F.col("depth") - 1)).alias("above"),
    )
    nodes = staged(
        inside.repartition("shard").sortWithinPartitions("shard").mapInArrow(pack_shards, NODES), "trie-nodes"
    )
    roots = nodes.filter("key IS NOT NULL")
    shared = staged(shared_nodes(dealt_out, roots), "trie-upper")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    above = shared.select(
        *(F.col(c).cast("bigint") for c in columns[:-1]), F.when(F.col("is_end"), F.col("key")).alias("ends")
    )
    names = shared.select(F.col("key").alias("parent"), F.col("conv_id").alias("upper_conv_id"))
    linked = roots.withColumn("parent", F.element_at("above", -1)).join(names, "parent")
    linked = linked.withColumn("parent_conv_id", F.col("upper_conv_id"))
    every = nodes.filter("key IS NULL").select(*columns).union(linked.select(*columns)).union(above)
    ended = every.filter("ends IS NOT NULL").join(ends_digests(keyed.select("conv_id", "ends")), "ends")
    none = every.filter("ends IS NULL").withColumn("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return ended.unionByName(none).drop("ends").withColumnRenamed("saved", "saved_tokens")
