"""Merkle manifest of a data set, kept in append logs in postorder.

The leaves of a tree are cut into aligned blocks. A builder reads one block in
order and appends each node to its log as the node completes: its two children
first, then the node. So a node's place in the log follows from the sizes of
the subtrees before it and is computed, not stored; a proof picks its siblings
out of the log at computed places. The tops of blocks are the leaves of the
next pass, until each tree is one block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.llm.common import col
from tradeloom.operators.stage import staged

#: A builder takes 2 ** BITS leaves.
BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bytes of a digest in the log.
WIDTH = 32

#: Steps from a node to the top. A node without a sibling has the empty text.
PATH = "array<struct<digest: string, left: boolean>>"


@dataclass
class Manifest:
    """``entries`` has a row for each document: ``id, tree, index`` (place among
    the leaves of its tree), ``n`` (leaves of the tree), ``leaf, presented``.
    ``logs`` and ``root_logs`` have a frame for each pass: ``tree, block, n,
    log``. ``roots`` has ``tree, subroot, index`` and ``root``."""

    entries: DataFrame
    logs: list[DataFrame]
    roots: DataFrame
    root_logs: list[DataFrame]
    bits: int


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(values: Sequence[Column]) -> Column:
    """Hash of the values: ``-`` for null, else byte count, colon and value."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def nodes_before(leaf: int) -> int:
    """Nodes that are complete before a leaf is appended."""
    return 2 * leaf - leaf.bit_count()


def subtree_size(leaves: int, level: int) -> int:
    """Nodes below and at a node of ``level`` that covers ``leaves`` leaves."""
    return sum(-(-leaves >> t) for t in range(level + 1))


def position(level: int, index: int, leaves: int) -> int:
    """Place in the postorder log of node ``index`` of a level."""
    first = index << level
    return nodes_before(first) + subtree_size(min(1 << level, leaves - first), level) - 1


def height(leaves: int) -> int:
    """Levels above the leaves."""
    return (leaves - 1).bit_length()


def postorder(leaves: Sequence[str], levels: int) -> list[str]:
    """All nodes of a block, each after its children, up to ``levels`` above."""
    log: list[str] = []
    alone: list[str | None] = [None] * (levels + 1)

    def complete(node: str, level: int) -> None:
        while True:
            log.append(node)
            if level == levels:
                return
            if alone[level] is None:
                alone[level] = node
                return
            node, alone[level] = digest(alone[level] + node), None
            level += 1

    for node in leaves:
        complete(node, 0)
    for level in range(levels):
        if alone[level] is not None:
            node, alone[level] = digest(alone[level]), None
            complete(node, level + 1)
    return log


def siblings(log: bytes, leaf: int, leaves: int, levels: int) -> list[dict]:
    """The steps from a leaf of a block to the block's top."""
    steps = []
    for level in range(levels):
        other = leaf >> level ^ 1
        node = ""
        if other << level < leaves:
            at = position(level, other, leaves) * WIDTH
            node = log[at : at + WIDTH].hex()
        steps.append({"digest": node, "left": bool(leaf >> level & 1)})
    return steps


def folded(node: str, steps: Sequence[dict]) -> str:
    for step in steps:
        node = digest(step["digest"] + node if step["left"] else node + step["digest"])
    return node


def indexed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``index``, the place of a row in its ``tree`` by ``order``, and ``n``,
    the rows of that tree.

    The rows are sorted over all tasks and numbered by the rows before theirs;
    only a count for each task and tree is summed up, so a tree may hold all
    rows.
    """
    placed = staged(
        nodes.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        "merkle-order",
    )
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    return (
        placed.join(offsets, ["tree", "part"])
        .withColumn("index", F.col("at") + F.col("offset"))
        .drop("part", "at", "offset")
    )


def block_of(index: str, bits: int) -> Column:
    return F.shiftright(index, bits).alias("block")


def grow(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The logs of all trees over ``tree, index, n, digest``, pass by pass."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("index")
        n = rows["n"][0].as_py()
        log = postorder(rows["digest"].to_pylist(), min(bits, height(n)))
        return pa.table(
            {
                "tree": rows["tree"].slice(0, 1),
                "block": rows["block"].slice(0, 1),
                "n": rows["n"].slice(0, 1),
                "log": pa.array([bytes.fromhex("".join(log))], pa.binary()),
            }
        )

    logs: list[DataFrame] = []
    while True:
        blocks = nodes.select("tree", block_of("index", bits), "index", "n", "digest").groupBy("tree", "block")
        log = staged(blocks.applyInArrow(build, "tree string, block bigint, n bigint, log binary"), "merkle-log")
        logs.append(log)
        unfinished = log.filter(F.col("n") > 1 << bits)
        if unfinished.isEmpty():
            return logs
        nodes = unfinished.select(
            "tree", F.col("block").alias("index"), F.shiftright(F.col("n") + ((1 << bits) - 1), bits).alias("n"), top()
        )


def top() -> Column:
    """The last node of a log."""
    return F.lower(F.hex(F.expr(f"substring(log, -{WIDTH}, {WIDTH})"))).alias("digest")


def tops(logs: Sequence[DataFrame], bits: int) -> DataFrame:
    """``tree, digest`` of the top of each tree."""
    found = logs[0].filter(F.col("n") <= 1 << bits).select("tree", top())
    for log in logs[1:]:
        found = found.union(log.filter(F.col("n") <= 1 << bits).select("tree", top()))
    return found


def block_paths(logs: Sequence[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    """``tree, block, n, log`` of the first pass with ``path``, the steps from
    the top of the block on; ``above`` has ``tree, path`` of each tree's top."""
    here = None
    for log in reversed(logs):
        finished = log.filter(F.col("n") <= 1 << bits).join(above, "tree")
        if here is not None:
            below = leaf_paths(here, bits).withColumnRenamed("index", "block")
            finished = finished.union(log.join(below, ["tree", "block"]).select(*finished.columns))
        here = finished
    return here


def leaf_paths(blocks: DataFrame, bits: int) -> DataFrame:
    """``tree, index, path`` of the leaves of blocks with a path."""

    def split(rows: pa.Table) -> pa.Table:
        (block,) = rows.to_pylist()
        leaves = leaves_of(block["n"], block["block"], bits)
        levels = min(bits, height(block["n"]))
        steps = [siblings(block["log"], leaf, leaves, levels) + block["path"] for leaf in range(leaves)]
        first = block["block"] << bits
        return pa.table(
            {
                "tree": pa.array([block["tree"]] * leaves, pa.string()),
                "index": pa.array(range(first, first + leaves), pa.int64()),
                "path": pa.array(steps, rows.schema.field("path").type),
            }
        )

    return blocks.groupBy("tree", "block").applyInArrow(split, f"tree string, index bigint, path {PATH}")


def leaves_of(n: int, block: int, bits: int) -> int:
    return min(1 << bits, n - (block << bits))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "lang",
    presented: Mapping[str, Column] | None = None,
    bits: int = BITS,
) -> Manifest:
    """Hash documents into a tree for each ``tree_col``, and those into one.

    A leaf is the hash of ``fields``. The leaves of a tree ascend by id (nulls
    first), equal ids by leaf. While a tree has several nodes, every two
    neighbours, or a last one alone, become the hash of their hex digests. The
    tops of the trees, by name (null first, then bytewise), give the root in
    the same way. ``presented`` replaces some fields by what a reader holds;
    their leaf is kept beside the document's own for ``proofs``.

    Null and empty fields differ. Equal rows are leaves of their own, in any
    order. Other columns are not read, whatever their names. An empty table
    gives a manifest without rows.

    At scale: texts are hashed where they are read and never shuffled. Leaves
    are sorted once over all tasks and grouped once into blocks of 1,024; each
    further pass has a thousandth of the rows. All of it is written, so a lost
    task reads its block again. The number of passes grows with the logarithm
    of the largest tree.
    """
    presented = presented or {}
    tree = F.coalesce(F.concat(F.lit("="), col(tree_col).cast("string")), F.lit("-"))
    leaves = staged(
        docs.select(
            col(id_col).cast("bigint").alias("id"),
            tree.alias("tree"),
            leaf([col(f) for f in fields]).alias("leaf"),
            leaf([presented.get(f, col(f)) for f in fields]).alias("presented"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    entries = staged(indexed(leaves, ["id", "leaf", "row"]).drop("row"), "merkle-entries")
    logs = grow(entries.withColumnRenamed("leaf", "digest"), bits)

    subroots = tops(logs, bits).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = staged(indexed(subroots, ["name"]), "merkle-subroots")
    root_logs = grow(subroots, bits)
    root = tops(root_logs, bits).select("tree", F.col("digest").alias("root"))
    roots = subroots.join(root, "tree").select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "index", "root")
    return Manifest(entries, logs, roots, root_logs, bits)


def proofs(made: Manifest) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each
    document: the hash of its siblings up to the root, the root that its
    presented leaf and those siblings give, and whether that is the root."""
    bits = made.bits

    def prove(key: tuple, rows: pa.Table, blocks: pa.Table) -> pa.Table:
        (block,) = blocks.to_pylist()
        first, n = block["block"] << bits, block["n"]
        leaves, levels = leaves_of(n, block["block"], bits), min(bits, height(n))
        proof, fold = [], []
        for index, presented in zip(rows["index"].to_pylist(), rows["presented"].to_pylist()):
            steps = siblings(block["log"], index - first, leaves, levels) + block["path"]
            proof.append(digest("".join(step["digest"] for step in steps)))
            fold.append(folded(presented, steps))
        return pa.table(
            {
                "id": rows["id"],
                "leaf": rows["leaf"],
                "subroot": pa.array([block["subroot"]] * len(rows), pa.string()),
                "root": pa.array([block["root"]] * len(rows), pa.string()),
                "proof_sha256": pa.array(proof, pa.string()),
                "folded_root": pa.array(fold, pa.string()),
                "verified": pa.array([f == block["root"] for f in fold], pa.bool_()),
            }
        )

    no_steps = made.root_logs[-1].select("tree", F.array().cast(PATH).alias("path"))
    root_paths = leaf_paths(block_paths(made.root_logs, no_steps, bits), bits)
    above = made.roots.join(root_paths.select("index", "path"), "index").drop("index")
    blocks = block_paths(made.logs, above.select("tree", "path"), bits).join(above.drop("path"), "tree")
    entries = made.entries.withColumn("block", block_of("index", bits))
    return (
        entries.groupBy("tree", "block")
        .cogroup(blocks.groupBy("tree", "block"))
        .applyInArrow(
            prove,
            "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        )
    )
