"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

Documents are taken in batches of rising id. A run is a Parquet table of line
hashes, sorted, in the shared folder; a hash is in one run at most. Each batch
merge-anti-joins the runs: what is left are hashes nobody held before, and they
become a new run of level 0. When a level holds ``fan_in`` runs they are merged
into one run of the next level, so a batch meets a logarithmic number of runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import col, id_key, replaced, text_of
from tradeloom.operators.stage import staged

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def key_hash(key: Column) -> Column:
    """128 bits, so that hashes of different lines stay apart at any size. A hash
    is the seed of the next argument's, so the literal stands first: behind the
    key it would give a function of the first half."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


class Runs:
    """Levelled sorted runs; a hash is in one of them at most."""

    def __init__(self, fan_in: int):
        self.fan_in, self.levels = fan_in, [[]]

    def without(self, firsts: DataFrame) -> DataFrame:
        """Rows of ``firsts`` whose hash no run holds."""
        for run in (run for level in self.levels for run in level):
            firsts = firsts.join(run.hint("merge"), ["a", "b"], "left_anti")
        return firsts

    def add(self, hashes: DataFrame) -> None:
        self.levels[0].append(sorted_run(hashes, "line-run"))

    def compact(self) -> None:
        for depth, level in enumerate(self.levels):
            if len(level) >= self.fan_in:
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(sorted_run(reduce(DataFrame.union, level), "line-runs"))
                self.levels[depth] = []


def sorted_run(hashes: DataFrame, name: str) -> DataFrame:
    return staged(hashes.select("a", "b").repartition("a", "b").sortWithinPartitions("a", "b"), name)


def repeated_lines(
    docs: DataFrame, id_col: str, text_col: str, min_length: int, batches: int, fan_in: int
) -> DataFrame:
    """``k, gone``: per document key, the hashes of the lines it loses."""
    hashed = F.transform(
        F.filter(
            F.transform(F.split(text_of(text_col), "\n"), line_key),
            lambda key: F.length(key) >= min_length,
        ),
        key_hash,
    )
    keyed = docs.select(id_key(id_col).alias("k"), F.array_distinct(hashed).alias("hashes"))
    parts = [i / batches for i in range(1, batches)] or [0.5]
    edges = docs.agg(F.percentile_approx(id_key(id_col), parts, 10_000).alias("edges")).first()["edges"] or []
    batch = reduce(lambda n, edge: n + (F.col("k") > edge).cast("int"), sorted(set(edges)) if batches > 1 else [], F.lit(0))
    lines = staged(
        keyed.select("k", batch.alias("batch"), F.explode("hashes").alias("h")).select("batch", "k", "h.a", "h.b"),
        "line-hashes",
        partition_by="batch",
    )

    runs, gone = Runs(fan_in), []
    for number in range(batches):
        own = lines.filter(F.col("batch") == number).select("k", "a", "b")
        fresh = staged(runs.without(own.groupBy("a", "b").agg(F.min("k").alias("first"))), "line-firsts")
        met = own.join(fresh.hint("merge"), ["a", "b"], "left")
        gone.append(met.filter(F.col("first").isNull() | (F.col("k") > F.col("first"))).select("k", "a", "b"))
        if number + 1 < batches:
            runs.add(fresh)
            runs.compact()
    return reduce(DataFrame.union, gone).groupBy("k").agg(F.collect_list(F.struct("a", "b")).alias("gone"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 10,
    batches: int = 4,
    fan_in: int = 2,
) -> DataFrame:
    """Drop lines that a document with a smaller id holds already.

    Lines are cut at ``\\n``; two lines are equal if they are so without blanks
    at the ends and with A-Z in lower case. Lines whose key has fewer than
    ``min_length`` code points always stay. A document that holds a key first
    keeps all its lines with that key.

    Returns the input's columns with the text reduced to the lines kept, then
    ``n_lines`` and ``n_dropped`` (columns of these names make room). Null or
    empty text is one empty line and becomes empty text. Rows with equal ids
    are one document and are treated alike; null ids are one document, the
    last. An empty table gives an empty table.

    At scale: hashes (16 bytes a line) are shuffled, the texts once, to meet
    the hashes they lose. A line all documents share is counted before the
    shuffle, and the join that marks its rows can be split by AQE.
    """
    gone = repeated_lines(docs, id_col, text_col, min_length, batches, fan_in)
    lines = F.split(text_of(text_col), "\n")
    stays = lambda line: (F.length(line_key(line)) < min_length) | ~F.array_contains(
        F.col("__gone"), key_hash(line_key(line))
    )
    joined = docs.withColumn("__k", id_key(id_col)).join(
        gone.select(F.col("k").alias("__k"), F.col("gone").alias("__gone")).hint("shuffle_hash"), "__k", "left"
    )
    marked = joined.withColumns({"__lines": lines}).withColumn(
        "__kept", F.when(F.col("__gone").isNull(), F.col("__lines")).otherwise(F.filter("__lines", stays))
    )
    text = F.when(F.col("__gone").isNull(), text_of(text_col)).otherwise(F.array_join("__kept", "\n"))
    texted = marked.withColumn(text_col, text)
    out = replaced(
        texted,
        n_lines=F.size("__lines").cast("bigint"),
        n_dropped=(F.size("__lines") - F.size("__kept")).cast("bigint"),
    )
    return out.select(*(col(name) for name in docs.columns if name.lower() not in ("n_lines", "n_dropped")), "n_lines", "n_dropped")
