"""Left joins: size-checked lookups and joins with known hot keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tradeloom.operators.stage import staged
from tradeloom.session import MIB, SHUFFLE_BYTES

BROADCAST_BYTES = 32 * 1024 * 1024
#: Of a lookup table, as rows: a copy for every executor. It may take more where
#: that is a small part of the memory.
LOOKUP_BYTES = 4 * BROADCAST_BYTES
LOOKUP_SHARE = 0.1
#: Times their size that files may take up as rows.
UNPACKED = 8
_VALUE_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of all values of ``df``: measured text plus 16 bytes per value."""
    size = F.count("*") * F.lit(_VALUE_BYTES * len(df.columns))
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.sum(F.octet_length(field.name)), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"cannot bound the size of nested column {field.name}")
    return df.agg(size.alias("bytes")).first()["bytes"]


def source_bytes(df: DataFrame) -> int:
    """Bytes of all that ``df`` is read from, by Spark's statistics: no job. A
    source that is read twice counts once."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sources: list = []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if not any(leaf.sameResult(other) for other in sources):
            sources.append(leaf)
    return sum(int(str(source.stats().sizeInBytes())) for source in sources)


def least_heap(spark: SparkSession) -> int:
    """Heap of the driver or of an executor, whichever is less."""
    driver = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        return driver
    executor = spark.conf.get("spark.executor.memory", "1g")
    return min(driver, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(executor) * MIB)


def lookup_bytes(spark: SparkSession) -> int:
    """What a lookup table may take as rows: ``LOOKUP_BYTES``, or a tenth of the
    least heap if that is more. The driver holds it once, as each executor does."""
    return max(LOOKUP_BYTES, int(LOOKUP_SHARE * least_heap(spark)))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Left join against a lookup table that may or may not be small.

    ``right`` has one row for each key, or a few, and is made from its sources by
    projections, filters and such joins. It is sent to every executor if those
    sources are within ``broadcast_bytes`` (``lookup_bytes``, if not given), also
    when their files unpack to several times their size. Otherwise the sides
    shuffle on the key, and AQE decides by the sizes it finds: it sends a right
    side that turns out small, and splits the hot keys of the left one. No job
    runs before that.
    """
    most = lookup_bytes(left.sparkSession) if broadcast_bytes is None else broadcast_bytes
    if source_bytes(right) * UNPACKED <= most:
        right = F.broadcast(right)
    return left.join(right, on, "left")


#: Items a sketch can track, and of those the values it is asked for.
MOST_TRACKED, MOST_HOT = 1_000_000, 200_000
LANES = 64


@dataclass(frozen=True)
class HotKeys:
    """A table of hot key values, each with ``salts``, the parts its rows are
    dealt into, and the measured size of that table."""

    frame: DataFrame
    bytes: int

    def side(self) -> DataFrame:
        """The table for a join: a copy for every task if it is small enough."""
        return F.broadcast(self.frame) if self.bytes <= BROADCAST_BYTES else self.frame


@contextmanager
def shuffle_width(spark: SparkSession, width: int) -> Iterator[None]:
    """Jobs planned inside shuffle into ``width`` partitions: a job with a few
    rows a task needs no partitions by the thousand."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(width))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def frequent_keys(df: DataFrame, key: str, most: int, tracked: int = 4096) -> DataFrame:
    """``key, count, rows``: up to ``most`` frequent values with estimated
    counts, and the rows of ``df``. Values may be null; the table is written.

    One scan of one column. Each task keeps a sketch of ``tracked`` values;
    sketches merge in lanes first, so that no task merges those of all others.
    """
    lanes = (
        df.select(key, (F.spark_partition_id() % LANES).alias("_lane"))
        .groupBy("_lane")
        .agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch"),
            F.count("*").alias("rows"),
        )
    )
    merged = lanes.groupBy((F.col("_lane") < 0).alias("_none")).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
        F.sum("rows").alias("rows"),
    )
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("top"), "rows")
    with shuffle_width(df.sparkSession, LANES):
        return staged(found.select(F.col("top.item").alias(key), "top.count", "rows"), "frequent-keys")


def hot_keys(df: DataFrame, key: str, share: float = 0.005, partitions: float = 4) -> HotKeys:
    """Values of ``key`` that may hold at least ``share`` of the rows, or as many
    as ``partitions`` mean partitions of a shuffle, whichever is less.

    So the largest key left in a shuffle is a few times the mean partition at
    any width up to 800,000; beyond it the sketch reaches its limit, and the
    200,000 most frequent values are looked at. The table only routes rows:
    results are the same whatever it holds, so estimates will do.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(share, partitions / width)
    most = min(int(1 / share), MOST_HOT)
    found = frequent_keys(df, key, most, tracked=min(max(4096, 8 * most), MOST_TRACKED))
    least = F.greatest(F.lit(2), F.col("rows") * share)
    salts = F.ceil(F.col("count") * width / (F.col("rows") * partitions))
    hot = found.filter(F.col(key).isNotNull() & (F.col("count") >= least)).select(key, salts.alias("salts"))
    return HotKeys(hot, measured_bytes(hot))


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` by Spark's statistics: no job, file sizes at least."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys_of_large(df: DataFrame, key: str, least_bytes: int = 4 * SHUFFLE_BYTES) -> HotKeys | None:
    """The hot keys of a frame of which one key could fill a few partitions;
    none are looked for in a smaller one."""
    return hot_keys(df, key) if planned_bytes(df) >= least_bytes else None


def left_join_per_key(
    left: DataFrame,
    rights: Sequence[DataFrame],
    on: str,
    hot: HotKeys | None = None,
    repeats: str | None = None,
) -> DataFrame:
    """Left-join several frames that each hold at most one row per ``on``.

    AQE cannot split a hot key here because the right sides are aggregates. If
    ``hot`` is given, rows without a key take no part in the join, and rows with
    a hot key are dealt by key and a salt: each of the key's few right rows, one
    a frame, is copied to all of its salts. The copies are as many as the
    shuffle has partitions, not as the data has rows.

    ``repeats`` adds a column of that name: false if no other row has the key.
    The join has sorted the rows by key, so they are counted where they are; of
    hot and missing keys it is true.
    """

    def marked_repeats(joined: DataFrame, known: bool = True) -> DataFrame:
        if repeats is None:
            return joined
        others = F.count("*").over(Window.partitionBy(on)) > 1
        return joined.withColumn(repeats, others if known else F.lit(True))

    if hot is None:
        return marked_repeats(_join_all(left, rights, [on]))
    known = left.filter(F.col(on).isNotNull())
    unknown = marked_repeats(left.filter(F.col(on).isNull()), False)
    if not hot.bytes:
        return marked_repeats(_join_all(known, rights, [on])).unionByName(unknown, allowMissingColumns=True)
    marked = known.join(hot.side().withColumnRenamed("salts", "_salts"), on, "left")
    cold = marked_repeats(_join_all(marked.filter("_salts IS NULL"), rights, [on]))
    dealt = marked.filter("_salts IS NOT NULL").withColumn("_salt", F.monotonically_increasing_id() % F.col("_salts"))
    copies = [
        right.join(hot.side(), on)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
        .drop("salts")
        for right in rights
    ]
    return (
        cold.unionByName(marked_repeats(_join_all(dealt, copies, [on, "_salt"]).drop("_salt"), False))
        .drop("_salts")
        .unionByName(unknown, allowMissingColumns=True)
    )


def _join_all(left: DataFrame, rights: Sequence[DataFrame], on: list[str]) -> DataFrame:
    for right in rights:
        left = left.join(right, on, "left")
    return left
