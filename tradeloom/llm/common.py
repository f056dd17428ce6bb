"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.operators.stage import staged

#: What a null id counts as wherever ids are ordered or joined.
LAST_ID = 2**63 - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_key(name: str) -> Column:
    """The id as a join and sort key: a null id is the largest."""
    return F.coalesce(col(name).cast("bigint"), F.lit(LAST_ID))


def text_of(name: str) -> Column:
    """The text, with null as empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def replaced(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns at the end; a column of the same name makes room."""
    kept = [col(name) for name in df.columns if name.lower() not in {c.lower() for c in columns}]
    return df.select(*kept, *(value.alias(name) for name, value in columns.items()))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with a number of their own, written once, so that each read of
    the frame gives a row the same number."""
    return staged(df.withColumn(name, F.monotonically_increasing_id()), "numbered-rows")


def one_by_one(frames: Iterable[DataFrame], name: str) -> DataFrame | None:
    """The union of frames that each carry a block of data in their code. If
    there are several, each is written before the next is made, so the driver
    never holds more than one block."""
    written, last = [], None
    for frame in frames:
        if last is not None:
            written.append(staged(last, name))
        last = frame
    if not written:
        return last
    return reduce(DataFrame.union, [*written, staged(last, name)])


def single_threaded() -> None:
    """One task, one thread: keep numeric libraries from starting more."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
