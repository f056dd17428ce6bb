"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def newest(kept: Sequence[str | Column], order: Sequence[str | Column]) -> Column:
    """Aggregate giving the struct ``kept`` of the row with the largest ``order``.

    Nulls rank lowest in each order column. Being a plain aggregate it combines
    before the shuffle, so a key with very many rows sends one row per task.
    """
    return F.max_by(F.struct(*kept), F.struct(*order))


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    kept: Sequence[str],
) -> DataFrame:
    """One row per ``keys``: the columns ``kept`` of its newest row.

    Name a unique column last in ``order``, so that equal rows cannot tie.
    """
    return (
        df.groupBy(*keys)
        .agg(newest(kept, order).alias("_newest"))
        .select(*keys, *[F.col("_newest")[name].alias(name) for name in kept])
    )
