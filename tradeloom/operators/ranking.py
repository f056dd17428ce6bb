"""Top-k, shares and reshaping of report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradeloom.operators.stage import staged


def top_k(df: DataFrame, k: int, measure: str, tie: str) -> DataFrame:
    """The ``k`` largest rows; equal measures rank by ``tie`` ascending."""
    return df.orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(tie)).limit(k)


def share_of_total(df: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Add each row's part of the total of a grouped report.

    The grouped rows are written, and the total is a scalar subquery over them:
    the report is worked out once, and no row leaves its partition.
    """
    rows = staged(df, "report")
    total = rows.select(F.sum(measure)).scalar()
    return rows.withColumn(name, F.try_divide(F.col(measure).cast("double"), total))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Several measures to one ``value`` column with the name in ``variable``."""
    return df.unpivot(list(ids), list(values), "variable", "value")
