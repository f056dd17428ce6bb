"""Business measures and null-safe aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed values shown to report users.
NOT_DELIVERED, ON_TIME, LATE = "Not Delivered", "On Time", "Late"
HIGH_VALUE, MID_VALUE, LOW_VALUE = "High Value", "Mid Value", "Low Value"
HIGH_LIMIT, MID_LIMIT = 500, 150


def mean(value: Column) -> Column:
    """Average as exact sum over count, so partition order cannot change it."""
    return ratio(F.sum(value), F.count(value))


def ratio(total: Column, count: Column) -> Column:
    """Null where nothing was counted."""
    return F.try_divide(total.cast("double"), count)


def percent_of_rows(condition: Column) -> Column:
    """Share of rows in percent; null when there are no rows."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count("*"))


def round_double(value: Column, digits: int) -> Column:
    """Round a double on its binary value: 1.005 to two digits is 1.0.

    ``F.round`` rounds the printed form of a double (1.005 gives 1.01), which
    is not what the reports have always shown.
    """
    if digits == 0:
        return F.round(value)
    unit = float(10**digits)
    return F.round(value * F.lit(unit)) / F.lit(unit)


def round_column(df: DataFrame, name: str, digits: int) -> Column:
    """Round ``df[name]`` by its type: decimals exactly, doubles as above."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return round_double(F.col(name), digits)
    return F.round(F.col(name), digits)


def distinct_list(value: Column, separator: str = ", ") -> Column:
    """Sorted distinct values as one text; null when all values are null."""
    found = F.collect_set(value)
    return F.when(F.size(found) > 0, F.array_join(F.sort_array(found), separator))


def delivery_status(delivered: Column, estimated: Column) -> Column:
    """A delivery without an estimate counts as late."""
    return (
        F.when(delivered.isNull(), NOT_DELIVERED)
        .when(delivered <= estimated, ON_TIME)
        .otherwise(LATE)
    )


def band(value: Column, limits: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label by the first lower limit reached, highest first; null is lowest."""
    label = None
    for limit, name in sorted(limits, key=lambda pair: -pair[0]):
        reached = value >= limit
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return label.otherwise(lowest)


def value_segment(value: Column, high: float = HIGH_LIMIT, mid: float = MID_LIMIT) -> Column:
    return band(value, [(high, HIGH_VALUE), (mid, MID_VALUE)], LOW_VALUE)


def is_true(condition: Column) -> Column:
    """Boolean flag that is false where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def repeat_label(flag: Column) -> Column:
    return F.when(flag, "Repeat").otherwise("New")
