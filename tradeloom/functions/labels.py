"""Text forms of KPI values, for one-row KPI frames."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CURRENCY = "R$"


def count_label(value: Column) -> Column:
    return _if_known(value, F.format_string("%,d", value.cast("bigint")))


def money_whole_label(value: Column) -> Column:
    """Thousands separators, fraction cut off."""
    return _if_known(value, F.format_string(f"{CURRENCY} %,d", value.cast("bigint")))


def money_label(value: Column) -> Column:
    return _if_known(value, F.format_string(f"{CURRENCY} %.2f", value.cast("double")))


def score_label(value: Column) -> Column:
    return _if_known(value, F.format_string("%.2f", value.cast("double")))


def days_label(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit(" days"))


def percent_label(value: Column) -> Column:
    return _if_known(value, F.format_string("%.1f%%", nearest_tenth(value)))


def nearest_tenth(value: Column) -> Column:
    """Nearest tenth of the exact binary value, true halves to the even tenth.

    ``format_string`` alone rounds the shortest printed form half up, which
    differs for 12.25 (a true half) and 12.35 (binary just below the half).
    With ``h = 2k + 1`` the half is ``h / 20``; ``h - 16 v`` is exact near it,
    so comparing that with ``4 v`` decides the side without rounding error.
    """
    below = F.floor(value * 10)
    gap = (below * 2 + 1).cast("double") - value * 16
    rest = value * 4
    up = (gap < rest) | ((gap == rest) & (below % 2 == 1))
    return (below + up.cast("int")) / F.lit(10.0)


def _if_known(value: Column, text: Column) -> Column:
    return F.when(value.isNotNull(), text)
