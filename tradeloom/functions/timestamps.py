"""Timestamp parsing and calendar arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spark's cast alone also takes years, year-months, lone hours and end blanks.
FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d.*)?\z"
SLASH_DATE = r"^\s*\d{4}/\d{1,2}/\d{1,2}([ T]\d{1,2}:\d.*)?\z"


def safe_timestamp(text: Column) -> Column:
    """Text to ``timestamp_ntz``; anything that is no full date gives null.

    Zone offsets are ignored: the wall time counts. The usual form, like
    ``2017-05-01 10:00:00``, is told by three marks and needs no pattern match.
    """
    usual = _mark(text, 5, "-") & _mark(text, 8, "-") & _mark(text, 14, ":")
    dashed = F.regexp_replace(text, r"^(\s*\d{4})/(\d{1,2})/", "$1-$2-")
    return F.when(usual | text.rlike(FULL_DATE), text.try_cast("timestamp_ntz")).when(
        text.rlike(SLASH_DATE), dashed.try_cast("timestamp_ntz")
    )


def _mark(text: Column, place: int, mark: str) -> Column:
    return F.substring(text, place, 1) == mark


def day_diff(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end`` (23:00 to 01:00 is 1)."""
    return F.datediff(end, start).cast("bigint")


def year_month(ts: Column) -> Column:
    """``yyyy-MM`` by text: formatting would go through the session time zone."""
    return F.substring(F.to_date(ts).cast("string"), 1, 7)


def in_years(ts: Column, years: list[int]) -> Column:
    """Is ``year(ts)`` one of ``years``, as ranges a Parquet scan can push down."""
    wanted = F.lit(False)
    for year in sorted(set(years)):
        first = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
        after = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
        wanted = wanted | ((ts >= first) & (ts < after))
    return wanted
