"""URL filters by a sort-merge range join.

A host is written from its end, each label closed by a dot (``www.a.org`` is
``org.a.www.``), so a rule's host and all its subdomains are one interval of
keys. Urls and rules are dealt into ranges of keys; each range is sorted and
swept once, with a stack of the rules whose interval holds the current key. The
rules of the stack are nested, innermost on top.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import col, replaced
from tradeloom.operators.stage import staged

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end;
    path: then up to ``?``, ``#`` or the end. Both empty without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, *LETTERS), empty), F.coalesce(path, empty)


def host_key(host: Column) -> Column:
    """The labels from last to first, each with a dot after it."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def prefixes(key: Column) -> Column:
    """The host keys a key lies below or at, from that of all hosts on."""
    host = F.substring_index(key, "/", 1)
    labels = F.length(host) - F.length(F.replace(host, F.lit(".")))
    return F.concat(
        F.array(F.lit("")),
        F.transform(
            F.when(labels > 0, F.sequence(F.lit(1), labels)).otherwise(F.array().cast("array<int>")),
            lambda n: F.concat(F.array_join(F.slice(F.split(host, r"\."), 1, n), "."), F.lit(".")),
        ),
    )


def in_ranges(events: DataFrame, ranges: int) -> DataFrame:
    """Rules and urls sorted over all tasks, with the ``range`` a row lies in,
    and in each range also the rules that are open where it begins.

    Those are the rules that start in an earlier range at a prefix of the
    range's first key: a table of a row for each label of each first key finds
    them, whatever the number of ranges.
    """
    placed = staged(
        events.repartitionByRange(ranges, "key", "is_url")
        .sortWithinPartitions("key", "is_url")
        .withColumn("range", F.spark_partition_id()),
        "url-ranges",
    )
    edges = placed.groupBy("range").agg(F.min("key").alias("edge"))
    started = placed.filter("NOT is_url").withColumnRenamed("range", "own")
    open_ = edges.select("range", F.explode(prefixes(F.col("edge"))).alias("key")).join(started, "key").filter("own < range")
    every = placed.unionByName(open_.drop("own"))
    return every.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "key", "is_url")


def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pass over rows in order of range and key; rules stand before urls."""
    stack: list[tuple[str, dict[str, tuple[str, str]]]] = []
    current = None
    for batch in batches:
        judged = []
        columns = ("range", "key", "is_url", "host", "path", "rule", "verdict")
        for number, key, is_url, host, path, rule, verdict in zip(*(batch[name] for name in columns)):
            if number != current:
                stack, current = [], number
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if is_url:
                judged.append((host, path, *(longest(stack, path) or (None, None))))
                continue
            if not stack or stack[-1][0] != key:
                stack.append((key, {}))
            if verdict == "block" or path not in stack[-1][1]:
                stack[-1][1][path] = (rule, verdict)
        yield pd.DataFrame(judged, columns=["host", "path", "rule", "verdict"])


def longest(stack: list, path: str) -> tuple[str, str] | None:
    """The longest rule of the stack whose path starts the url's path."""
    best = None
    for _, rules in stack:
        few = len(rules) <= len(path)
        for start in rules if few else (path[:n] for n in range(len(path) + 1)):
            rule = rules.get(start) if path.startswith(start) else None
            if rule and (best is None or len(rule[0]) >= len(best[0])):
                best = rule
    return best


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """Judge each url by the longest rule that fits it.

    ``rules`` has ``host, path, verdict`` (``allow`` or ``block``). A rule fits
    its host and all subdomains if the url's path starts with the rule's. The
    longest rule, host and path together, wins; of equal length the one of the
    longer host, and of the same rule twice ``block``. A url no rule fits gets
    ``default``.

    Returns the input's columns, then ``host, path, rule, verdict`` (columns of
    these names make room); ``rule`` is host and path, or null. Null urls and
    urls without ``://`` have empty host and path. A rule of empty host fits all
    hosts. Rules of null host or verdict fit nothing; a null path is empty.
    Repeated rows are judged alike; without rules all get ``default``.

    At scale: each host and path is judged once. Keys are sorted into ranges by
    Spark, a host that holds a third of all urls into as many as its paths
    fill. A range gets the rules that start in it and those that are open at its
    edge, so rules are neither broadcast nor copied to all ranges; the rules of
    one host must fit into a task. Nothing is collected.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(col(url_col).cast("string"))
    parsed = replaced(pages, host=host, path=path)
    key = F.concat(host_key(F.col("host")), F.lit("/"), F.col("path"))
    keyed = parsed.select("host", "path").distinct().withColumn("key", key)

    known = (
        rules.select(
            F.translate(col("host").cast("string"), *LETTERS).alias("host"),
            F.coalesce(col("path").cast("string"), F.lit("")).alias("path"),
            col("verdict").cast("string").alias("verdict"),
        )
        .filter("host IS NOT NULL AND verdict IS NOT NULL")
        .distinct()
        .withColumn("key", host_key(F.col("host")))
    )
    events = known.select(
        "key", F.lit(False).alias("is_url"), "host", "path", F.concat("host", "path").alias("rule"), "verdict"
    ).union(keyed.select("key", F.lit(True), "host", "path", F.lit(None), F.lit(None)))
    dealt = in_ranges(events, ranges)
    judged = dealt.mapInPandas(sweep, "host string, path string, rule string, verdict string")
    names = [name for name in parsed.columns if name.lower() not in ("rule", "verdict")]
    return (
        parsed.select(*(col(name) for name in names))
        .join(judged, ["host", "path"])
        .select(*(col(name) for name in names), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    )
