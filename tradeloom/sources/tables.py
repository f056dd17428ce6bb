"""Catalog tables: databases, full refresh, loads and load summary."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.sources.catalog import MONEY, RAW, SOURCES, SourceSpec
from tradeloom.sources.csv_files import MissingSource, read_source, source_path


#: Seconds for which a replaced version of a table can still be read.
KEEP_SECONDS = 24 * 3600


@dataclass
class LoadResult:
    """Rows per loaded table, and the tables whose file was missing."""

    rows: dict[str, int] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def replace_table(
    df: DataFrame,
    database: str,
    table: str,
    root: str | None = None,
    partition_by: str | None = None,
    comment: str | None = None,
    keep_seconds: float = KEEP_SECONDS,
    hidden: Iterable[str] = (),
) -> DataFrame:
    """Replace a Parquet table with ``df`` and return the table.

    The rows are written as a new version, a table of its own in the database
    ``<database>_versions`` and a folder of its own below ``root/database/table``
    (without ``root`` below the session's warehouse). ``database.table`` is a
    view of one version, so one catalog change switches it when all rows are
    written: a reader finds the old rows or the new ones, never none. Until
    then, and if anything fails, the old rows are read. Versions replaced more
    than ``keep_seconds`` ago go, so a frame planned on one of them can be read
    that long. Columns in ``hidden`` are in the version, but not in the table.
    """
    spark = df.sparkSession
    ensure_database(spark, database)
    ensure_database(spark, versions_of(database))
    base = (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + f"/{database}/{table}"
    version = f"{table}_v{time.time_ns() // 10**6}_{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.option("compression", "zstd").parquet(f"{base}/{version}")

    name = f"`{versions_of(database)}`.`{version}`"
    spark.catalog.createTable(name, f"{base}/{version}", source="parquet", description=comment)
    if partition_by:
        spark.catalog.recoverPartitions(name)
    switch(spark, database, table, version, comment, *([hidden] if hidden else []))
    expire_versions(spark, database, table, base, keep_seconds)
    return spark.table(f"`{database}`.`{table}`")


def versions_of(database: str) -> str:
    return f"{database}_versions"


def switch(
    spark: SparkSession,
    database: str,
    table: str,
    version: str,
    comment: str | None = None,
    hidden: Iterable[str] = (),
) -> None:
    """Let a table show a version, in one change of the catalog."""
    name = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a plain table of that name, once
    text = "COMMENT '{}'".format(comment.replace("\\", "\\\\").replace("'", "\\'")) if comment else ""
    source = f"`{versions_of(database)}`.`{version}`"
    shown = ", ".join(f"`{c}`" for c in spark.table(source).columns if c not in hidden) if hidden else "*"
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} {text} TBLPROPERTIES ('version' = '{version}') AS SELECT {shown} FROM {source}"
    )


def version_frame(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The version a table shows, with its hidden columns."""
    return spark.table(f"`{versions_of(database)}`.`{current_version(spark, database, table)}`")


def current_version(spark: SparkSession, database: str, table: str) -> str | None:
    name = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(name):
        return None
    found = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get("version")


def location(spark: SparkSession, name: str) -> str:
    """Folder of a table; another version may lie below another root."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def expire_versions(
    spark: SparkSession, database: str, table: str, base: str, keep_seconds: float = KEEP_SECONDS
) -> list[str]:
    """Remove versions of a table that were replaced, or that failed before they
    were shown, more than ``keep_seconds`` ago; their names.

    No write may take longer than that. A version's name holds its time, and it
    was replaced when the next one that is in the catalog was made.
    """
    pattern = re.compile(re.escape(table) + "_v([0-9]+)_[0-9a-f]{8}")
    made = lambda name: int(pattern.fullmatch(name)[1])
    listed = {t.name for t in spark.catalog.listTables(versions_of(database)) if pattern.fullmatch(t.name)}
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = {f.getPath().getName() for f in files.listStatus(path)} if files.exists(path) else set()
    current, now = current_version(spark, database, table), time.time_ns() // 10**6
    gone = []
    for version in sorted({f for f in folders if pattern.fullmatch(f)} | listed, key=made):
        later = [made(other) for other in listed if made(other) > made(version)]
        replaced = min(later, default=now) if version in listed else made(version)
        if version != current and now - replaced >= keep_seconds * 1000:
            name = f"`{versions_of(database)}`.`{version}`"
            folder = spark._jvm.org.apache.hadoop.fs.Path(location(spark, name) if version in listed else f"{base}/{version}")
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            gone.append(version)
    return gone


def load_table(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    root: str | None = None,
    money: str = MONEY,
    infer: bool = False,
) -> int:
    """Load one source into ``raw`` and count what was written."""
    source = read_source(spark, spec, path, money=money, infer=infer)
    return replace_table(source, RAW, spec.table, root, comment=spec.comment).count()


def load_all(
    spark: SparkSession,
    folder: str,
    files: dict[str, str] | None = None,
    root: str | None = None,
    on_missing: str = "skip",
    money: str = MONEY,
    infer: bool = False,
    parallel: int = 4,
) -> LoadResult:
    """Load every source found in ``folder``; safe to repeat.

    ``files`` gives a path or pattern of its own to some tables. A missing file
    is skipped and reported, or fails the load with ``on_missing="fail"``; the
    other tables are independent jobs either way.
    """
    if on_missing not in ("skip", "fail"):
        raise ValueError(f"on_missing is skip or fail, not {on_missing!r}")
    ensure_database(spark, RAW)
    paths = {name: source_path(folder, spec) for name, spec in SOURCES.items()}
    paths.update(files or {})

    def load(name: str) -> int | None:
        try:
            return load_table(spark, SOURCES[name], paths[name], root, money, infer)
        except MissingSource:
            if on_missing == "fail":
                raise
            return None

    result = LoadResult()
    for name, rows in side_by_side(load, SOURCES, parallel):
        if rows is None:
            result.missing.append(name)
        else:
            result.rows[name] = rows
    return result


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of every table, by name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def load_summary(spark: SparkSession, database: str = RAW) -> DataFrame:
    """Exact row counts of all tables in a database."""
    names = [table.name for table in spark.catalog.listTables(database) if not table.isTemporary]
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return row_counts(read_tables(spark, names, database))


def read_tables(spark: SparkSession, names: Iterable[str], database: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"`{database}`.`{name}`") for name in names}


def side_by_side(job: Callable, names: Iterable[str], parallel: int) -> list[tuple]:
    """Run independent Spark jobs from several driver threads."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(zip(names, pool.map(job, names)))
