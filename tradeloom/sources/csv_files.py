"""Typed CSV reads that skip malformed rows and keep large files splittable."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from tradeloom.sources.catalog import MONEY, SourceSpec
from tradeloom.sources.csv_records import files_with_open_lines, write_records

CORRUPT = "_corrupt_record"
SPLIT_BYTES = 128 * 1024 * 1024
# A doubled quote inside quotes stands for one quote.
DIALECT = {"header": True, "quote": '"', "escape": '"'}
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


class MissingSource(FileNotFoundError):
    """No file matches a source pattern."""


def source_path(folder: str, spec: SourceSpec) -> str:
    """Where a source is looked for: its file name with any data-set prefix. A
    folder may hold one data set only, as a file or a folder of parts."""
    return f"{folder.rstrip('/')}/{spec.pattern}"


def list_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Path and size of the non-empty files behind a path or pattern."""
    try:
        files = spark.read.format("binaryFile").load(path).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingSource(path) from error
        raise
    found = {row["path"]: row["length"] for row in files.filter("length > 0").collect()}
    if not found:
        raise MissingSource(path)
    return found


def read_source(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    malformed: str = "skip",
    money: str = MONEY,
    infer: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Read one source with its declared types.

    ``malformed="skip"`` drops rows that are too short, too long or badly
    typed; ``"keep"`` returns them too, with their text in ``_corrupt_record``.
    ``infer=True`` lets Spark guess the types in a second pass instead.

    All columns are parsed whichever are selected, so the rows do not depend on
    that, nor on the size of the files.
    """
    files = list_files(spark, path)
    sets = {part for name in files for part in name.split("/") if part.endswith(f"{spec.file}.csv")}
    if len(sets) > 1:
        raise ValueError(f"{path} matches several data sets: {', '.join(sorted(sets))}")
    if infer:
        guessing = spark.read.options(**DIALECT, multiLine=True, inferSchema=True)
        return guessing.option("mode", "DROPMALFORMED").csv(path)

    header = spark.read.options(**DIALECT, multiLine=True).csv(min(files)).columns
    schema = spec.schema(header, money)
    if malformed == "keep":
        schema = schema.add(CORRUPT, "string")
    reader = (
        spark.read.schema(schema)
        .options(**DIALECT, enforceSchema=False, columnPruning=False)
        .option("mode", "PERMISSIVE" if malformed == "keep" else "DROPMALFORMED")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    found = _read_by_shape(spark, reader, path, files, split_bytes, header)
    # A badly typed value shows only where its column is read, so read all.
    every = F.array(*(F.col(f"`{name}`").cast("string") for name in found.columns))
    return found.filter(F.size(every) == len(found.columns))


def _read_by_shape(
    spark: SparkSession,
    reader: DataFrameReader,
    path: str,
    files: dict[str, int],
    split_bytes: int,
    header: list[str],
) -> DataFrame:
    """Read each file in the way that is right for it and most parallel.

    A file within one split is one task either way, so it is read with quoted
    line ends allowed. A larger file is cut at line ends if no quoted field of
    it holds one and no quote is out of place, else at record ends. A file that
    is compressed, or holds a record too large for one row or a quote that is
    never closed, streams through a task of its own.
    """
    large = [n for n, size in files.items() if size > split_bytes and not n.endswith(COMPRESSED)]
    broken = files_with_open_lines(spark, large) if large else set()
    by_line = [name for name in large if name not in broken]
    cut, odd, failed = write_records(spark, sorted(broken), header) if broken else (None, None, set())
    apart = set(by_line) | (broken - failed)
    whole = [name for name in files if name not in apart]
    if not apart:
        return reader.option("multiLine", True).csv(path)
    parts = []
    if whole:
        parts.append(reader.option("multiLine", True).csv(whole))
    if by_line:
        parts.append(reader.option("multiLine", False).csv(by_line))
    # Each file of these folders holds whole records, without a header.
    for folder in filter(None, (cut, odd)):
        parts.append(reader.option("header", False).option("lineSep", "\n").option("multiLine", True).csv(folder))
    return reduce(DataFrame.unionByName, parts)
