"""Cut large CSV files with quoted line ends into records, in parallel."""

from __future__ import annotations

import csv
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tradeloom.operators.stage import stage_folder, staged

# Stands for a quoted part of a line once its text is taken out.
QUOTED = "\x01"
RECORD_BYTES = 16 * 1024 * 1024


def without_quoted(text: Column) -> Column:
    """``text`` with ``QUOTED`` for each quoted part; a stray quote stays."""
    bare = F.replace(F.replace(text, F.lit(QUOTED), F.lit("?")), F.lit('""'), F.lit(""))
    return F.regexp_replace(bare, '"[^"]*"', QUOTED)


def is_whole(text: Column) -> Column:
    """Is ``text`` a whole number of fields, with line ends in quotes only?

    No stray quote is left, and a quoted part fills its field. The time is
    linear in the text, however many fields it has.
    """
    rest = without_quoted(F.regexp_replace(text, "\r$", ""))
    return ~rest.contains('"') & ~rest.rlike(f"[^,]{QUOTED}|{QUOTED}[^,]") & ~rest.rlike("[\r\n]")


def is_whole_line(text: Column) -> Column:
    """``is_whole`` for a line: a carriage return within it would end a line for
    the reader by lines, quoted or not."""
    return is_whole(text) & ~F.regexp_replace(text, "\r$", "").contains("\r")


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths)


def files_with_open_lines(spark: SparkSession, paths: list[str]) -> set[str]:
    """The files of ``paths`` in which some line is not a whole number of fields,
    or holds a carriage return.

    If every line is whole, the first one ends a record, so the second starts one,
    and so on: line ends and record ends are the same.
    """
    text = F.col("value")
    bare = ~text.contains('"') & ~text.contains("\r")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    whole = F.when(bare, True).when(quotes % 2 == 1, False).otherwise(is_whole_line(text))
    open_lines = read_lines(spark, paths).filter(~whole)
    found = open_lines.select("_metadata.file_path").distinct().collect()
    # Metadata names files as URIs, in which a blank is %20; readers take paths.
    named = spark.read.format("binaryFile").load(paths).select("path", "_metadata.file_path")
    path_of = {row["file_path"]: row["path"] for row in named.collect()}
    return {path_of[row["file_path"]] for row in found}


def quote_turns(text: Column) -> tuple[Column, Column]:
    """What a line does to the state "inside quotes": whether it ends that state
    at some place, and whether it turns it oddly often behind the last such place.

    This is how the reader goes on. A field is quoted if it begins with a quote.
    Inside quotes two of them stand for one, and a single one ends the quoted
    part, whatever follows up to the next comma. A quote elsewhere in a field
    is text. So of the runs of quotes only the odd ones count: one at the start
    of a line or behind a comma turns the state, any other one ends it.
    """
    single = F.replace(F.replace(text, F.lit('""'), F.lit("")), F.lit(QUOTED), F.lit("?"))
    turned = F.replace(F.concat(F.lit(","), single), F.lit(',"'), F.lit(QUOTED))
    behind = F.substring_index(turned, '"', -1)
    turns = F.octet_length(behind) - F.octet_length(F.replace(behind, F.lit(QUOTED), F.lit("")))
    return turned.contains('"'), turns % 2 == 1


def lines_open(text: Column) -> Column:
    """Whether a line ends within quotes: ``closed`` if it begins outside of
    them, ``open`` if inside; see ``quote_turns``."""
    ends, odd = quote_turns(text)
    return F.struct(odd.alias("closed"), F.when(ends, odd).otherwise(~odd).alias("open"))


def with_state(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``before``: the state (in quotes or not) before each row of a group,
    as ``closed`` and ``open`` for what it may be before the first one.

    Each row has ``after``, the state it leaves for either state it finds. A row
    that leaves the same for both settles it; from the last such row on only
    rows matter that turn one state into the other.
    """
    by = W.partitionBy(*keys).orderBy(order)
    earlier = by.rowsBetween(W.unboundedPreceding, -1)
    turns = F.col("after.closed") & ~F.col("after.open")
    settles = F.col("after.closed") == F.col("after.open")
    rows = rows.withColumn("turns", F.coalesce(F.count_if(turns).over(earlier), F.lit(0)))
    settled = F.struct(F.col("after.closed").alias("state"), "turns")
    rows = rows.withColumn("settled", F.last(F.when(settles, settled), ignorenulls=True).over(earlier))
    turned = (F.col("turns") - F.coalesce("settled.turns", F.lit(0))) % 2 == 1
    state = [
        (F.coalesce("settled.state", F.lit(name == "open")) != turned).alias(name) for name in ("closed", "open")
    ]
    return rows.withColumn("before", F.struct(*state)).drop("turns", "settled")


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with the number of the record they belong to, counted per file.

    A line starts a record if it begins outside quotes. Each split is worked
    out for both states it may begin in; one row per split then carries state
    and count over to the next.
    """
    lines = read_lines(spark, paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
        lines_open(F.col("value")).alias("after"),
    )
    upto = W.partitionBy("file", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = with_state(lines, ["file", "block"], "pos")
    for name in ("closed", "open"):
        counted = counted.withColumn(f"starts_if_{name}", F.count_if(~F.col(f"before.{name}")).over(upto))

    leaves = F.struct(
        *(F.when(F.col(f"before.{n}"), F.col("after.open")).otherwise(F.col("after.closed")).alias(n) for n in ("closed", "open"))
    )
    splits = counted.groupBy("file", "block").agg(
        F.max_by(leaves, "pos").alias("after"),
        F.max("starts_if_closed").alias("closed_starts"),
        F.max("starts_if_open").alias("open_starts"),
    )
    previous = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = (
        with_state(splits, ["file"], "block")
        .withColumn("opens", F.col("before.closed"))
        .withColumn("starts", F.when(F.col("opens"), F.col("open_starts")).otherwise(F.col("closed_starts")))
        .withColumn("records", F.coalesce(F.sum("starts").over(previous), F.lit(0)))
        .select("file", "block", "opens", "records")
    )
    started = F.when(F.col("opens"), F.col("starts_if_open")).otherwise(F.col("starts_if_closed"))
    is_in = F.when(F.col("opens"), F.col("before.open")).otherwise(F.col("before.closed"))
    return counted.join(splits, ["file", "block"]).select(
        "file",
        "block",
        "pos",
        "value",
        (F.col("records") + started - 1).alias("record"),
        F.when(is_in, F.col("after.open")).otherwise(F.col("after.closed")).alias("ends_open"),
    )


def fixed_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their file (hashed), split and place. Each split is a task of
    its own, so every job over the frame gives a line the same place."""
    apart = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if apart.conf.isModifiable(key):
            apart.conf.set(key, value)
    apart.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return read_lines(apart, paths).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


#: Of a split that begins in a given state: the state it ends in, the records
#: that start in it, the places of the first two and of the last one, the bytes
#: before the first start, from the last one on and of the largest record
#: between, and the records that end in it with and without a carriage return.
SIDE = (
    "struct<ends:boolean,starts:bigint,first:bigint,second:bigint,last:bigint,"
    "head:bigint,tail:bigint,most:bigint,cr:bigint,plain:bigint>"
)


def split_states(lines: DataFrame) -> DataFrame:
    """One row per split, with a ``SIDE`` for either state it may begin in."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        class Side:
            def __init__(self, open_: int):
                self.state, self.first, self.second, self.last = open_, None, None, None
                self.starts = self.head = self.tail = self.most = self.cr = self.plain = 0

            def add(self, pos, ends, odd, size, cr):
                turns = np.cumsum(odd)
                base = np.maximum.accumulate(np.where(ends, np.arange(len(pos)), -1))
                after = np.where(base >= 0, turns - turns[base] + odd[base], turns + self.state) & 1
                at = np.flatnonzero(np.append(self.state, after[:-1]) == 0)
                self.state = int(after[-1])
                self.cr += int((cr & (after == 0)).sum())
                self.plain += int((~cr & (after == 0)).sum())
                before = int(size[: at[0] if len(at) else len(size)].sum())
                if self.starts:
                    self.tail += before
                else:
                    self.head += before
                if not len(at):
                    return
                sums = np.add.reduceat(size, at)
                if self.starts:
                    self.most = max(self.most, self.tail)
                self.most = max(self.most, int(sums[:-1].max(initial=0)))
                self.tail, self.last = int(sums[-1]), int(pos[at[-1]])
                some = [p for p in (self.first, self.second) if p is not None] + pos[at[:2]].tolist()
                self.first, self.second = (some + [None])[:2]
                self.starts += len(at)

            def row(self):
                return {
                    "ends": bool(self.state), "starts": self.starts, "first": self.first, "second": self.second,
                    "last": self.last, "head": self.head, "tail": self.tail, "most": self.most, "cr": self.cr,
                    "plain": self.plain,
                }

        longs = ("starts", "first", "second", "last", "head", "tail", "most", "cr", "plain")
        side = pa.struct([("ends", pa.bool_()), *((name, pa.int64()) for name in longs)])
        schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("closed", side), ("open", side)])

        def row(key, sides):
            found = {"file": key[0], "block": key[1], "closed": sides[0].row(), "open": sides[1].row()}
            return pa.RecordBatch.from_pylist([found], schema=schema)

        key = sides = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block, pos, size = (batch[name].to_numpy() for name in ("file", "block", "pos", "size"))
            ends, odd, cr = (batch[name].to_numpy(zero_copy_only=False) for name in ("ends", "odd", "cr"))
            size, odd = size.astype(np.int64), odd.astype(np.int64)
            cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pos)]):
                if (int(file[low]), int(block[low])) != key:
                    if key:
                        yield row(key, sides)
                    key, sides = (int(file[low]), int(block[low])), (Side(0), Side(1))
                for one in sides:
                    one.add(*(v[low:high] for v in (pos, ends, odd, size, cr)))
        if key:
            yield row(key, sides)

    ends, odd = quote_turns(F.col("value"))
    flags = lines.select(
        "file",
        "block",
        "pos",
        ends.alias("ends"),
        odd.alias("odd"),
        F.octet_length("value").alias("size"),
        F.col("value").endswith("\r").alias("cr"),
    )
    return flags.mapInArrow(run, f"file bigint, block bigint, closed {SIDE}, open {SIDE}")


def split_starts(states: DataFrame) -> DataFrame:
    """The splits with the state they do begin in: the ``SIDE`` of that state,
    and ``records``, the number of records of the file that start before."""
    after = F.struct(F.col("closed.ends").alias("closed"), F.col("open.ends").alias("open"))
    known = with_state(states.withColumn("after", after), ["file"], "block")
    side = F.when(F.col("before.closed"), F.col("open")).otherwise(F.col("closed"))
    previous = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    chosen = known.select("file", "block", side.alias("side")).select("file", "block", "side.*")
    return chosen.withColumn("records", F.coalesce(F.sum("starts").over(previous), F.lit(0)))


def write_records(
    spark: SparkSession, paths: list[str], header: list[str]
) -> tuple[str | None, str | None, set[str]]:
    """Write the records of ``paths``, without headers, to a new shared folder,
    in files that each hold whole records.

    Each split is worked out for both states it may begin in; one row per split
    then carries state and count over to the next. The lines of the records that
    start and end within a split stay in their order and go to a file as they
    are; of each split only the record at either end is put together. Files of
    which some records end with a carriage return and some do not go to a second
    folder, record by record. Also returns the files with a record too large for
    one row, or with a quote that is never closed; the others are written all
    the same.
    """
    lines = fixed_lines(spark, paths)
    splits = staged(split_starts(staged(split_states(lines), "csv-splits")), "csv-starts")

    edges = splits.select("file", (F.col("records") - 1).alias("record"), F.col("head").alias("bytes")).union(
        splits.filter("starts > 0").select("file", F.expr("records + starts - 1"), "tail")
    )
    sizes = edges.groupBy("file", "record").agg(F.sum("bytes").alias("bytes")).select("file", "bytes")
    last = splits.groupBy("file").agg(F.max_by("ends", "block").alias("ends"))
    unfit = (
        sizes.union(splits.select("file", "most"))
        .filter(F.col("bytes") > RECORD_BYTES)
        .select("file")
        .union(last.filter("ends").select("file"))
    )
    large = {r.file for r in unfit.distinct().collect()}
    ends = splits.groupBy("file").agg(F.sum("cr").alias("cr"), F.sum("plain").alias("plain"))
    mixed = {r.file for r in ends.filter("cr > 0 AND plain > 0").collect()} - large

    listed = spark.read.format("binaryFile").load(paths)
    named = listed.select("path", "_metadata.file_path", F.xxhash64("_metadata.file_path").alias("file")).collect()
    if len({row["file"] for row in named}) < len({row["file_path"] for row in named}):
        raise ValueError("two file names have the same hash")
    failed = {row["path"] for row in named if row["file"] in large}
    mixed_paths = sorted(row["path"] for row in named if row["file"] in mixed)
    folder = f"{stage_folder(spark)}/csv-cut-{uuid.uuid4().hex}"
    cut = apart = None
    if len(failed) + len(mixed_paths) < len(paths):
        cut = folder
        _write_cut(lines, splits.filter(~F.col("file").isin(*large, *mixed)), header, folder)
    if mixed_paths:
        apart = f"{folder}-apart"
        _write_one_by_one(spark, mixed_paths, header, apart)
    return cut, apart, failed


def _write_cut(lines: DataFrame, splits: DataFrame, header: list[str], folder: str) -> None:
    """Write the records of files of one kind of line ends; ``splits`` are theirs."""
    crlf = splits.groupBy("file").agg((F.sum("cr") > 0).alias("crlf"))
    known = splits.join(F.broadcast(crlf), "file").select("file", "block", "starts", "first", "second", "last", "records", "crlf")
    record = (
        F.when(F.col("first").isNull() | (F.col("pos") < F.col("first")), F.col("records") - 1)
        .when(F.col("pos") >= F.col("last"), F.col("records") + F.col("starts") - 1)
        .when((F.col("records") == 0) & (F.col("pos") < F.col("second")), F.lit(0))
    )
    # As in a whole read: if CRLF ends the records, LF stands for it in quotes.
    text = F.when(F.col("crlf") & F.col("value").endswith("\r"), F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
    placed = lines.join(F.broadcast(known), ["file", "block"]).select("file", "block", "pos", text.alias("text"), record.alias("record"))
    placed.filter("record IS NULL").select("text").write.text(folder)
    ordered = F.sort_array(F.collect_list(F.struct("block", "pos", "text")))
    joined = F.array_join(F.transform(ordered, lambda line: line["text"]), "\n")
    edges = staged(placed.filter("record IS NOT NULL").groupBy("file", "record").agg(joined.alias("text")), "csv-edges")
    check_heads(edges, header)
    edges.filter("record > 0").select("text").write.mode("append").text(folder)


def _write_one_by_one(spark: SparkSession, paths: list[str], header: list[str], folder: str) -> None:
    lines = staged(numbered_lines(spark, paths), "csv-lines")
    ordered = F.sort_array(F.collect_list(F.struct("block", "pos", "value")))
    text = F.array_join(F.transform(ordered, lambda line: line["value"]), "\n")
    records = staged(lines.groupBy("file", "record").agg(text.alias("text")), "csv-records")
    check_heads(records, header)
    crlf = F.regexp_replace(F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n")), "\r$", "")
    text = F.when(F.col("text").endswith("\r"), crlf).otherwise(F.col("text"))
    records.filter("record > 0").select(text.alias("text")).write.text(folder)


def check_heads(records: DataFrame, header: list[str]) -> None:
    heads = records.filter("record = 0").select(F.regexp_replace("text", "\r$", "").alias("text")).distinct()
    for row in heads.take(2):
        names = next(csv.reader([row.text.removeprefix("\ufeff")], doublequote=True), [])
        if names != header:
            raise ValueError(f"CSV header does not conform: {names} instead of {header}")
