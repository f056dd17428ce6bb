"""A corpus, cleaned and packed: each stage reads what the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from tradeloom.llm.common import numbered, table
from tradeloom.llm.queries import TOXIC, toxicity_network
from tradeloom.operators.stage import stage_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the network scores as toxic go.

    It is trained on the labels that are not held out, with the texts of the
    table the labels are about.
    """
    scored = toxicity.score(docs.select(*COLUMNS), toxicity_network(spark, sf_dir))
    return scored.filter(F.col("score") < TOXIC).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of a smaller id holds go; documents stay."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, one of the smallest id."""
    return jaccard.one_of_each_group(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever other rows have their id."""
    rows = numbered(docs.select(*COLUMNS), "__row")
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col="__row")
    hit = found.select(F.col("doc_id").alias("__row")).distinct()
    return rows.join(hit, "__row", "left_anti").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the network; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as
    Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{stage_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{number}-{name}")
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
