"""Rows, characters and runs that a shorter way would lose."""

from __future__ import annotations

import random
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tradeloom.llm import decontaminate, jaccard, line_dedup, secrets

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"row {n}", len(t)) for n, (i, t) in enumerate(rows)], COLUMNS).repartition(3)


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


# Stages decide per row -----------------------------------------------------------------


def test_contaminated_rows_go_alone(spark, tmp_path):
    item = " ".join(words(12, 1))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [" ".join(words(30, n)) for n in range(2, 7)]
    rows = [(None, clean[0]), (None, f"{clean[1]} {item}"), (None, clean[2]), (7, clean[3]), (7, f"{item} {clean[4]}"), (8, clean[4])]
    kept = corpus_pipeline.decontamination_stage(spark, documents(spark, rows), str(tmp_path))
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert {r.source for r in kept.collect()} == {"row 0", "row 2", "row 3", "row 5"}


def test_one_row_of_each_group_stays(spark):
    base = words(120, 1)
    near, other, third = " ".join(base), " ".join(words(60, 2)), " ".join(words(60, 3))
    rows = [(4, other)] * 3 + [(None, near), (None, near + " end"), (None, near), (None, third), (4, third + " end"), (9, "")]
    kept = corpus_pipeline.jaccard_stage(spark, documents(spark, rows), "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text[:20]) for r in kept) == sorted(
        [(False, 4, other[:20]), (True, 0, near[:20]), (False, 4, third[:20]), (False, 9, "")]
    )
    assert jaccard.one_of_each_group(documents(spark, rows).limit(0)).count() == 0


# Folding keeps places ------------------------------------------------------------------


def test_a_dotted_capital_does_not_stop_folding(spark):
    assert all(len(decontaminate.folded(chr(c))) == 1 for c in range(sys.maxunicode + 1))
    item = "a short benchmark item"
    docs = documents(spark, [(1, f"İstanbul. {item.upper()}."), (2, "İstanbul")])
    benchmark = spark.createDataFrame([(5, item), (6, "İSTANBUL")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.distance, r.start, r.end) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(1, 5): (0, 10, 32), (1, 6): (0, 0, 8), (2, 6): (0, 0, 8)}


# Secrets beside ordinary text ----------------------------------------------------------

LETTERS = secrets.ALPHABET[:62]
ORDINARY = "the international information station of nation services customer orders download total index".split()


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    odd = [("".join(rng.choices(LETTERS, k=32)), True) for _ in range(300)]
    plain = [(rng.choice("/_-=").join(rng.choices(ORDINARY, k=5)), False) for _ in range(300)]
    return secrets.train(spark.createDataFrame(odd + plain, "token string, is_random boolean"))


def test_secrets_within_ordinary_runs(spark, model):
    rng = random.Random(2)
    path = "/the/international/information/station/of/the/nation/"
    keys = ["".join(rng.choices(LETTERS, k=32)) for _ in range(60)]
    around = ["{}", path + "{}", path + "{}" + path, "index_total_customer_{}", "{}" + path + "{}", "0123456789abcdef" + path + "{}", "{}/token=abcdefghijkl"]
    docs = [(n, around[n % len(around)].format(key, key)) for n, key in enumerate(keys)] + [(99, path * 3)]
    rows = {r.doc_id: r for r in secrets.scan(documents(spark, docs), model).collect()}
    missed = 0
    for n, key in enumerate(keys):
        spans = [(s.start, s.end) for s in rows[n].secrets if s.kind == "random"]
        places = [i for i in range(len(docs[n][1])) if docs[n][1].startswith(key, i)]
        missed += not all(any(s <= i and i + 32 <= e for s, e in spans) for i in places)
    assert missed <= 2
    assert not rows[99].secrets


def test_samples_leave_short_values_and_spread_over_ids(spark):
    secret = "Xk29dLq0Wz7Rt5"
    docs = documents(spark, [(n, "token: string password = required") for n in range(300)] + [(n, f"token={secret} word") for n in range(300, 600)])
    rows = secrets.labelled_samples(docs, "doc_id", "text", 200).collect()
    assert {r.token for r in rows if r.is_random} == {secret}
    assert {r.token for r in rows if not r.is_random} == {"word"}
    assert 60 <= sum(r.is_random for r in rows) <= 140


def test_second_half_of_a_line_hash_is_not_made_of_the_first(spark):
    lines = spark.createDataFrame([("a line",), ("another line",)], "line string")
    key = F.col("line")
    rows = lines.select(line_dedup.key_hash(key).alias("h"), F.xxhash64(key, F.lit(1)).alias("chained")).collect()
    assert all(r.h.b not in (r.h.a, r.chained) for r in rows)
