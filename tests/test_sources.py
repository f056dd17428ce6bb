"""CSV loads: malformed rows, quoting, large files, missing files, repeats."""

import random
import shutil
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

import shop
from tradeloom.functions.measures import value_segment
from tradeloom.sources.catalog import SOURCES
from tradeloom.sources.csv_files import CORRUPT, MissingSource, read_source, source_path
from tradeloom.sources.csv_records import (
    files_with_open_lines,
    numbered_lines,
    read_lines,
    write_records,
)
from tradeloom.sources import csv_records, tables
from tradeloom.sources.tables import expire_versions, load_all, load_summary, replace_table

ITEMS = SOURCES["order_items"]
HEADER = ",".join(ITEMS.columns)
GOOD = 'o1,1,"x,1",s1,2017-01-01,1.50,0.10'
QUOTED = 'o2,2,"say ""hi""",s1,,2.50,0.20'
BROKEN_LINE = 'o3,3,"two\nlines",s1,2017-01-01,3.50,0.30'
SHORT, LONG, BAD = "o4,4,x4", "o5,5,x5,s1,t,1,2,extra", "o6,six,x6,s1,t,1,2"


def write(folder, *lines, name="part-0.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")
    return str(folder)


def ids(df):
    return sorted(row.order_id for row in df.collect())


def test_types_and_quotes(spark, tmp_path):
    path = write(tmp_path / "a", GOOD, QUOTED, BROKEN_LINE)
    rows = {row.order_id: row for row in read_source(spark, ITEMS, path).collect()}
    assert rows["o1"].product_id == "x,1" and rows["o1"].price == Decimal("1.50")
    assert rows["o2"].product_id == 'say "hi"' and rows["o2"].shipping_limit_date is None
    assert rows["o3"].product_id == "two\nlines"


@pytest.mark.parametrize("split_bytes", [10, 10**9])
def test_malformed_rows_are_skipped(spark, tmp_path, split_bytes):
    path = write(tmp_path / "a", GOOD, SHORT, LONG, BAD, QUOTED)
    assert ids(read_source(spark, ITEMS, path, split_bytes=split_bytes)) == ["o1", "o2"]


def test_malformed_rows_can_be_kept(spark, tmp_path):
    path = write(tmp_path / "a", GOOD, SHORT, BAD, QUOTED)
    kept = read_source(spark, ITEMS, path, malformed="keep").collect()
    assert len(kept) == 4
    assert sorted(row[CORRUPT] for row in kept if row[CORRUPT]) == [SHORT, BAD]


def test_large_files_split_only_where_lines_are_records(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    write(folder, GOOD, QUOTED, name="plain one.csv")
    path = write(folder, BROKEN_LINE, GOOD.replace("o1", "o7"), name="é broken.csv")
    names = [f"{path}/plain one.csv", f"{path}/é broken.csv"]
    assert files_with_open_lines(spark, names) == {f"file:{names[1]}"}
    rows = read_source(spark, ITEMS, path, split_bytes=10).collect()
    assert sorted(row.order_id for row in rows) == ["o1", "o2", "o3", "o7"]
    assert {row.product_id for row in rows} >= {"two\nlines", 'say "hi"'}


@pytest.mark.parametrize(
    "line",
    [
        'a,"b',
        'a,"b ""c',
        'a,5" pipe,"text',
        'a,""",',
        'a, "padded',
        "a,b\rc",
        'a,"b"c"',
    ],
)
def test_lines_that_may_go_on_are_found(spark, tmp_path, line):
    (tmp_path / "f.csv").write_bytes(f"x,y\n{line}\nz,w\n".encode())
    assert files_with_open_lines(spark, [str(tmp_path / "f.csv")])


def test_complete_lines_are_not_suspected(spark, tmp_path):
    lines = ['a,"b"', '"",""', '"""a""","b,c"', "", ",", 'a,"x ""y"" z",']
    (tmp_path / "f.csv").write_bytes("\r\n".join(lines).encode())
    assert not files_with_open_lines(spark, [str(tmp_path / "f.csv")])


REVIEWS = SOURCES["order_reviews"]


def reviews_file(path, end="\n", rows=400):
    """Reviews whose comments hold quotes, commas and one to three line ends."""
    texts = ['plain', f'two{end}lines', f'"quoted", said{end}{end}they', f'a{end}"b"{end}c,"', '']
    lines = [",".join(REVIEWS.columns)]
    for i in range(rows):
        text = shop.quoted(texts[i % 5], always=i % 2 == 0)
        lines.append(f"r{i},o{i % 7},{i % 5 + 1},t,{text},2017-01-01,")
    path.write_bytes((end.join(lines) + end).encode())
    return str(path)


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_cut_in_parallel_equal_a_whole_read(spark, tmp_path, small_splits, end):
    reviews_file(tmp_path / "a.csv", end)
    reviews_file(tmp_path / "b.csv", end, rows=90)
    names = [str(tmp_path / name) for name in ("a.csv", "b.csv")]
    assert read_lines(spark, names).rdd.getNumPartitions() > 5
    whole = read_source(spark, REVIEWS, str(tmp_path)).collect()
    cut = read_source(spark, REVIEWS, str(tmp_path), split_bytes=10).collect()
    assert len(whole) == 490 and write_records(spark, names, list(REVIEWS.columns))[1:] == (None, set())
    assert sorted(map(str, cut)) == sorted(map(str, whole))


def test_malformed_records_are_skipped_when_cut(spark, tmp_path, small_splits):
    path = reviews_file(tmp_path / "a.csv", rows=50)
    with open(path, "a", newline="") as file:
        file.write('r97,o,5,t,"kept\r\nas it is",,\n')
        file.write('short,"a\nb"\nr98,o,bad,t,x,,\nr99,o,5,t,"x\ny",,\n')
    whole = read_source(spark, REVIEWS, path)
    cut = read_source(spark, REVIEWS, path, split_bytes=10)
    assert "csv-cut" in cut.inputFiles()[0]
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    assert len(cut.collect()) == 52
    assert "kept\r\nas it is" in {row.review_comment_message for row in cut.collect()}
    kept = read_source(spark, REVIEWS, path, malformed="keep", split_bytes=10).collect()
    assert sum(row[CORRUPT] is not None for row in kept) == 2


def test_quotes_out_of_place_are_cut_too(spark, tmp_path, small_splits):
    path = reviews_file(tmp_path / "a.csv", rows=50)
    with open(path, "a") as file:
        file.write('r99,o,5,5" pipe,x,,\nr98,o,5,t,"x\ny",,\n')
    assert write_records(spark, [path], list(REVIEWS.columns))[1:] == (None, set())
    whole = read_source(spark, REVIEWS, path).collect()
    cut = read_source(spark, REVIEWS, path, split_bytes=10)
    assert "csv-cut" in cut.inputFiles()[0] and cut.rdd.getNumPartitions() > 2
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole))
    assert len(whole) == 52


ODD_FIELDS = ["x", "", '"q"', '"two\nlines"', '5" pipe', '"a"b', '"a" b', '""', '"say ""hi"""', 'x"y"z', '"a"b\nc"', '"one""', '"x', "\r", "\x1e", '"\x1e\n"']


@pytest.mark.parametrize("seed", range(12))
def test_stray_quotes_anywhere_give_the_rows_of_a_whole_read(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    common = ODD_FIELDS if seed % 3 else ODD_FIELDS[:6]
    rows = [",".join([f"r{i}", "o", "5", rng.choice(common), rng.choice(common), "", ""]) for i in range(120)]
    path = str(tmp_path / "a_order_reviews_dataset.csv")
    with open(path, "w", newline="") as file:
        file.write("\n".join([",".join(REVIEWS.columns), *rows]) + "\n")
    whole = read_source(spark, REVIEWS, path).collect()
    cut = read_source(spark, REVIEWS, path, split_bytes=10).collect()
    assert sorted(map(str, cut)) == sorted(map(str, whole))


def test_a_record_too_large_for_a_row_takes_the_file_along(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(csv_records, "RECORD_BYTES", 2_000)
    path = reviews_file(tmp_path / "a.csv", rows=50)
    with open(path, "a") as file:
        file.write('r99,o,5,"never closed,x,,\n' + "y\n" * 2_000)
    assert write_records(spark, [path], list(REVIEWS.columns)) == (None, None, {f"file:{path}"})
    whole = read_source(spark, REVIEWS, path).collect()
    assert sorted(map(str, read_source(spark, REVIEWS, path, split_bytes=10).collect())) == sorted(map(str, whole))


def test_records_are_numbered_across_splits(spark, tmp_path, small_splits):
    path = reviews_file(tmp_path / "a.csv", rows=60)
    lines = numbered_lines(spark, [path]).orderBy("block", "pos").collect()
    assert len({row.block for row in lines}) > 2
    assert [row.record for row in lines] == sorted(row.record for row in lines)
    assert {row.record for row in lines} == set(range(61))


def test_column_order_and_extra_columns(spark, tmp_path):
    text = "price,order_id,note,order_item_id,product_id,seller_id,shipping_limit_date,freight_value\n"
    (tmp_path / "f.csv").write_text("﻿" + text + "4.25,o1,hello,1,x1,s1,,0.5\n")
    row = read_source(spark, ITEMS, str(tmp_path / "f.csv")).first()
    assert (row.order_id, row.price, row.note) == ("o1", Decimal("4.25"), "hello")


def test_parts_must_agree_on_their_columns(spark, tmp_path):
    path = write(tmp_path / "a", GOOD)
    other = ",".join(reversed(ITEMS.columns))
    (tmp_path / "a" / "part-1.csv").write_text(other + "\n0.1,1.5,,s1,x1,1,o9\n")
    with pytest.raises(Exception, match="header"):
        read_source(spark, ITEMS, path).collect()


def test_money_type_and_inference(spark, tmp_path):
    path = write(tmp_path / "a", "o1,1,x1,s1,,499.996,0.1")
    assert read_source(spark, ITEMS, path, money="double").first().price == 499.996
    assert dict(read_source(spark, ITEMS, path, infer=True).dtypes)["price"] == "double"


def test_file_names(spark, tmp_path):
    write(tmp_path, GOOD, name="shop_order_items_dataset.csv")
    assert ids(read_source(spark, ITEMS, source_path(str(tmp_path), ITEMS))) == ["o1"]
    with pytest.raises(MissingSource):
        read_source(spark, ITEMS, source_path(str(tmp_path / "none"), ITEMS))


@pytest.fixture()
def csv_folder(tmp_path):
    shop.write_csvs(tmp_path)
    return tmp_path


def test_load_all_and_repeat(spark, csv_folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    expected = {name: len(rows) for name, rows in shop.ROWS.items()}
    for _ in range(2):
        result = load_all(spark, str(csv_folder), root=root)
        assert result.rows == expected and result.missing == []
    summary = [tuple(row) for row in load_summary(spark).collect()]
    assert summary == sorted(expected.items())
    zips = {row.customer_zip_code_prefix for row in spark.table("raw.customers").collect()}
    assert "01234" in zips


def test_full_refresh_replaces_rows(spark, csv_folder, tmp_path_factory):
    load_all(spark, str(csv_folder))
    file = csv_folder / "shop_sellers_dataset.csv"
    file.write_text(file.read_text().splitlines()[0] + "\ns9,1,Here,SP\n")
    assert load_all(spark, str(csv_folder)).rows["sellers"] == 1
    assert spark.table("raw.sellers").first().seller_id == "s9"


def test_missing_files(spark, csv_folder):
    absent = csv_folder / "shop_sellers_dataset.csv"
    shutil.copy(absent, csv_folder / "elsewhere.csv")
    absent.unlink()
    result = load_all(spark, str(csv_folder))
    assert result.missing == ["sellers"] and "orders" in result.rows
    with pytest.raises(MissingSource):
        load_all(spark, str(csv_folder), on_missing="fail")
    moved = load_all(spark, str(csv_folder), files={"sellers": str(csv_folder / "elsewhere.csv")})
    assert moved.missing == [] and moved.rows["sellers"] == 2


HARD_LINES = {
    "lone CR in quotes": 'a{i},1,"two\rparts",s1,t,1,2',
    "line end in quotes": 'a{i},1,"two\nparts",s1,t,1,2',
    "doubled quotes": 'a{i},1,"say ""hi""",s1,t,1,2',
    "short": "a{i},1,x",
    "long": "a{i},1,x,s1,t,1,2,3",
    "badly typed": "a{i},one,x,s1,t,1,2",
    "20,000 commas": "a{i}" + "," * 20_000,
    "blank": "",
}


@pytest.mark.parametrize("case", HARD_LINES)
def test_rows_do_not_depend_on_file_size_or_columns(spark, tmp_path, small_splits, case):
    lines = [(HARD_LINES[case] if i % 10 == 3 else GOOD.replace("o1", "o{i}")).replace("{i}", str(i)) for i in range(60)]
    path = write(tmp_path / "a", *lines)
    whole = read_source(spark, ITEMS, path, split_bytes=10**9)
    cut = read_source(spark, ITEMS, path, split_bytes=1024)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    expected = len(whole.collect())
    for frame in (whole, cut):
        assert frame.count() == len(frame.select("seller_id").collect()) == expected
    assert expected == (60 if "quote" in case else 54)


@pytest.mark.parametrize("split_bytes", [10, 10**9])
@pytest.mark.parametrize("field", ["plain", '"two\nlines"'])
def test_parts_with_another_header_raise_at_any_size(spark, tmp_path, small_splits, split_bytes, field):
    path = write(tmp_path / "a", *[GOOD] * 20)
    other = ",".join(reversed(ITEMS.columns))
    (tmp_path / "a" / "part-1.csv").write_text(other + f"\n0.1,1.5,,s1,{field},1,o9\n" * 20)
    with pytest.raises(Exception, match="header"):
        read_source(spark, ITEMS, path, split_bytes=split_bytes).collect()


def test_only_the_bad_file_is_read_by_one_task(spark, tmp_path, small_splits):
    reviews_file(tmp_path / "good.csv", rows=300)
    with open(reviews_file(tmp_path / "bad.csv", rows=20), "a") as file:
        file.write('r99,o,5,5" pipe,x,,\n')
    cut = read_source(spark, REVIEWS, str(tmp_path), split_bytes=10)
    assert cut.rdd.getNumPartitions() > 10
    assert sorted(map(str, cut.collect())) == sorted(map(str, read_source(spark, REVIEWS, str(tmp_path)).collect()))


def test_two_data_sets_in_one_folder_are_refused(spark, tmp_path):
    for name in ("old_order_items_dataset.csv", "new_order_items_dataset.csv"):
        write(tmp_path, GOOD, name=name)
    with pytest.raises(ValueError, match="several data sets"):
        read_source(spark, ITEMS, source_path(str(tmp_path), ITEMS))
    parts = tmp_path / "one"
    for name in ("part-0.csv", "part-1.csv"):
        parts.mkdir(exist_ok=True)
        write(parts / "shop_order_items_dataset.csv", GOOD, name=name)
    assert ids(read_source(spark, ITEMS, source_path(str(parts), ITEMS))) == ["o1", "o1"]


def test_money_is_loaded_as_it_stands(spark, tmp_path):
    path = write(tmp_path / "a", *(f"o{i},1,x,s,,{v},0" for i, v in enumerate(("149.999", "150", "499.996", "500"))))
    rows = read_source(spark, ITEMS, path).select("order_id", value_segment(F.col("price")).alias("band"))
    bands = [row.band for row in rows.orderBy("order_id").collect()]
    assert bands == ["Low Value", "Mid Value", "Mid Value", "High Value"]


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    good = spark.range(5).withColumn("year", F.col("id") % 2)
    for rows in (good, good.filter("id < 3")):
        table = replace_table(rows, "switched", "t", str(tmp_path), partition_by="year", comment="of years")
    assert table.count() == 3 and table.filter("year = 1").count() == 1
    failing = good.withColumn("id", F.when(F.col("id") == 4, F.raise_error("no")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        replace_table(failing, "switched", "t", str(tmp_path), partition_by="year")
    assert sorted(row.id for row in spark.table("switched.t").collect()) == [0, 1, 2]
    replace_table(good.select("id"), "switched", "t", str(tmp_path))
    assert spark.table("switched.t").columns == ["id"]


def versions(spark, database):
    return {t.name for t in spark.catalog.listTables(f"{database}_versions")}


def test_a_frame_planned_before_a_refresh_can_be_read_after_it(spark, tmp_path):
    first = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 AS year")
    old = replace_table(first, "refreshed", "t", str(tmp_path), partition_by="year")
    planned = old.filter("year = 1")
    planned._jdf.queryExecution().executedPlan()
    replace_table(first.filter("id < 10"), "refreshed", "t", str(tmp_path), partition_by="year")
    assert planned.count() == 333 and spark.table("refreshed.t").count() == 10
    assert len(versions(spark, "refreshed")) == 2
    # Once its time is over the replaced version goes, and only that.
    assert len(expire_versions(spark, "refreshed", "t", f"{tmp_path}/refreshed/t", keep_seconds=0)) == 1
    assert len(versions(spark, "refreshed")) == 1 == len(list((tmp_path / "refreshed" / "t").iterdir()))
    assert spark.table("refreshed.t").count() == 10


@pytest.mark.parametrize("step", ["switch", "expire_versions"])
def test_a_refresh_that_stops_halfway(spark, tmp_path, monkeypatch, step):
    database = f"halfway_{step}"
    replace_table(spark.range(5), database, "t", str(tmp_path), comment="a 'quoted' one")

    def stops(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables, step, stops)
        with pytest.raises(RuntimeError):
            replace_table(spark.range(9), database, "t", str(tmp_path))
    assert spark.table(f"{database}.t").count() == (5 if step == "switch" else 9)
    replace_table(spark.range(7), database, "t", str(tmp_path), keep_seconds=0)
    assert spark.table(f"{database}.t").count() == 7
    assert len(versions(spark, database)) == 1 == len(list((tmp_path / database / "t").iterdir()))


def test_versions_below_another_root_go_too(spark, tmp_path):
    for root in ("a", "b"):
        replace_table(spark.range(5), "moved", "t", str(tmp_path / root), keep_seconds=0)
    assert list((tmp_path / "a" / "moved" / "t").iterdir()) == []
    assert spark.table("moved.t").count() == 5


def test_a_failed_write_is_cleared_later(spark, tmp_path):
    replace_table(spark.range(5), "cleared", "t", str(tmp_path))
    failing = spark.range(5).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        replace_table(failing, "cleared", "t", str(tmp_path))
    base = f"{tmp_path}/cleared/t"
    (tmp_path / "cleared" / "t" / "t_v1000_0123abcd").mkdir()  # left by a write of long ago
    assert expire_versions(spark, "cleared", "t", base) == ["t_v1000_0123abcd"]
    assert spark.table("cleared.t").count() == 5


def test_a_plain_table_of_the_name_makes_room(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS plain_before")
    spark.range(3).write.mode("overwrite").saveAsTable("plain_before.t")
    replace_table(spark.range(4), "plain_before", "t", str(tmp_path))
    assert spark.table("plain_before.t").count() == 4


def test_lines_are_not_shuffled_to_be_cut(spark, tmp_path, small_splits, monkeypatch):
    """Only records at the ends of splits are put together line by line."""

    def stops(*_):
        raise AssertionError("all lines were numbered")

    monkeypatch.setattr(csv_records, "numbered_lines", stops)
    path = reviews_file(tmp_path / "a.csv", rows=60)
    cut, apart, failed = write_records(spark, [path], list(REVIEWS.columns))
    assert apart is None and not failed
    splits = read_lines(spark, [path]).rdd.getNumPartitions()
    assert splits > 2 and len(spark.read.text(cut).select("_metadata.file_path").distinct().collect()) >= splits


def test_records_of_mixed_line_ends_are_cut_one_by_one(spark, tmp_path, small_splits):
    path = reviews_file(tmp_path / "a.csv", rows=50)
    with open(path, "a", newline="") as file:
        file.write('r97,o,5,t,"a\r\nb",,\r\nr98,o,5,t,"c\r\nd",,\n')
    assert write_records(spark, [path], list(REVIEWS.columns))[1].endswith("-apart")
    rows = {r.review_id: r.review_comment_message for r in read_source(spark, REVIEWS, path, split_bytes=10).collect()}
    assert len(rows) == 52 and rows["r97"] == "a\nb" and rows["r98"] == "c\r\nd"


def ends_open(line, inside):
    """The reader's rule, part by part."""
    for part in line.split(","):
        single = lambda text: '"' in text.replace('""', "")
        inside = not single(part) if inside else part.startswith('"') and not single(part[1:])
    return inside


def test_quotes_of_a_line_turn_or_end_the_state(spark):
    rng = random.Random(9)
    lines = ["".join(rng.choices(['"', ",", "a", '""', "\x01"], k=rng.randint(0, 12))) for _ in range(800)]
    found = spark.createDataFrame([(line,) for line in lines], "value string")
    for row in found.select("value", csv_records.lines_open(F.col("value")).alias("after")).collect():
        assert (row.after.closed, row.after.open) == (ends_open(row.value, False), ends_open(row.value, True))
