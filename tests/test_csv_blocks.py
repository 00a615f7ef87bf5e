"""CSV read in blocks gives the rows of the reader that takes a file whole."""

import csv
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sentimill.sources import csv_blocks, reviews

COLUMNS = reviews.REVIEW_SCHEMA.names


@pytest.fixture
def small_blocks(spark):
    """Blocks of some hundred bytes, so that records, and lines, lie across several."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    usual = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "300b")
    spark.conf.set(names[1], "1b")
    yield
    for name, value in zip(names, usual):
        spark.conf.set(name, value)


def write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL, header=COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end, quoting=quoting)
        out.writerow(header)
        out.writerows(rows)


def value(draw):
    words = ["a", "é", ",", "\n", '"', "\n\n", " ", "", '""', "x" * 90, "日本", "\\", "word " * 20, "\n\"\n"]
    return "".join(draw.choice(words) for _ in range(draw.randrange(6)))


def both(spark, path, **how):
    blocked = reviews.read_reviews(spark, str(path), split=True, **how)
    whole = reviews.read_reviews(spark, str(path), split=False, **how)
    assert blocked.schema == whole.schema
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    return order(blocked), order(whole)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_blocks_equal_whole_files(spark, tmp_path, small_blocks, seed, quoting):
    draw = random.Random(seed)
    for file in range(2):
        rows = [(f"{file}-{i}", *(value(draw) for _ in COLUMNS[1:])) for i in range(60)]
        write(tmp_path / f"{file}.csv", rows, quoting=quoting)
    blocked, whole = both(spark, tmp_path)
    assert len(whole) == 120 and blocked == whole


def test_many_tasks_read_one_file(spark, tmp_path, small_blocks):
    write(tmp_path / "one.csv", [(str(i), "p", "5", "0", "s", f"first {i}\nsecond") for i in range(200)])
    df = reviews.read_reviews(spark, str(tmp_path / "one.csv"), split=True)
    assert df.select(F.spark_partition_id().alias("task")).distinct().count() > 10
    # The blocks' states are broadcast; the lines themselves are not shuffled.
    above_scan = plan_of(csv_blocks.records(spark, str(tmp_path / "one.csv"))).split("MapInArrow", 1)[1]
    assert "SortMergeJoin" not in above_scan.split("Scan text")[0] and "BroadcastHashJoin" in above_scan


def test_record_over_many_blocks_and_open_end(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}" for i in range(400))
    write(tmp_path / "long.csv", [("1", "p", "5", "0", "s", "t"), ("2", "p", "5", "0", long, "t"), ("3", "", "5", "0", "s", "t")])
    blocked, whole = both(spark, tmp_path / "long.csv")
    assert blocked == whole and long in {r[4] for r in blocked}
    (tmp_path / "open.csv").write_text(",".join(COLUMNS) + '\n1,p,5,0,s,"never\nclosed\n' + "more\n" * 200)
    blocked = reviews.read_reviews(spark, str(tmp_path / "open.csv"), split=True).collect()
    assert len(blocked) == 1 and blocked[0].Text.startswith("never\nclosed\nmore")


def test_carriage_returns_blank_lines_short_rows_and_empty_files(spark, tmp_path, small_blocks):
    rows = [(str(i), "p", "5", "0", "s", f"a\r\nb {i}") for i in range(40)]
    write(tmp_path / "crlf.csv", rows, end="\r\n")
    blocked, whole = both(spark, tmp_path / "crlf.csv")
    assert blocked == whole and len(blocked) == 40
    (tmp_path / "odd.csv").write_text("\n\n" + ",".join(COLUMNS) + '\n\n1,p\n2,p,5,0,"",t,more,columns\n  \n"3\n"')
    blocked, whole = both(spark, tmp_path / "odd.csv")
    assert blocked == whole and len(blocked) == 4
    (tmp_path / "empty.csv").write_text("")
    assert reviews.read_reviews(spark, str(tmp_path / "empty.csv"), split=True).count() == 0
    write(tmp_path / "header.csv", [])
    assert reviews.read_reviews(spark, str(tmp_path / "header.csv"), split=True).count() == 0


def test_marked_and_unnamed_columns(spark, tmp_path, small_blocks):
    rows = [(str(i), str(i), "two\nlines, \"quoted\"" if i % 2 else None, "", "5") for i in range(30)]
    df = spark.createDataFrame(rows, "`Unnamed: 0` string, Id string, Text string, Summary string, Score string")
    reviews.write_reviews_csv(df, str(tmp_path / "balanced"))
    back = reviews.read_balanced(spark, str(tmp_path / "balanced"), marked=True, split=True)
    assert back.columns == ["Text", "Summary", "Score"]
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr(r[2:]) for r in rows)


def test_files_beyond_a_block_are_split_by_default(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", [("1", "p", "5", "0", "s", "t\nu")])
    calls = []
    monkeypatch.setattr(csv_blocks, "read_csv", lambda *a: calls.append(a) or spark.createDataFrame([], a[2]))
    assert reviews.read_reviews(spark, str(tmp_path / "a.csv")).count() == 1 and not calls
    monkeypatch.setattr(reviews, "SPLIT_BYTES", 10)
    reviews.read_reviews(spark, str(tmp_path / "a.csv"))
    assert len(calls) == 1


def test_too_many_blocks_are_refused(spark, tmp_path, small_blocks, monkeypatch):
    write(tmp_path / "a.csv", [(str(i), "p", "5", "0", "s", "t" * 50) for i in range(50)])
    monkeypatch.setattr(csv_blocks, "MAX_BLOCKS", 3)
    with pytest.raises(ValueError, match="too many blocks"):
        reviews.read_reviews(spark, str(tmp_path / "a.csv"), split=True)
