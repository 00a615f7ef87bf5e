"""Readers, writers and report queries on hand-made rows."""

import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sentimill.operators import naive_bayes, reports
from sentimill.plans import staging
from sentimill.sources import reviews, views

RAW = [
    ("1", "p", "5", "0", 'say "hi"', "two\nlines, and a comma"),
    ("2", "p", None, "1", "", "back\\slash"),
    ("3", "p_1", "junk", "2", " padded ", "NaN"),
]


MARKS = [("4", "p", "", None, "\\N", "\\\\E"), ("5", None, "5", "", "\\E", "a\nb")]


def test_csv_round_trip_row_by_row(spark, tmp_path):
    df = spark.createDataFrame(RAW + MARKS, reviews.REVIEW_SCHEMA)
    path = str(tmp_path / "reviews")
    reviews.write_reviews_csv(df, path)
    back = reviews.read_reviews(spark, path, marked=True)
    assert sorted(back.collect(), key=lambda r: r.Id) == sorted(df.collect(), key=lambda r: r.Id)


def test_parquet_folder_needs_no_suffix(spark, tmp_path):
    df = spark.createDataFrame(RAW, reviews.REVIEW_SCHEMA)
    path = str(tmp_path / "folder")
    df.write.parquet(path)
    assert reviews.read_reviews(spark, path, format="parquet").count() == 3
    with pytest.raises(ValueError, match="unknown format"):
        reviews.read_reviews(spark, path, format="orc")


def test_balanced_csv_keeps_line_breaks(spark, tmp_path):
    rows = [("0", "1", "two\nlines, \"quoted\"", "s", "1"), ("1", "2", "plain", "", "5")]
    path = str(tmp_path / "balanced")
    reviews.write_reviews_csv(
        spark.createDataFrame(rows, "`Unnamed: 0` string, Id string, Text string, Summary string, Score string"), path
    )
    back = reviews.read_balanced(spark, path, marked=True)
    assert back.columns == ["Text", "Summary", "Score"]
    assert {tuple(r) for r in back.collect()} == {r[2:] for r in rows}


def test_entries_are_clustered_by_product(spark, tmp_path):
    from conftest import plan_of

    products = ["", None, "p1", "p2", "large"]
    rows = [(i, "t", "s", 5, i, i % 2, 1, 0.5, products[min(i % 10, 4)]) for i in range(2000)]
    reviews.write_entries(spark.createDataFrame(rows, reviews.ENTRY_SCHEMA), str(tmp_path), file_rows=100)
    entries = reviews.read_entries(spark, str(tmp_path))
    assert sorted(map(tuple, entries.select("doc_id", "productid").collect())) == [(r[0], r[-1]) for r in rows]
    assert reviews.read_entries(spark, str(tmp_path), "negative_reviews").count() == 1000
    held = []
    for file in (tmp_path / "entries").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        assert meta.num_rows <= 100
        at = meta.schema.names.index("productid")
        held += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    # 200 rows of p1 lie in a few files of at most 100; the statistics of the others leave it out.
    of_p1 = [s for s in held if s.has_min_max and s.min <= "p1" <= s.max]
    assert len(held) >= 20 and 2 <= len(of_p1) <= 4
    plan = plan_of(reports.product_timeline(entries, "p1"))
    assert "EqualTo(productid,p1)" in plan.split("PushedFilters")[1].split("]")[0]


def test_all_reviews_are_scored(spark, sf_dir):
    from sentimill.sources import views

    assert views.entries_text(spark, sf_dir).count() == views.table(spark, sf_dir, "documents").count()


def test_staged_tables_can_be_removed(spark, tmp_path):
    staged = staging.stage(spark.range(5), "five")
    kept = staging.stage(spark.range(6), "six")
    staging.drop_staged(staged)
    assert kept.count() == 6
    folder = staging.run_folder(spark)
    assert staging.exists(spark, folder)
    staging.remove_staged(spark)
    assert not staging.exists(spark, folder)


def test_export_keeps_pairs_together(spark, tmp_path):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("Id"), F.concat(F.lit("t"), "id").alias("Text"), F.concat(F.lit("s"), "id").alias("Summary")
    )
    path = str(tmp_path / "pairs")
    reviews.export_pairs(df, path)
    pairs = spark.read.parquet(path)
    assert pairs.count() == 500
    assert pairs.filter("substring(Text, 2) != substring(Summary, 2)").count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        reviews.export_pairs(df, path)


def test_sql_errors_are_raised(spark):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        reviews.read_sql_table(spark, "SELECT * FROM no_such_table")


def test_staged_tables_go_to_the_shared_folder(spark):
    staged = staging.stage(spark.range(5), "five")
    folder = staging.shared_folder(spark).removeprefix("file:")
    assert staged.count() == 5
    assert all(folder in f for f in staged.inputFiles())


class _Session:
    """What ``shared_folder`` reads of a session."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_a_cluster_must_name_its_folder():
    assert staging.shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(_Session("yarn"))


def entries(spark, rows):
    columns = "doc_id long, productid string, time long, predicted_sentiment int, predicted_proba double"
    return spark.createDataFrame(rows, columns).select(
        "*",
        F.when(F.col("predicted_sentiment") == 1, 1).otherwise(0).alias("predicted_score"),
        F.lit(1).alias("score"),
        F.lit("x").alias("text"),
        F.lit("y").alias("predicted_summary"),
    )


def test_percent_rounds_half_up(spark):
    df = entries(spark, [(i, "p", i, 1 if i < 23 else -1, 0.5) for i in range(40)])
    row = reports.sentiment_totals(df).first()
    assert (row.sentiment, row.positive_percent, row.reviews) == (6, 58, 40)


def test_like_and_exact_products(spark):
    df = entries(spark, [(1, "a_c", 1, 1, 0.1), (2, "abc", 2, 1, 0.2), (3, "x", 3, -1, None)])
    assert reports.product_timeline(df, "a_c").count() == 2
    assert reports.product_timeline(df, "a_c", exact=True).count() == 1
    assert [r.doc_id for r in reports.top_reviews(df).collect()] == [3, 2, 1]
    assert [r.doc_id for r in reports.top_reviews(df, n=1).collect()] == [3]


def test_quarters_and_years(spark):
    day = lambda *d: int(datetime.datetime(*d, tzinfo=datetime.timezone.utc).timestamp())
    df = entries(spark, [(1, "p", day(2012, 3, 31, 23, 59), 1, 0.1), (2, "p", day(2012, 4, 1), -1, 0.1), (3, "p", day(1969, 12, 31), 1, 0.1)])
    quarters = {(str(r.quarter), r.positive, r.negative, r.axis_limit) for r in reports.period_sentiment(df).collect()}
    assert quarters == {("2012-01-01", 1, 0, 2), ("2012-04-01", 0, 1, 2), ("1969-10-01", 1, 0, 2)}
    assert {r.year for r in reports.period_sentiment(df, "y").collect()} == {1969, 2012}
    with pytest.raises(ValueError):
        reports.period_sentiment(df, "M")


def test_unknown_sort_column(spark):
    totals = reports.sentiment_totals(entries(spark, [(1, "p", 1, 1, 0.1)]))
    with pytest.raises(ValueError):
        reports.sorted_totals(totals, "nope")


def test_texts_are_written_once_to_be_scored(spark, tmp_path, monkeypatch):
    """A model too large for the rows is joined without tokenised or scored texts being staged, and gives the scores of the other way."""
    texts = [(i, f"s{i % 3}", f"headline {'good' if i % 2 else 'awful'}\nterm{i % 5} term{i % 7} {'fine' if i % 2 else 'broken'}") for i in range(60)]
    rows = [*texts, (60, "s0", None), (61, None, "")]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2) for i in range(40)]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    staged = []
    for module in (views, naive_bayes):
        one = module.stage
        monkeypatch.setattr(module, "stage", lambda df, label, one=one: staged.append((label, df.columns)) or one(df, label))
    found = {}
    for limit in ("10m", "64b"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            monkeypatch.setattr(staging, "_KEPT", {})
            staged.clear()
            found[limit] = sorted(views.entries_text(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [label for label, columns in staged if "text" in columns] and "evidence" in {label for label, _ in staged}
    assert len(found["64b"]) == 62 and found["64b"] == found["10m"]
    negative = views.negative_text(spark, str(tmp_path))
    assert negative.count() == sum(r.predicted_score == 0 for r in found["64b"])
