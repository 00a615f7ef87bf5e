"""Skewed keys and long orderings: results equal the plain forms, plans stay spread."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of
from sentimill.operators import cleaning, naive_bayes, reports
from sentimill.plans import running
from sentimill.plans.cuts import stratified_folds, stratified_share
from sentimill.plans.running import running_totals
from sentimill.plans.skew import SLOTS, lookup, parts
from sentimill.plans.staging import stage
from sentimill.sources import views


def skewed(spark):
    """A third of 9,000 rows on one key, the rest on 600 keys."""
    return spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 600).alias("k")
    )


def test_lookup_equals_the_plain_join(spark):
    rows = skewed(spark)
    table = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    ours = lookup(rows, table, ["k"], "n", ["id"], slots=64)
    plain = rows.join(table, "k")
    columns = ["id", "k", "n", "v"]
    assert ours.count() == 9000
    assert ours.select(columns).exceptAll(plain.select(columns)).count() == 0


def test_hot_key_is_split_and_copies_are_bounded(spark):
    table = skewed(spark).groupBy("k").agg(F.count("*").alias("n"))
    sized = table.withColumn("p", parts(table, "n", slots=64)).cache()
    hot = sized.filter("p > 1").collect()
    assert [(r.k, r.p) for r in hot] == [(-1, 22)]
    assert sized.agg(F.sum("p")).first()[0] <= sized.count() + 2 * 64


def test_running_totals_equal_one_window(spark):
    df = skewed(spark).withColumn("v", F.col("id") % 7 - 3)
    ours = running_totals(df, ["id"], {"total": "v"}, ["k"], peek=["v"], slices=16)
    w = Window.partitionBy("k").orderBy("id")
    plain = df.withColumn(
        "total", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("next_v", F.lead("v").over(w))
    columns = ["id", "k", "v", "total", "next_v"]
    assert ours.select(columns).exceptAll(plain.select(columns)).count() == 0
    assert ours.count() == 9000


def events(spark):
    """A third of the events in one second."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(86_400 * 5)).otherwise(F.col("id") * 997 % 900_000).alias("time"),
        (F.col("id") % 211).cast("string").alias("productid"),
        F.when(F.col("id") % 5 < 2, -1).otherwise(1).alias("predicted_sentiment"),
    )


def test_rolling_sentiment_equals_the_plain_window(spark):
    ours, plain = reports.rolling_sentiment(events(spark)), reports.rolling_sentiment_plain(events(spark))
    assert ours.count() == plain.count()
    assert ours.exceptAll(plain).count() == 0


def test_only_day_totals_pass_through_one_window(spark, sf_dir, monkeypatch):
    staged = []
    write = reports.stage
    monkeypatch.setattr(reports, "stage", lambda df, label: staged.append(plan_of(df)) or write(df, label))
    plans = [plan_of(reports.rolling_sentiment(views.entries_num(spark, sf_dir))), *staged]
    assert sum("lineitem" in plan for plan in plans) == 1
    for plan in (p for p in plans if "Window [" in p):
        windows = [line.split("Window ", 1)[1] for line in plan.splitlines() if "Window [" in line]
        # Expressions, partitioning, ordering; the middle part is absent without partitioning.
        whole = [w for w in windows if w.count("], [") == 1]
        assert len(windows) > len(whole) > 0
        assert all("_of_day" in w for w in whole)
        assert "Python" not in plan


def test_per_product_top_is_cut_before_the_shuffle(spark):
    df = events(spark).select(
        F.monotonically_increasing_id().alias("doc_id"), "productid",
        *[F.lit("x").alias(c) for c in ("text", "predicted_summary")],
        *[F.lit(1).alias(c) for c in ("predicted_score", "score")], F.lit(0.5).alias("predicted_proba"),
    )
    assert plan_of(reports.top_reviews_per_product(df)).count("WindowGroupLimit") == 2


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(reports.sentiment_totals(views.entries_num(spark, sf_dir)))
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == {"l_partkey", "l_returnflag"}


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(cleaning.valid_scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("source").alias("Score"), "text")))
    assert "PushedFilters: [In(source, [1,2,3,4,5])]" in plan


def test_hot_broadcast_is_bounded(spark):
    """However the rows fall, fewer than ``slots`` keys are split."""
    rows = spark.range(20_000).select((F.col("id") % 5000).alias("k"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert table.withColumn("p", parts(table, "n", slots=100)).filter("p > 1").count() == 0
    assert SLOTS <= 10_000


def test_any_number_of_classes_is_split_exactly(spark):
    df = spark.range(4500).select("id", (F.col("id") % 1500).alias("label"))
    placed = stratified_folds(df, "id", "label", 3, "s").groupBy("label", "fold").count()
    assert placed.count() == 4500 and placed.filter("count != 1").count() == 0
    assert stratified_share(df, "id", "label", 0.5, "s").filter("is_train").count() == 2250


def test_split_of_a_table_without_labels(spark):
    df = spark.range(5).select("id", F.lit(None).cast("int").alias("label"))
    assert stratified_share(df, "id", "label", 0.75, "s").count() == 0
    assert stratified_folds(df, "id", "label", 3, "s").count() == 0


def test_slices_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(running, "ROWS_PER_SLICE", 100)
    seen = []
    monkeypatch.setattr(running, "stage", lambda df, label: seen.append(df.rdd.getNumPartitions()) or stage(df, label))
    running_totals(spark.range(1000).withColumn("v", F.lit(1)), ["id"], {"total": "v"}).count()
    assert seen == [10]


def test_term_hot_only_in_the_scored_rows(spark):
    """The weight of a term is that of the rows joined, so a term rare in training may be split."""
    train = spark.createDataFrame([(i, i % 2, ["rare"] if i == 0 else [f"t{i}"]) for i in range(40)], "doc_id int, label int, terms array<string>")
    model = naive_bayes.bernoulli_nb_fit(train)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.array(F.lit("rare")).alias("terms"))
    scored = naive_bayes.nb_predict(model, docs)
    assert scored.count() == 3000 and scored.select("score0").distinct().count() == 1
