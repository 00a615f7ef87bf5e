"""Profiling and sampling on hand-made rows."""

from pyspark.sql import functions as F

from sentimill.operators import profile, sampling
from sentimill.plans.cuts import stratified_folds


def test_nan_and_null_counts(spark):
    df = spark.createDataFrame([("NaN", 1.0), (None, float("nan")), ("word", None)], "a string, b double")
    nan = {r.column_name: r.rows for r in profile.nan_counts(df).collect()}
    both = {r.column_name: r.rows for r in profile.null_or_nan_counts(df).collect()}
    assert nan == {"a": 1, "b": 1} and both == {"a": 2, "b": 2}


def test_histogram_closes_the_last_bin_and_fills_gaps(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 99, 100)], "Text_len long")
    assert [r.rows for r in profile.length_histogram(df).orderBy("bin").collect()] == [2, 0, 0, 0, 0, 0, 0, 0, 0, 2]


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7,), (7,)], "Text_len long")
    assert [r.rows for r in profile.length_histogram(df).orderBy("bin").collect()] == [2] + [0] * 9


def test_share_rounds_half_up(spark):
    df = spark.range(200).select(F.when(F.col("id") < 1, 5).otherwise(50).alias("Text_len"))
    assert profile.short_text_share(df).first().share == 0.01


def scored(spark, ones, fives):
    return spark.range(ones + fives).select(
        F.col("id").cast("string").alias("Id"), F.when(F.col("id") < ones, 1).otherwise(5).alias("Score")
    )


def test_undersample_is_a_subset_near_the_ratio(spark):
    df = scored(spark, 1000, 9000)
    kept = sampling.undersample(df)
    assert kept.filter("Score != 5").count() == 0
    assert 850 < kept.count() < 1150
    balanced = sampling.balanced_subset(df)
    assert balanced.filter("Score = 1").count() == 1000
    assert balanced.filter("Score = 5").exceptAll(kept).count() == 0


def test_more_one_star_rows_keep_all_five_stars(spark):
    assert sampling.undersample(scored(spark, 30, 10)).count() == 10
    assert sampling.undersample(scored(spark, 30, 10), seed=3).count() == 10


def test_no_five_star_rows(spark):
    assert sampling.balanced_subset(scored(spark, 5, 0)).count() == 5
    assert sampling.balanced_subset(scored(spark, 5, 0), seed=1).count() == 5


def test_split_after_undersampling_is_not_correlated(spark):
    kept = sampling.balanced_subset(scored(spark, 1000, 9000))
    valid = sampling.random_split(kept).filter("split = 'valid'")
    assert 60 < valid.filter("Score = 5").count() < 150


def labelled(spark, zeros, ones):
    return spark.range(zeros + ones).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < zeros, 0).otherwise(1).alias("label")
    )


def test_stratified_split_is_exact(spark):
    df = sampling.stratified_split(labelled(spark, 5001, 99))
    counts = {(r.label, r.is_train): r["count"] for r in df.groupBy("label", "is_train").count().collect()}
    assert counts == {(0, True): 3751, (0, False): 1250, (1, True): 74, (1, False): 25}


def test_stratified_split_of_one_class(spark):
    df = sampling.stratified_split(labelled(spark, 0, 8))
    assert df.filter("is_train").count() == 6


def test_folds_are_even_inside_each_class(spark):
    df = stratified_folds(labelled(spark, 103, 7), "doc_id", "label", 10, "s")
    sizes = {}
    for r in df.groupBy("label", "fold").count().collect():
        sizes.setdefault(r.label, []).append(r["count"])
    assert sorted(sizes[0]) == [10] * 7 + [11] * 3
    assert sizes[1] == [1] * 7 and sum(sizes[0]) == 103
