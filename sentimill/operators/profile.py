"""Profiling: counts, missing values, lengths, histograms.  One pass per operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.functions import text as tx
from sentimill.plans.staging import stage


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def _is_nan(column: str) -> Column:
    """NaN test on any column; text that is no number is not NaN."""
    return F.coalesce(F.isnan(F.expr(f"try_cast(`{column}` AS double)")), F.lit(False))


def _counts_per_column(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    counted = df.agg(*[F.count_if(cond).alias(c) for c, cond in conditions.items()])
    return counted.unpivot([], list(conditions), "column_name", "rows")


def nan_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, rows whose value is NaN."""
    return _counts_per_column(df, {c: _is_nan(c) for c in columns or df.columns})


def null_or_nan_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, rows whose value is NaN or NULL (NULL rows are counted)."""
    return _counts_per_column(
        df, {c: F.col(c).isNull() | _is_nan(c) for c in columns or df.columns}
    )


def describe_lengths(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def distinct_scores(df: DataFrame, column: str = "Score") -> DataFrame:
    return df.select(column).distinct()


def length_funnel(df: DataFrame) -> DataFrame:
    """Rows each cleaning rule meets, each counted after the rules before it.

    The running conjunctions are counted together, so the whole funnel is one job.
    """
    lengths = F.struct(
        tx.token_count(F.col("Summary")).alias("s"), tx.token_count(F.col("Text")).alias("t")
    )
    # A generator keeps the tokenising in one place below all the conditions.
    base = df.select("Score", F.inline(F.array(lengths)))
    s, t = F.col("s"), F.col("t")
    shorter = s < t
    fitting = shorter & (s <= 20)
    worded = fitting & (s > 0)
    long_enough = worded & (t > 20)
    halved = long_enough & (t * 0.5 > s)
    kept = halved & (t <= 250)
    return base.agg(
        F.count_if(s >= t).alias("summary_not_shorter"),
        F.count_if(shorter & (s > 20)).alias("summary_too_long"),
        F.count_if(fitting & (s == 0)).alias("summary_empty"),
        F.count_if(fitting & (s <= 1)).alias("summary_one_word_or_less"),
        F.count_if(worded & (t <= 20)).alias("text_too_short"),
        F.count_if(long_enough & (t * 0.5 <= s)).alias("summary_over_half"),
        F.count_if(kept & F.col("Score").isin("1", "2", "3", "4", "5")).alias("valid_scores"),
    )


def short_text_share(df: DataFrame, column: str = "Text_len", limit: int = 20) -> DataFrame:
    """Rows up to ``limit`` tokens as a share of all rows; a fraction, rounded half up."""
    short, total = F.count_if(F.col(column) <= limit), F.count("*")
    hundredths = F.floor((200 * short + total) / (2 * total))
    return df.agg(
        short.alias("short_rows"), total.alias("rows"), (hundredths / 100).alias("share")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``v, n``: how often each value of a column occurs."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))


def length_histogram(df: DataFrame, column: str = "Text_len", bins: int = 10) -> DataFrame:
    """``bins`` equal-width bins between the smallest and the largest value, the last one closed."""
    # One row per distinct value, written down: limits and bins read it again.
    return histogram_of_counts(stage(value_counts(df, column), "value-counts"), bins)


def histogram_of_counts(counts: DataFrame, bins: int = 10) -> DataFrame:
    """The histogram of a written table of ``value_counts``."""
    limits = counts.agg(F.min("v").cast("double"), F.max("v").cast("double")).first()
    low, high = limits[0] or 0.0, limits[1] or 0.0
    if low == high:
        place = F.lit(0)
    else:
        place = F.least(F.floor((F.col("v") - low) * bins / (high - low)), F.lit(bins - 1))
    filled = counts.groupBy(place.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    frame = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * (high - low) / bins).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * (high - low) / bins).alias("high"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )


def score_histogram(df: DataFrame, column: str = "Score") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def class_counts(df: DataFrame, column: str = "Score") -> DataFrame:
    """1-star and 5-star rows in one pass."""
    score = F.col(column).cast("string")
    return df.agg(
        F.count_if(score == "1").alias("one_star"), F.count_if(score == "5").alias("five_star")
    )


def sample_short_summaries(df: DataFrame, length: int, n: int, key: str = "Id") -> DataFrame:
    """The first ``n`` summaries of exactly ``length`` tokens, in key order."""
    return (
        df.filter(F.col("Summary_len") == length).select(key, "Summary").orderBy(key).limit(n)
    )
