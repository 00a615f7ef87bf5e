"""Cleaning reviews: lengths, filters, cleaned text, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.functions import text as tx
from sentimill.functions.constants import CONTRACTIONS, STOP_WORDS, VALID_SCORES


def lowercase_text(df: DataFrame, columns: Sequence[str] = ("Summary", "Text")) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in columns})


def token_lengths(df: DataFrame, columns: Sequence[str] = ("Summary", "Text")) -> DataFrame:
    """Add ``<column>_len`` for each text column."""
    return df.withColumns({f"{c}_len": tx.token_count(F.col(c)) for c in columns})


def length_rule(drop_empty_summary: bool = False) -> Column:
    """The length conditions on ``Summary_len`` and ``Text_len``.

    The lengths are bound once as fields of a struct: Spark pushes the filter
    below the projection, and would tokenise a text once per mention otherwise.
    """

    def keep(row: Column) -> Column:
        short, long = row["summary"], row["text"]
        rule = (short <= 20) & (long > 20) & (long * 0.5 > short) & (long <= 250)
        return rule & (short < long) & (short > 0) if drop_empty_summary else rule

    lengths = F.struct(F.col("Summary_len").alias("summary"), F.col("Text_len").alias("text"))
    return F.exists(F.array(lengths), keep)


def filter_reviews(df: DataFrame, drop_empty_summary: bool = False) -> DataFrame:
    return df.filter(length_rule(drop_empty_summary))


def expand_contractions(
    df: DataFrame, column: str, contractions: Mapping[str, str] = CONTRACTIONS
) -> DataFrame:
    return df.withColumn(column, tx.expand_contractions(F.col(column), contractions))


def clean_summary(
    df: DataFrame,
    column: str = "Summary",
    remove_stop_words: bool = True,
    contractions: Mapping[str, str] = CONTRACTIONS,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Add the cleaned words as array ``<column>_tokens`` and as text ``<column>_cleaned``."""
    words = tx.clean_summary_tokens(F.col(column), remove_stop_words, contractions, stop_words)
    return df.withColumn(f"{column}_tokens", words).withColumn(
        f"{column}_cleaned", F.array_join(f"{column}_tokens", " ")
    )


def clean_text_columns(df: DataFrame, extra_chars: str = "") -> DataFrame:
    """Clean both text columns; stop words stay in ``Summary`` and leave ``Text``."""
    return df.withColumns(
        {
            "Summary": tx.clean_review_text(F.col("Summary"), False, extra_chars),
            "Text": tx.clean_review_text(F.col("Text"), True, extra_chars),
        }
    )


def valid_scores(df: DataFrame, column: str = "Score") -> DataFrame:
    """Keep rows scored '1' to '5', with the score as a number."""
    return df.filter(F.col(column).isin(*VALID_SCORES)).withColumn(
        column, F.expr(f"try_cast(`{column}` AS int)")
    )


def binary_label(df: DataFrame) -> DataFrame:
    """``Text, Summary, Score`` with 1 star as 0 and 5 stars as 1; other scores as they are."""
    score = F.when(F.col("Score") == 1, 0).when(F.col("Score") == 5, 1).otherwise(F.col("Score"))
    return df.select("Text", "Summary", score.cast("int").alias("Score"))


def clean_reviews(df: DataFrame, drop_empty_summary: bool = False) -> DataFrame:
    """The whole cleaning job: one narrow stage, the cheap score filter first."""
    scored = valid_scores(df)
    return clean_summary(filter_reviews(token_lengths(lowercase_text(scored)), drop_empty_summary))


def sentiment_label(df: DataFrame) -> DataFrame:
    """Add the shown sentiment word and the probability in percent."""
    return df.withColumns(
        {
            "sentiment": F.when(F.col("predicted_score") == 1, "Positive").otherwise("Negative"),
            "proba_percent": F.round(F.col("predicted_proba") * 100, 1),
        }
    )


def event_time(df: DataFrame, column: str = "time") -> DataFrame:
    """Epoch seconds to timestamp."""
    return df.withColumn(column, F.timestamp_seconds(column))
