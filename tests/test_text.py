"""Text expressions and cleaning on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sentimill.functions import text as tx
from sentimill.functions.constants import EXTRA_CHARS, STOP_WORDS
from sentimill.operators import cleaning
from sentimill.sources import views


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_token_count_of_null_empty_and_punctuation(spark):
    assert values(spark, [None, "", "!!! ...", "It's 2 cats"], tx.token_count) == [None, 0, 0, 3]


def test_contractions_rejoin_with_single_spaces(spark):
    assert values(spark, ["i don't\n know  it's"], tx.expand_contractions) == ["i do not know it is"]
    own = values(spark, ["brb now"], lambda c: tx.expand_contractions(c, {"brb": "be right back"}))
    assert own == ["be right back now"]


def test_summary_keeps_repeats_and_drops_stop_words(spark):
    # A short form is looked up as it stands between spaces, so the one before "!" stays.
    texts = ["The good, GOOD can't do", "can't!"]
    assert values(spark, texts, tx.clean_summary_tokens) == [["good", "good", "cannot"], ["can't"]]


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("a <b class='x'>Bold</b> deal", "bold deal"),
        ("see http://x.io/a?b=1 now", "see"),
        ("classic hrefs", "ic"),
        ("It's o.k. + fine", "ok fine"),
        ("x < y > z", "x z"),
    ],
)
def test_markup_is_removed_as_the_pattern_says(spark, text, cleaned):
    assert values(spark, [text], tx.clean_review_text) == [cleaned]


def test_extra_characters(spark):
    expression = lambda c: tx.clean_review_text(c, False, EXTRA_CHARS)
    assert values(spark, ["it’s well-made"], expression) == ["its wellmade"]


def test_review_terms_equal_the_two_step_form(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    one = tx.review_terms(F.col("text"))
    two = tx.vector_terms(tx.clean_review_text(F.col("text")))
    assert docs.filter(one != two).count() == 0


def test_no_stop_word_survives(spark, sf_dir):
    words = views.table(spark, sf_dir, "documents").select(
        F.explode(tx.clean_review_tokens(F.col("text"))).alias("w")
    )
    assert words.filter(F.col("w").isin(*STOP_WORDS) | ~F.col("w").rlike(r"^[\p{L}\p{N}]+$")).count() == 0


def rows(spark, lengths):
    return spark.createDataFrame(lengths, "Summary_len long, Text_len long")


def test_length_limits(spark):
    cases = [(20, 41), (20, 40), (21, 100), (1, 20), (1, 21), (5, 250), (5, 251), (0, 30), (None, 30), (3, None)]
    kept = {tuple(r) for r in cleaning.filter_reviews(rows(spark, cases)).collect()}
    assert kept == {(20, 41), (1, 21), (5, 250), (0, 30)}
    strict = {tuple(r) for r in cleaning.filter_reviews(rows(spark, cases), True).collect()}
    assert strict == {(20, 41), (1, 21), (5, 250)}


def test_scores_and_labels(spark):
    df = spark.createDataFrame(
        [("a", "s", "1"), ("b", "s", "5"), ("c", "s", "3"), ("d", "s", "junk"), ("e", "s", None)],
        "Text string, Summary string, Score string",
    )
    valid = cleaning.valid_scores(df)
    assert sorted(r.Score for r in valid.collect()) == [1, 3, 5]
    assert {r.Text: r.Score for r in cleaning.binary_label(valid).collect()} == {"a": 0, "b": 1, "c": 3}


def test_cleaning_is_one_stage_without_python(spark, sf_dir):
    raw = spark.createDataFrame([], "Id string, Score string, Summary string, Text string")
    plan = plan_of(cleaning.clean_reviews(raw))
    assert "Exchange" not in plan and "Python" not in plan.replace("PythonSQL", "")


def test_one_letter_words_are_never_made(spark):
    """F32: every word was made and measured, to drop those of one letter (a letter may take two of Java's characters)."""
    texts = [None, "", "a b cd é ée 7 77", "x.y z'z <i>q</i>r", "\U00010400 \U00010400\U00010400 a\u0301b", "the i an 1st"]
    long = lambda words: F.filter(words, lambda w: F.char_length(w) > 1)
    found = values(spark, texts, tx.review_terms)
    assert found == values(spark, texts, lambda t: long(tx.clean_review_tokens(t)))
    assert found[2] == ["cd", "ée", "77"] and found[4] == ["\U00010428\U00010428"]
    assert "char_length" not in plan_of(spark.createDataFrame([("a",)], "t string").select(tx.review_terms(F.col("t"))))
