"""Text expressions: tokens, lengths, contractions, cleaning.  All stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentimill.functions.constants import (
    CONTRACTIONS,
    MARKUP_CHARS,
    PLAIN_TERM,
    PLAIN_TOKEN,
    STOP_WORDS,
    TOKEN,
    VECTOR_TERM,
    WORD_RUN,
    markup_pattern,
)


def tokens(text: Column) -> Column:
    """Lower-case words and numbers; punctuation never becomes a token."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of tokens; NULL for NULL in every ANSI mode."""
    return F.array_size(tokens(text)).cast("bigint")


def without(words: Column, dropped: Sequence[str]) -> Column:
    """Remove words of a list, keeping order and repeats."""
    if not dropped:
        return words
    return F.filter(words, lambda w: ~w.isin(*dropped))


def expand_contractions(text: Column, contractions: Mapping[str, str] = CONTRACTIONS) -> Column:
    """Replace short forms word by word; words are then separated by single spaces."""
    words = F.regexp_extract_all(text, F.lit(WORD_RUN), F.lit(0))
    if contractions:
        pairs = F.create_map(*[F.lit(x) for pair in contractions.items() for x in pair])
        # The set test is a hash probe; only real short forms walk through the map.
        words = F.transform(
            words,
            lambda w: F.when(w.isin(*contractions), F.try_element_at(pairs, w)).otherwise(w),
        )
    return F.array_join(words, " ")


def clean_summary_tokens(
    text: Column,
    remove_stop_words: bool = True,
    contractions: Mapping[str, str] = CONTRACTIONS,
    stop_words: Sequence[str] = STOP_WORDS,
) -> Column:
    """Lower case, contractions expanded, tokenised, stop words removed."""
    words = tokens(expand_contractions(F.lower(text), contractions))
    return without(words, stop_words if remove_stop_words else ())


def _without_markup(text: Column, extra_chars: str) -> Column:
    """Lower case, markup deleted."""
    pattern = markup_pattern(extra_chars)
    # Looking at the next character first halves the time: few can start a match.
    guarded = f"(?=[<hsc{MARKUP_CHARS}{extra_chars}])(?:{pattern})"
    return F.regexp_replace(F.lower(text), F.lit(guarded), F.lit(""))


def clean_review_tokens(
    text: Column,
    remove_stop_words: bool = True,
    extra_chars: str = "",
    stop_words: Sequence[str] = STOP_WORDS,
) -> Column:
    """Lower case, markup deleted, tokenised, stop words optionally removed."""
    plain = _without_markup(text, extra_chars)
    # The apostrophes are gone, so a token is a plain run of letters and digits.
    words = F.regexp_extract_all(plain, F.lit(PLAIN_TOKEN), F.lit(0))
    return without(words, stop_words if remove_stop_words else ())


def clean_review_text(
    text: Column,
    remove_stop_words: bool = True,
    extra_chars: str = "",
    stop_words: Sequence[str] = STOP_WORDS,
) -> Column:
    """``clean_review_tokens`` joined by single spaces."""
    return F.array_join(clean_review_tokens(text, remove_stop_words, extra_chars, stop_words), " ")


def vector_terms(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Terms a text contributes to the features: runs of two or more word characters."""
    words = F.regexp_extract_all(F.lower(text), F.lit(VECTOR_TERM), F.lit(0))
    return without(words, stop_words)


def review_terms(
    text: Column, extra_chars: str = "", stop_words: Sequence[str] = STOP_WORDS
) -> Column:
    """``vector_terms(clean_review_text(text))`` in one pass over the text.

    Markup removal takes the apostrophes, so a token here is a plain run of
    letters and digits and the second pattern can only drop one-letter words,
    which are not even made here.
    """
    words = F.regexp_extract_all(_without_markup(text, extra_chars), F.lit(PLAIN_TERM), F.lit(0))
    return without(words, stop_words)
