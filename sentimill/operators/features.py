"""Term counts, vocabulary and TF-IDF as long tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimill.plans.running import running_totals
from sentimill.plans.skew import lookup


def _starts(ordered: Column) -> Column:
    """Where the runs of equal words in a sorted array begin."""
    first = F.transform(ordered, lambda w, i: F.when(~w.eqNullSafe(F.get(ordered, i - 1)), i))
    return F.filter(first, lambda i: i.isNotNull())


def _runs(ordered: Column, starts: Column) -> Column:
    """The words of a sorted array with the lengths of their runs: (term, tf)."""
    return F.transform(
        starts,
        lambda start, j: F.struct(
            F.get(ordered, start).alias("term"),
            (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - start).cast("bigint").alias("tf"),
        ),
    )


def term_counts(docs: DataFrame, key: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """``key, term, tf`` from an array column ``terms``.

    A text's terms are in its own row, so counting sorts the array and measures
    the runs of equal words there; nothing is shuffled.
    """
    columns = [key, *keep]
    ordered = docs.select(*columns, F.sort_array("terms").alias("_sorted"))
    return ordered.select(*columns, "_sorted", _starts(F.col("_sorted")).alias("_starts")).select(
        *columns, F.inline(_runs(F.col("_sorted"), F.col("_starts")))
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, even where a filter is pushed below it."""
    return F.get(F.transform(F.array(value), use), 0)


def counted_terms(terms: Column) -> Column:
    """The array of (term, tf) of an array of terms."""
    return once(F.sort_array(terms), lambda ordered: once(_starts(ordered), lambda starts: _runs(ordered, starts)))


def known_terms(counts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Counts of a model's terms; a term is hot by the rows that are joined, whatever it was in training."""
    rows = counts.groupBy("term").agg(F.count("*").alias("_rows"))
    return lookup(counts, terms.join(rows, "term"), ["term"], "_rows", [key]).drop("_rows")


def dictionary(counted: DataFrame) -> DataFrame:
    """Add ``id``: the terms (one row each) numbered from 0 in their order, without a global sort."""
    ordered = running_totals(counted.withColumn("_one", F.lit(1)), ["term"], {"_until": "_one"})
    return ordered.withColumn("id", (F.col("_until") - 1).cast("int")).drop("_one", "_until")


def document_total(docs: DataFrame) -> Column:
    """Number of documents, as a value computed inside the query."""
    return docs.agg(F.count("*")).scalar()


def within_df(df_column: Column, n_docs: Column, min_df: int | float, max_df: int | float) -> Column:
    """Document-frequency test; whole numbers are counts, fractions are shares."""
    low = F.lit(min_df) if isinstance(min_df, int) else F.lit(min_df) * n_docs
    high = F.lit(max_df) if isinstance(max_df, int) else F.lit(max_df) * n_docs
    return (df_column >= low) & (df_column <= high)


def vocabulary(
    postings: DataFrame, n_docs: Column, min_df: int | float = 1, max_df: int | float = 1.0
) -> DataFrame:
    """``term, df`` of the terms kept."""
    counted = postings.groupBy("term").agg(F.count("*").alias("df"))
    return counted.filter(within_df(F.col("df"), n_docs, min_df, max_df))


def idf(df_column: Column, n_docs: Column) -> Column:
    """Smoothed inverse document frequency."""
    return F.log((n_docs + 1) / (df_column + 1)) + 1


def tfidf(
    postings: DataFrame, vocab: DataFrame, n_docs: Column, key: str = "doc_id"
) -> DataFrame:
    """``key, term, tf, weight`` (and other columns of ``postings``), unit length per document."""
    found = lookup(postings, vocab.select("term", "df"), ["term"], "df", [key])
    raw = found.withColumn("weight", F.col("tf") * idf(F.col("df"), n_docs)).drop("df")
    return unit_length(raw, [key])


def unit_length(weighted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Divide ``weight`` by the length of the document's vector; groups are single texts."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*keys)))
    return weighted.withColumn("weight", F.col("weight") / norm)
