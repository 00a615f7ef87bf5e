"""Report queries over scored reviews (``entries``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimill.plans.running import running_totals
from sentimill.plans.skew import lookup
from sentimill.plans.staging import stage

REVIEW_COLUMNS = (
    "text", "predicted_summary", "predicted_score", "score", "predicted_proba", "productid",
)
_DAY = 86_400


def _best_first(key: str) -> list[Column]:
    """NULL probabilities first, as in the store the reports come from; the key breaks ties."""
    return [F.col("predicted_proba").desc_nulls_first(), F.col(key)]


def top_reviews(entries: DataFrame, n: int = 30, key: str = "doc_id") -> DataFrame:
    return entries.orderBy(*_best_first(key)).limit(n).select(key, *REVIEW_COLUMNS)


def distinct_products(entries: DataFrame) -> DataFrame:
    return entries.select("productid").distinct()


def of_product(entries: DataFrame, product: str, exact: bool = False) -> DataFrame:
    """Rows of one product; a LIKE pattern unless ``exact``."""
    column = F.col("productid")
    return entries.filter(column == product if exact else column.like(product))


def product_top_reviews(
    entries: DataFrame, product: str, n: int = 30, exact: bool = False, key: str = "doc_id"
) -> DataFrame:
    return top_reviews(of_product(entries, product, exact), n, key)


def top_reviews_per_product(entries: DataFrame, n: int = 30, key: str = "doc_id") -> DataFrame:
    """The top reviews of every product; each task keeps n per product before the shuffle."""
    place = F.row_number().over(Window.partitionBy("productid").orderBy(*_best_first(key)))
    return (
        entries.withColumn("place", place)
        .filter(F.col("place") <= n)
        .select(key, "place", *REVIEW_COLUMNS)
    )


def product_negative_text(
    negative: DataFrame, product: str, exact: bool = False, key: str = "doc_id"
) -> DataFrame:
    return of_product(negative, product, exact).select(key, "text")


def product_timeline(
    entries: DataFrame, product: str, exact: bool = False, key: str = "doc_id"
) -> DataFrame:
    """``time, predicted_sentiment`` of one product by time."""
    return (
        of_product(entries, product, exact)
        .orderBy("time", key)
        .select(key, "time", "predicted_sentiment")
    )


def sentiment_totals(entries: DataFrame) -> DataFrame:
    """Per product: summed sentiment, percent positive (rounded half up), number of reviews."""
    positive, n = F.sum("predicted_score"), F.count("predicted_sentiment")
    totals = entries.groupBy("productid").agg(
        F.sum("predicted_sentiment").alias("sentiment"),
        positive.cast("bigint").alias("_positive"),
        n.alias("reviews"),
    )
    # Whole numbers only: a percentage ending in .5 must not depend on floating point.
    percent = F.when(
        F.col("reviews") > 0, F.expr("(200 * _positive + reviews) div (2 * reviews)")
    )
    return totals.select(
        "productid", "sentiment", percent.alias("positive_percent"), "reviews"
    ).orderBy("sentiment", "productid")


def sorted_totals(totals: DataFrame, by: str = "sentiment", ascending: bool = True) -> DataFrame:
    """The totals in the order of one column, values as whole numbers."""
    if by not in totals.columns:
        raise ValueError(f"unknown column: {by}")
    whole = totals.select(
        "productid",
        *[F.col(c).cast("int").alias(c) for c in ("sentiment", "positive_percent", "reviews")],
    )
    return whole.orderBy(F.col(by).asc() if ascending else F.col(by).desc(), "productid")


def _distinct_events(entries: DataFrame) -> DataFrame:
    return entries.select("time", "productid", "predicted_sentiment").distinct()


def rolling_sentiment(entries: DataFrame) -> DataFrame:
    """Running sentiment over time of the distinct (time, sentiment, product) events.

    Events are summed per second first, and seconds per day: a day has at most
    86,400 rows, and only the day totals pass through one window.  The result
    per second then goes back to the events; a second that holds many of them
    is split.
    """
    # Written down: the sums and the lookup both read it.
    events = stage(_distinct_events(entries), "events")
    per_time = events.groupBy("time").agg(
        F.sum("predicted_sentiment").alias("_sum"), F.count("*").alias("_events")
    ).withColumn("_day", F.floor(F.col("time") / _DAY))
    days = per_time.groupBy("_day").agg(F.sum("_sum").alias("_of_day"))
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = days.select("_day", F.coalesce(F.sum("_of_day").over(earlier), F.lit(0)).alias("_before"))
    in_day = F.sum("_sum").over(Window.partitionBy("_day").orderBy("time"))
    running = (
        per_time.withColumn("_in_day", in_day)
        .join(offsets, "_day")
        .select("time", "_events", (F.col("_in_day") + F.col("_before")).alias("running_sentiment"))
    )
    # One row per second; written down because the lookup reads it more than once.
    running = stage(running, "running")
    return lookup(events, running, ["time"], "_events", ["productid", "predicted_sentiment"]).select(
        "time", "productid", "predicted_sentiment", "running_sentiment"
    )


def rolling_sentiment_plain(entries: DataFrame) -> DataFrame:
    """The same as one window over all events; for small tables and as a check."""
    over_time = Window.orderBy("time")
    return _distinct_events(entries).withColumn(
        "running_sentiment", F.sum("predicted_sentiment").over(over_time)
    ).select("time", "productid", "predicted_sentiment", "running_sentiment")


def _day_of(time: str) -> Column:
    """Calendar day (UTC) of epoch seconds, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.col(time) / _DAY).cast("int"))


def _sentiment_counts(entries: DataFrame, bucket: Column, name: str) -> DataFrame:
    counts = entries.groupBy(bucket.alias(name)).agg(
        F.count_if(F.col("predicted_sentiment") == 1).alias("positive"),
        F.count_if(F.col("predicted_sentiment") == -1).alias("negative"),
    )
    # Calendar periods are few, so the axis limit is one small aggregate.
    limit = counts.agg(F.max(F.greatest("positive", "negative")) + 1).scalar()
    return counts.withColumn("axis_limit", limit)


def quarterly_sentiment(entries: DataFrame) -> DataFrame:
    """Positive and negative reviews per calendar quarter that has any."""
    return _sentiment_counts(entries, F.trunc(_day_of("time"), "quarter"), "quarter")


def yearly_sentiment(entries: DataFrame) -> DataFrame:
    return _sentiment_counts(entries, F.year(_day_of("time")), "year")


def period_sentiment(entries: DataFrame, period: str = "Q") -> DataFrame:
    """Counts per quarter ('Q') or year ('y')."""
    if period == "Q":
        return quarterly_sentiment(entries)
    if period == "y":
        return yearly_sentiment(entries)
    raise ValueError(f"unknown period: {period}")


def product_period_sentiment(entries: DataFrame, period: str = "Q") -> DataFrame:
    """Counts per product and quarter ('Q') or year ('y'), for all products; the axis limit is the product's."""
    if period not in ("Q", "y"):
        raise ValueError(f"unknown period: {period}")
    name = "quarter" if period == "Q" else "year"
    bucket = F.trunc(_day_of("time"), "quarter") if period == "Q" else F.year(_day_of("time"))
    counts = entries.groupBy("productid", bucket.alias(name)).agg(
        F.count_if(F.col("predicted_sentiment") == 1).alias("positive"),
        F.count_if(F.col("predicted_sentiment") == -1).alias("negative"),
    )
    of_product = Window.partitionBy("productid")
    return counts.withColumn("axis_limit", F.max(F.greatest("positive", "negative")).over(of_product) + 1)


def cumulative_sentiment(
    entries: DataFrame, tie_break: Sequence[str] = ("doc_id",), slices: int | None = None
) -> DataFrame:
    """Row-by-row running sentiment of every product in time order."""
    rows = entries.select("productid", "time", *tie_break, "predicted_sentiment")
    return running_totals(
        rows, ["time", *tie_break], {"cumulative": "predicted_sentiment"}, ["productid"], slices=slices
    )


def recent_dates(entries: DataFrame, n: int = 50, key: str = "doc_id") -> DataFrame:
    """Dates of the last ``n`` rows, oldest first."""
    last = entries.select(key, "time").orderBy(F.desc("time"), F.desc(key)).limit(n)
    return last.orderBy("time", key).select(key, _day_of("time").alias("date"))
