"""Class balancing and splits, repeatable by key hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimill.functions.hashing import unit
from sentimill.plans.cuts import stratified_share


def star_subset(df: DataFrame, stars: int, column: str = "Score") -> DataFrame:
    return df.filter(F.col(column) == stars)


def star_subsets(df: DataFrame, column: str = "Score") -> tuple[DataFrame, DataFrame]:
    """The 1-star rows and the 5-star rows."""
    return star_subset(df, 1, column), star_subset(df, 5, column)


def _keep_ratio(df: DataFrame, column: str):
    """1-star rows per 5-star row, at most 1, as a value computed inside the query."""
    ones, fives = F.count_if(F.col(column) == 1), F.count_if(F.col(column) == 5)
    return df.agg(F.least(F.try_divide(ones, fives), F.lit(1.0))).scalar()


def undersample(
    df: DataFrame, key: str = "Id", column: str = "Score", seed: str | int = "undersample"
) -> DataFrame:
    """5-star rows kept at the 1-star to 5-star ratio.

    A text seed draws by key hash; a number draws with Spark's own sampler.
    """
    fives = star_subset(df, 5, column)
    if isinstance(seed, int):
        counts = df.agg(
            F.count_if(F.col(column) == 1), F.count_if(F.col(column) == 5)
        ).first()
        ratio = min(1.0, counts[0] / counts[1]) if counts[1] else 0.0
        return fives.sample(withReplacement=False, fraction=ratio, seed=seed)
    return fives.filter(unit(key, seed) < _keep_ratio(df, column))


def balanced_subset(
    df: DataFrame, key: str = "Id", column: str = "Score", seed: str | int = "undersample"
) -> DataFrame:
    """All 1-star rows and as many 5-star rows, on average."""
    if isinstance(seed, int):
        return star_subset(df, 1, column).unionByName(undersample(df, key, column, seed))
    # Same rows as the union of both parts, from one scan.
    return df.filter(
        (F.col(column) == 1)
        | ((F.col(column) == 5) & (unit(key, seed) < _keep_ratio(df, column)))
    )


def random_split(
    df: DataFrame, key: str = "Id", share: float = 0.9, seed: str | int = "split"
) -> DataFrame:
    """Add ``split``: 'train' for about ``share`` of the rows, else 'valid'."""
    draw = F.rand(seed) if isinstance(seed, int) else unit(key, seed)
    return df.withColumn("split", F.when(draw < share, "train").otherwise("valid"))


def stratified_split(
    df: DataFrame,
    key: str = "doc_id",
    label: str = "label",
    share: float = 0.75,
    seed: str = "100",
    exact: bool = True,
) -> DataFrame:
    """Add ``is_train``, the same share of every class.

    ``exact`` fixes the class sizes; otherwise each row is drawn on its own,
    which needs no pass over the keys.
    """
    if exact:
        return stratified_share(df, key, label, share, seed)
    return df.withColumn("is_train", unit(key, seed) < share)
