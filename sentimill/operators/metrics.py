"""Evaluation of predictions: accuracy, ROC, confusion counts and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.plans.running import running_totals


def accuracy(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    right = F.count_if(F.col(predicted) == F.col(label))
    return df.agg(F.count("*").alias("rows"), (right / F.count("*")).alias("accuracy"))


def _score_points(
    df: DataFrame, label: str, score: str, within: Sequence[str] = (), peek: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score, with running class counts from the highest score down.

    Equal scores are merged first, so the ordering has no ties to break.
    """
    merged = df.groupBy(*within, (-F.col(score)).alias("_down")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(merged, ["_down"], {"tps": "pos", "fps": "neg"}, within, peek)


def auc_by_group(df: DataFrame, label: str, score: str, within: Sequence[str]) -> DataFrame:
    """Area under the ROC curve per group; tied pairs count half, NULL without both classes."""
    points = _score_points(df, label, score, within)
    higher = (F.col("tps") - F.col("pos")).cast("double") + F.col("pos") / 2
    won = F.sum(F.col("neg") * higher)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return points.groupBy(*within).agg(F.try_divide(won, pairs).alias("auc"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "proba") -> DataFrame:
    return auc_by_group(df, label, score, [])


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "proba", drop_intermediate: bool = True
) -> DataFrame:
    """``threshold, fpr, tpr`` from the highest threshold down, starting at (0, 0).

    With ``drop_intermediate`` a point is left out when the next step has the
    same class counts as its own: it lies on the line between its neighbours.
    """
    points = _score_points(df, label, score, peek=["pos", "neg"])
    sizes = df.agg(
        F.count_if(F.col(label) == 1).alias("p"),
        F.count_if(F.col(label) == 0).alias("n"),
        F.max(score).alias("top"),
    )
    p, n, top = (sizes.select(c).scalar() for c in ("p", "n", "top"))
    if drop_intermediate:
        first = (F.col("tps") == F.col("pos")) & (F.col("fps") == F.col("neg"))
        last = F.col("next_pos").isNull()
        bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        points = points.filter(first | last | bend)
    curve = points.select(
        (-F.col("_down")).alias("threshold"),
        F.try_divide("fps", n).alias("fpr"),
        F.try_divide("tps", p).alias("tpr"),
    )
    origin = sizes.select((F.col("top") + 1).alias("threshold"), F.lit(0.0), F.lit(0.0))
    return curve.union(origin)


def _cells(df: DataFrame, label: str, predicted: str) -> dict[tuple[int, int], Column]:
    """Counting columns ``(predicted, true)`` of the 2x2 table."""
    return {
        (i, j): F.count_if((F.col(predicted) == i) & (F.col(label) == j))
        for i in (0, 1)
        for j in (0, 1)
    }


def confusion_matrix(
    df: DataFrame, label: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """Counts with a row per predicted class and a column per true class; absent cells are 0."""
    counts = df.agg(*[c.alias(f"m{i}{j}") for (i, j), c in _cells(df, label, predicted).items()])
    return counts.select(F.expr("stack(2, 0, m00, m01, 1, m10, m11) AS (predicted, true_0, true_1)"))


def confusion_normalised(
    df: DataFrame, label: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """Each row of the confusion matrix divided by its sum."""
    matrix = confusion_matrix(df, label, predicted)
    row = F.col("true_0") + F.col("true_1")
    return matrix.select(
        "predicted",
        F.try_divide("true_0", row).alias("true_0"),
        F.try_divide("true_1", row).alias("true_1"),
    )


def confusion_rates(
    df: DataFrame, label: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """Rates of the 2x2 table under their usual names.

    ``miss_rate_pos`` is the share of true 1 predicted as 0 and ``precision_neg``
    the share of predicted 0 that is right.
    """
    m = _cells(df, label, predicted)
    return df.agg(
        F.try_divide(m[0, 1], m[0, 1] + m[1, 1]).alias("miss_rate_pos"),
        F.try_divide(m[0, 0], m[0, 0] + m[0, 1]).alias("precision_neg"),
        F.try_divide(m[1, 1], m[0, 1] + m[1, 1]).alias("tpr"),
        F.try_divide(m[1, 0], m[0, 0] + m[1, 0]).alias("fpr"),
    )
