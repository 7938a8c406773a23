"""Classifier evaluation as aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import flag, has_value, ratio
from tidemark.operators.keyed_joins import running_sums


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """``(label, prediction, count)``, with zero cells for the named classes."""
    seen = df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.createDataFrame(
        [(a, b, 0) for a in classes for b in classes], "label int, prediction int, count bigint"
    )
    return seen.unionByName(grid).groupBy("label", "prediction").agg(
        F.sum("count").alias("count")
    )


def classification_scores(
    df: DataFrame, label: str, prediction: str, positive: int = 1
) -> DataFrame:
    """One row: rows, accuracy, support-weighted F1, precision and recall of
    ``positive``. Everything follows from the confusion counts of one scan. Rows
    without a label or a prediction are not evaluated."""
    cells = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"),
                 zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("guess").alias("cls"), zero.alias("support"),
                 F.col("n").alias("predicted"), zero.alias("hits")),
    )
    per_class = (
        cells.select(F.inline(sides))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    f1 = ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))

    def of_positive(denominator: str):
        return F.coalesce(
            F.max(F.when(F.col("cls") == positive, ratio(F.col("hits"), F.col(denominator)))),
            F.lit(0.0),
        )

    return per_class.agg(
        F.sum("support").alias("rows"),
        ratio(F.sum("hits"), F.sum("support"), None).alias("accuracy"),
        ratio(F.sum(F.col("support") * f1), F.sum("support"), None).alias("f1"),
        of_positive("predicted").alias("precision"),
        of_positive("support").alias("recall"),
    )


def roc_points(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """``(score, pos, neg, cum_pos, cum_neg, tpr, fpr)``: one row per distinct score.

    Rows are merged per distinct score, combining on the map side; the scores
    are then summed up range by range (``running_sums``), so no task holds more
    than its range. Rows without a label or a score (null or NaN) are left out.
    """
    is_positive = F.col(label) == positive
    per_score = (
        df.where(F.col(label).isNotNull() & has_value(score))
        .select(
            F.col(score).cast("double").alias("score"),
            flag(is_positive).alias("pos"),
            flag(~is_positive).alias("neg"),
        )
        .groupBy("score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    return (
        running_sums(per_score, "score", ["pos", "neg"], descending=True)
        .withColumn("cum_pos", F.col("pos_before") + F.col("pos"))
        .withColumn("cum_neg", F.col("neg_before") + F.col("neg"))
        .select(
            "score", "pos", "neg", "cum_pos", "cum_neg",
            ratio(F.col("cum_pos"), F.col("pos_total"), None).alias("tpr"),
            ratio(F.col("cum_neg"), F.col("neg_total"), None).alias("fpr"),
        )
    )


def roc_curve(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """``(threshold, fpr, tpr)`` from the origin to (1, 1)."""
    origin = df.sparkSession.createDataFrame(
        [(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double"
    )
    points = roc_points(df, label, score, positive)
    return points.select(F.col("score").alias("threshold"), "fpr", "tpr").unionByName(origin)


def exact_auc(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """One row ``auc``: trapezoids under the exact curve, null with a single class.

    The step of each score and its height before and after are all on its own
    row, so no neighbour look-up is needed.
    """
    width = F.col("neg")
    height = F.col("cum_pos") - F.col("pos") / 2
    return roc_points(df, label, score, positive).agg(
        ratio(
            F.sum(width * height),
            F.sum("pos").cast("double") * F.sum("neg").cast("double"),
            None,
        ).alias("auc")
    )


def evaluator_auc(
    df: DataFrame, label: str = "label", score: str = "rawPrediction", num_bins: int = 1000
) -> float:
    """Spark's binned ``areaUnderROC``; ``num_bins=0`` keeps every threshold."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=num_bins
    ).evaluate(df)


def evaluator_score(
    df: DataFrame, metric: str, label: str = "label", prediction: str = "prediction"
) -> float:
    """Spark's ``accuracy`` or (weighted) ``f1``."""
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName=metric
    ).evaluate(df)
