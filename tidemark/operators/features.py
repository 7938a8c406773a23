"""Feature preparation on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import flag
from tidemark.operators.grouping import category_counts


def frequency_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, index)``: 0 for the most frequent value, ties by name.

    One scan for all columns. What the window numbers are the distinct values of
    one category column, the same set an indexer model holds.
    """
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    return (
        category_counts(df, columns)
        .where(F.col("value").isNotNull())
        .select("column", "value", (F.row_number().over(order) - 1).cast("int").alias("index"))
    )


def binary_label(df: DataFrame, target: str, positive: str, label_as: str = "label") -> DataFrame:
    """Label 1.0 for the named positive class, 0.0 for any other value.

    Naming the class keeps the label's meaning when the class frequencies turn;
    a row without a target gets no label.
    """
    label: Column = F.when(F.col(target).isNotNull(), flag(F.col(target) == positive))
    return df.withColumn(label_as, label.cast("double"))


def feature_stages(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """Index, one-hot encode and assemble into the sparse vector ``features``.

    The multi-column indexer counts all categories in one job. Values not seen
    in fitting go to an extra index, which is the slot the encoder drops.
    """
    indexed = [f"{c}_idx" for c in categorical]
    encoded = [f"{c}_ohe" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=encoded + list(numeric), outputCol="features"),
    ]


def fit_features(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]
) -> PipelineModel:
    return Pipeline(stages=feature_stages(categorical, numeric)).fit(df)


def feature_names(features: DataFrame, column: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its metadata."""
    groups = features.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a["idx"], a["name"]) for group in groups for a in group)
    return [name for _, name in slots]
