"""Training, scoring and comparing the two classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import binary_label, feature_names, fit_features
from tidemark.operators.forest import BinnedForest
from tidemark.operators.grouping import append_snapshots
from tidemark.operators.keyed_joins import settle
from tidemark.operators.metrics import classification_scores, exact_auc
from tidemark.operators.ordering import best_row
from tidemark.sources.files import inline_table

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
#: Training keeps some KB a row in memory: tasks read a bounded part of it, however many rows there are.
PARTITION_ROWS = 200_000


def logistic_regression(max_iter: int = 50) -> LogisticRegression:
    return LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter)


def random_forest(trees: int = 100, depth: int = 8, seed: int = 42) -> RandomForestClassifier:
    """Trained over blocks of binned rows; where Spark's own trainer is used, it keeps the rows' nodes between levels."""
    return BinnedForest(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True
    )


@dataclass
class FittedModels:
    """One fitted feature preparation and the classifiers trained behind it."""

    features: PipelineModel
    classifiers: dict[str, Model]
    target: str
    positive: str

    def prepare(self, df: DataFrame) -> DataFrame:
        return self.features.transform(binary_label(df, self.target, self.positive))

    def scorer(self, name: str) -> PipelineModel:
        """Features and classifier as one model that can be saved and loaded."""
        return PipelineModel(stages=[*self.features.stages, self.classifiers[name]])

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Rows with ``prediction``, ``probability`` and the scalar ``p_positive``."""
        scored = self.classifiers[name].transform(self.prepare(df))
        return scored.withColumn("p_positive", vector_to_array("probability")[1])


def laid_out(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` in a layout that follows from the row keys alone, however it was partitioned.

    Bagging draws row by row in each partition, so a forest depends on the layout.
    There are as many partitions as the session shuffles to, and more where
    each would hold over ``PARTITION_ROWS``, unless ``partitions`` fixes them for
    a result that no other session changes. Keys that name a row deal rows out
    evenly; of equal keys the order is open.
    """
    number = partitions
    if not number:
        number = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PARTITION_ROWS))
    return df.repartition(number, *keys).sortWithinPartitions(*keys)


def fit_models(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    target: str,
    positive: str,
    estimators: dict | None = None,
    key: str | None = None,
    partitions: int | None = None,
) -> FittedModels:
    """Fit the feature stages once and every classifier on their result.

    Rows are laid out by ``key``, which should name a row, else by all their
    values; results then do not follow the input's partitions (see
    :func:`laid_out`). The two columns that training iterates over are kept in
    memory (spilling to disk) for exactly the time of training.
    """
    estimators = estimators or {LOGISTIC: logistic_regression(), FOREST: random_forest()}
    values = [*categorical, *numeric, target]
    train = train.select(*([key] if key and key not in values else []), *values)
    features = fit_features(train, categorical, numeric)
    placed = laid_out(train, [key] if key else values, partitions)
    labelled = binary_label(placed, target, positive).where(F.col("label").isNotNull())
    ready = (
        features.transform(labelled)
        .select("label", "features")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        classifiers = {name: e.fit(ready) for name, e in estimators.items()}
    finally:
        ready.unpersist()
    return FittedModels(features, classifiers, target, positive)


def evaluate_scored(scored: DataFrame) -> DataFrame:
    """One row: rows, accuracy, f1, precision, recall and exact auc.

    The rows are scored once; both aggregates read the three kept columns.
    """
    slim = scored.select("label", "prediction", "p_positive").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        auc = exact_auc(slim, "label", "p_positive").first()["auc"]
        scores = classification_scores(slim, "label", "prediction")
        return settle(scores.withColumn("auc", F.lit(auc).cast("double")), bounded=True)
    finally:
        slim.unpersist()


def compare_models(fitted: FittedModels, test: DataFrame) -> DataFrame:
    """``(model, auc, accuracy, f1, precision, recall)`` for each classifier."""
    return append_snapshots(
        *[
            evaluate_scored(fitted.score(test, name)).select(
                F.lit(name).alias("model"), "auc", "accuracy", "f1", "precision", "recall"
            )
            for name in fitted.classifiers
        ]
    )


def comparison_long(comparison: DataFrame) -> DataFrame:
    """``(model, metric, score)`` with AUC, Accuracy and F1."""
    return comparison.select(
        "model", F.col("auc").alias("AUC"), F.col("accuracy").alias("Accuracy"),
        F.col("f1").alias("F1"),
    ).unpivot(["model"], ["AUC", "Accuracy", "F1"], "metric", "score")


def champion(comparison: DataFrame) -> DataFrame:
    """The row of the model with the highest AUC."""
    return best_row(comparison, "auc", "model")


def feature_importances(fitted: FittedModels, df: DataFrame, name: str = FOREST) -> DataFrame:
    """``(feature, importance)`` with names from the vector's own metadata.

    Only the schema of ``df`` is used; the rows come from the fitted model, one
    per feature slot.
    """
    names = feature_names(fitted.prepare(df))
    values = fitted.classifiers[name].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return inline_table(df.sparkSession, rows, "feature string, importance double")
