"""Search over candidates by cross-validation with folds by key, and boosted trees that stop on a validation set."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import binary_label, fit_features
from tidemark.operators.keyed_joins import checkpointed, settle
from tidemark.operators.models import FittedModels, fit_models, laid_out
from tidemark.operators.sampling import stable_bucket


def with_folds(df: DataFrame, key: str, folds: int, seed: int | None = 42, as_name: str = "fold") -> DataFrame:
    """``df`` with a fold from 0 that follows from the row key alone; null keys are in fold 0."""
    return df.withColumn(as_name, stable_bucket(F.col(key), folds, seed))


def cross_validated_scores(
    df: DataFrame,
    key: str,
    folds: int,
    categorical: Sequence[str],
    numeric: Sequence[str],
    target: str,
    positive: str,
    candidates: dict[str, Callable[[], Estimator]],
    parallelism: int = 2,
    seed: int | None = 42,
) -> DataFrame:
    """``fold, candidate, label, prediction, p_positive``: each row scored by the models of the other folds, once per candidate.

    The feature stages of a fold are fitted on the other folds only, once for
    all candidates. ``parallelism`` folds are trained at a time. Rows without a
    label are left out. Folds without rows, or whose other folds lack a class,
    are the caller's to avoid: training raises the estimator's own error.
    """
    numbered = settle(with_folds(df.where(F.col(target).isNotNull()), key, folds, seed))

    def one(fold: int) -> DataFrame:
        fitted = fit_models(
            numbered.where(F.col("fold") != fold), categorical, numeric, target, positive,
            {name: make() for name, make in candidates.items()}, key=key,
        )
        held = numbered.where(F.col("fold") == fold)
        scored = None
        for name in candidates:
            own = fitted.score(held, name).select(
                "fold", F.lit(name).alias("candidate"), "label", "prediction", "p_positive"
            )
            scored = own if scored is None else scored.union(own)
        return settle(scored)

    pool = ThreadPool(min(parallelism, folds))
    try:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
    finally:
        pool.close()
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def fold_metrics(scored: DataFrame, by: Sequence[str] = ("candidate", "fold")) -> DataFrame:
    """``*by, n_rows, n_positive, accuracy, log_loss, f1`` of scored rows, in one aggregate.

    Probabilities count as at least 1e-15 from 0 and 1. ``f1`` is that of the
    positive class, 0 without a positive label or prediction.
    """
    positive, told = F.col("label") == 1, F.col("prediction") == 1
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("p_positive")))
    found = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(positive).alias("n_positive"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.avg(-F.log(F.when(positive, p).otherwise(1 - p))).alias("log_loss"),
        F.count_if(positive & told).alias("__hits"), F.count_if(told).alias("__told"),
    )
    both = F.col("n_positive") + F.col("__told")
    f1 = F.when(both > 0, 2 * F.col("__hits") / both).otherwise(0.0)
    return found.withColumn("f1", f1).drop("__hits", "__told")


def best_candidate(scored: DataFrame) -> DataFrame:
    """One row: the candidate of the least log loss over all held-out rows; ties go to the name that sorts first."""
    return fold_metrics(scored, ["candidate"]).orderBy("log_loss", "candidate").limit(1)


def boosted_trees(
    train: DataFrame,
    key: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    target: str,
    positive: str,
    most_trees: int = 20,
    depth: int = 4,
    validation_buckets: int = 1,
    buckets: int = 5,
    checkpoint_every: int = 10,
    seed: int = 42,
    key_seed: int | None = 42,
    name: str = "Boosted Trees",
) -> FittedModels:
    """Trees added one after the other until the loss on the validation rows no longer falls, ``most_trees`` at most.

    Validation rows are chosen by key; the feature stages are fitted on the
    others. Rows are laid out by ``key`` in partitions of bounded size (see
    :func:`laid_out`) and kept for the time of training; the node numbers that each
    tree hands to the next are checkpointed in the shared folder every
    ``checkpoint_every`` trees, so that lineage stays short and a lost executor
    costs no more than those.
    """
    checkpointed(train.limit(0))  # names the checkpoint folder where a session has none
    marked = train.where(F.col(target).isNotNull()).withColumn(
        "held", stable_bucket(F.col(key), buckets, key_seed) < validation_buckets
    )
    features = fit_features(marked.where("not held"), categorical, numeric)
    ready = features.transform(binary_label(laid_out(marked, [key]), target, positive)).select("label", "features", "held")
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    estimator = GBTClassifier(
        labelCol="label", featuresCol="features", validationIndicatorCol="held", maxIter=most_trees, maxDepth=depth,
        checkpointInterval=checkpoint_every, cacheNodeIds=True, seed=seed,
    )
    try:
        return FittedModels(features, {name: estimator.fit(ready)}, target, positive)
    finally:
        ready.unpersist()


def recomputed_probability(scored: DataFrame, model: GBTClassificationModel, as_name: str = "p_recomputed") -> DataFrame:
    """``scored`` with the probability that the trees themselves give: the logistic function of twice their weighted sum."""
    margin = F.lit(0.0)
    out = scored
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
        out = tree.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"__tree{i}").transform(out)
        margin = margin + F.col(f"__tree{i}") * F.lit(weight)
    out = out.withColumn(as_name, 1 / (1 + F.exp(-2 * margin)))
    return out.drop(*[f"__tree{i}" for i in range(len(model.trees))])
