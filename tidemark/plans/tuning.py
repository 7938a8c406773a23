"""Model search, boosted trees, and what must hold of every trained model, as rows that SQL states exactly."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import tuning
from tidemark.operators.keyed_joins import settle
from tidemark.operators.models import (
    FOREST, LOGISTIC, champion, compare_models, feature_importances, fit_models, logistic_regression, random_forest,
)
from tidemark.operators.sampling import keyed_split
from tidemark.plans.learning import stored_contacts
from tidemark.plans.registry import query
from tidemark.plans.sqltext import with_contacts
from tidemark.session import scratch_path
from tidemark.sources.files import inline_table
from tidemark.sources.schemas import CATEGORICAL, NUMERIC, POSITIVE, TARGET

FOLDS = 3
CANDIDATES = {
    "ridge 0.01": lambda: logistic_regression(10).setRegParam(0.01),
    "ridge 1": lambda: logistic_regression(10).setRegParam(1.0),
}


@query(
    "i18_cross_validation",
    with_contacts(f"""
SELECT name AS candidate, cast(contact_id % {FOLDS} AS integer) AS fold, count(*) AS n_rows,
       count(*) FILTER (WHERE y = 'yes') AS n_positive, true AS better_than_chance
FROM contacts, (VALUES {", ".join(f"('{c}')" for c in CANDIDATES)}) AS v(name) GROUP BY ALL"""),
)
def cross_validation(spark, sf_dir):
    """Each fold scored by models of the others: its rows per candidate, and whether accuracy beats the rarer class."""
    scored = tuning.cross_validated_scores(
        stored_contacts(spark, sf_dir), "contact_id", FOLDS, CATEGORICAL, NUMERIC, TARGET, POSITIVE, CANDIDATES, seed=None
    )
    share = F.col("n_positive") / F.col("n_rows")
    return tuning.fold_metrics(scored).select(
        "candidate", "fold", "n_rows", "n_positive", (F.col("accuracy") >= F.least(share, 1 - share)).alias("better_than_chance")
    )


@query(
    "i19_boosted_trees",
    with_contacts("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE y = 'yes') AS n_positive, count(*) AS n_agree, true AS within_most
FROM contacts WHERE contact_id % 5 = 0"""),
)
def boosted_trees(spark, sf_dir):
    """Test rows, and those whose probability the trees give again when added up by hand."""
    train, test = keyed_split(stored_contacts(spark, sf_dir), "contact_id", seed=None)
    fitted = tuning.boosted_trees(train, "contact_id", CATEGORICAL, NUMERIC, TARGET, POSITIVE, most_trees=8, depth=3)
    model = fitted.classifiers["Boosted Trees"]
    scored = tuning.recomputed_probability(fitted.score(test, "Boosted Trees"), model)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_positive"),
        F.count_if(F.abs(F.col("p_recomputed") - F.col("p_positive")) < 1e-9).alias("n_agree"),
    ).withColumn("within_most", F.lit(len(model.trees) <= 8))


@query(
    "i20_model_invariants",
    with_contacts("""
SELECT model, check_name, n_rows FROM (WITH held AS (SELECT * FROM contacts WHERE contact_id % 5 = 0), sizes AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = 'yes') AS p FROM held),
models AS (SELECT * FROM (VALUES ('Logistic Regression'), ('Random Forest')) AS v(model))
SELECT model, check_name, cast(CASE check_name WHEN 'positives' THEN p ELSE n END AS bigint) AS n_rows
FROM models, sizes, (VALUES ('rows'), ('positives'), ('probabilities sum to 1'), ('prediction is the likelier class'),
    ('element is the probability of the positive class'), ('loaded model scores alike')) AS c(check_name)
UNION ALL SELECT 'Random Forest', 'importances sum to 1', 1
UNION ALL SELECT 'both', 'scores lie from 0 to 1', 2
UNION ALL SELECT 'both', 'champion has the highest AUC', 1)"""),
)
def model_invariants(spark, sf_dir):
    """What must hold of each model whatever it has learned, as numbers of rows for which it does."""
    train, test = keyed_split(stored_contacts(spark, sf_dir), "contact_id", seed=None)
    fitted = fit_models(
        train, CATEGORICAL, NUMERIC, TARGET, POSITIVE, {LOGISTIC: logistic_regression(), FOREST: random_forest(20, 5)},
        key="contact_id",
    )
    out = None
    for name in fitted.classifiers:
        path = scratch_path(spark, "model")
        fitted.scorer(name).save(path)
        loaded = PipelineModel.load(path).transform(test).select("contact_id", vector_to_array("probability")[1].alias("again"))
        scored = fitted.score(test, name).withColumn("p", vector_to_array("probability")).join(loaded, "contact_id")
        checks = {
            "rows": F.lit(True), "positives": F.col("label") == 1,
            "probabilities sum to 1": F.abs(F.col("p")[0] + F.col("p")[1] - 1) < 1e-9,
            "prediction is the likelier class": (F.col("prediction") == 1) == (F.col("p")[1] > F.col("p")[0]),
            "element is the probability of the positive class": F.col("p_positive") == F.col("p")[1],
            "loaded model scores alike": F.col("again") == F.col("p_positive"),
        }
        counted = scored.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])
        long = counted.unpivot([], list(checks), "check_name", "n_rows").select(F.lit(name).alias("model"), "check_name", "n_rows")
        out = long if out is None else out.union(long)
    importance = feature_importances(fitted, train).agg(F.count_if(F.col("importance") < 0).alias("bad"), F.sum("importance").alias("total"))
    compared = settle(compare_models(fitted, test), bounded=True)
    best = champion(compared).join(compared.agg(F.max("auc").alias("most")), F.col("auc") == F.col("most"))
    between = compared.where(" and ".join(f"{c} between 0 and 1" for c in ("auc", "accuracy", "f1", "precision", "recall")))
    lines = [
        (FOREST, "importances sum to 1", importance.where("bad = 0 and abs(total - 1) < 1e-9").count()),
        ("both", "scores lie from 0 to 1", between.count()),
        ("both", "champion has the highest AUC", best.count()),
    ]
    return out.union(inline_table(spark, lines, "model string, check_name string, n_rows bigint"))
