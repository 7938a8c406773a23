"""Feature preparation, training, scoring and evaluation."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tidemark.operators import metrics as m
from tidemark.operators.features import binary_label, feature_names, fit_features, frequency_index
from tidemark.operators.models import (
    FOREST,
    LOGISTIC,
    FittedModels,
    champion,
    compare_models,
    comparison_long,
    feature_importances,
    fit_models,
    logistic_regression,
    random_forest,
)
from tidemark.operators.ordering import top_rows
from tidemark.operators.sampling import keyed_split
from tidemark.plans.registry import query
from tidemark.plans.sqltext import SCORED, rnd, with_contacts
from tidemark.session import scratch_path
from tidemark.sources.contacts import contacts_from_orders
from tidemark.sources.files import inline_table, read_table
from tidemark.sources.schemas import CATEGORICAL, NUMERIC, POSITIVE, TARGET


def stored_contacts(spark, sf_dir):
    """The contact table written once, for jobs that pass over it many times."""
    path = scratch_path(spark, "contacts")
    contacts_from_orders(spark, sf_dir, keep_key=True).write.parquet(path)
    return spark.read.parquet(path)


def contact_split(contacts):
    return keyed_split(contacts, "contact_id")


def fit_contacts(train, *names: str) -> FittedModels:
    known = {LOGISTIC: logistic_regression, FOREST: random_forest}
    chosen = {name: known[name]() for name in names or known}
    return fit_models(train, CATEGORICAL, NUMERIC, TARGET, POSITIVE, chosen, key="contact_id")


def scored_documents(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels")
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(documents, "doc_id").select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


@query(
    "i1_keyed_split",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 >= 1 THEN 'train' ELSE 'test' END AS part
       FROM orders""",
)
def split_by_key(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = keyed_split(orders, "o_orderkey", seed=None)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query(
    "i1_seeded_split",
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey || ':42'), 1, 15))::BIGINT % 5 >= 1 THEN 'train' ELSE 'test' END AS part
       FROM orders""",
)
def seeded_split(spark, sf_dir):
    """The split by a seeded hash of the key, by one that any system can repeat."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = keyed_split(orders, "o_orderkey", seed=42, portable=True)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


INDEX_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", "{c}" AS "value",
               cast(row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS integer) AS "index"
        FROM contacts GROUP BY "{c}" """
    for c in CATEGORICAL
)


@query("i2_frequency_index", with_contacts(INDEX_SQL))
def category_index(spark, sf_dir):
    return frequency_index(contacts_from_orders(spark, sf_dir), CATEGORICAL)


def _slot_sums(features, column: str, names: list[str]):
    """Sum of every vector slot over all rows, one aggregate, by slot name."""
    total = features.select(Summarizer.metrics("sum").summary(F.col(column)).alias("s"))
    labels = F.array(*[F.lit(n) for n in names])
    pairs = total.select(
        F.inline(F.arrays_zip(labels.alias("slot"), vector_to_array("s.sum").alias("total")))
    )
    return pairs.select("slot", F.round("total", 4).alias("total"))


@query(
    "i3_one_hot",
    with_contacts("""
SELECT job AS slot, cast(count(*) AS double) AS total FROM contacts GROUP BY job"""),
)
def one_hot(spark, sf_dir):
    contacts = contacts_from_orders(spark, sf_dir)
    fitted = fit_features(contacts, CATEGORICAL, NUMERIC)
    names = list(fitted.stages[0].labelsArray[CATEGORICAL.index("job")])
    return _slot_sums(fitted.transform(contacts), "job_ohe", names)


@query(
    "i4_label_index",
    """SELECT o_orderkey, cast(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS double) AS label
       FROM orders""",
)
def label_index(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return binary_label(orders, "o_orderstatus", "F").select("o_orderkey", "label")


@query(
    "i5_assembled_features",
    with_contacts(
        " UNION ALL ".join(
            [
                f"""SELECT '{c}_ohe_' || "{c}" AS slot, cast(count(*) AS double) AS total
                    FROM contacts GROUP BY "{c}" """
                for c in CATEGORICAL
            ]
            + [f"SELECT '{c}', cast(sum(\"{c}\") AS double) FROM contacts" for c in NUMERIC]
        )
    ),
)
def assembled_features(spark, sf_dir):
    contacts = contacts_from_orders(spark, sf_dir)
    features = fit_features(contacts, CATEGORICAL, NUMERIC).transform(contacts)
    return _slot_sums(features, "features", feature_names(features))


@query("i6_saved_model_scores")
def saved_model_scores(spark, sf_dir):
    """Fit, save, load, score: predicted classes by label, from the loaded model."""
    train, test = contact_split(stored_contacts(spark, sf_dir))
    fitted = fit_contacts(train, LOGISTIC)
    path = scratch_path(spark, "model")
    fitted.scorer(LOGISTIC).save(path)
    scored = PipelineModel.load(path).transform(binary_label(test, TARGET, POSITIVE))
    return m.confusion_matrix(scored, "label", "prediction")


@query("i7_logistic_regression")
def logistic_coefficients(spark, sf_dir):
    train, _ = contact_split(stored_contacts(spark, sf_dir))
    fitted = fit_contacts(train, LOGISTIC)
    names = feature_names(fitted.prepare(train))
    model = fitted.classifiers[LOGISTIC]
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients, strict=True)]
    rows.append(("intercept", float(model.intercept)))
    return inline_table(spark, rows, "feature string, coefficient double")


@query("i8_random_forest")
def forest_confusion(spark, sf_dir):
    train, test = contact_split(stored_contacts(spark, sf_dir))
    fitted = fit_contacts(train, FOREST)
    return m.confusion_matrix(fitted.score(test, FOREST), "label", "prediction")


@query("i9_batch_scores")
def batch_scores(spark, sf_dir):
    train, test = contact_split(stored_contacts(spark, sf_dir))
    scored = fit_contacts(train, LOGISTIC).score(test, LOGISTIC)
    return scored.select("contact_id", "label", "prediction")


@query("h7_vector_element")
def vector_element(spark, sf_dir):
    train, test = contact_split(stored_contacts(spark, sf_dir))
    scored = fit_contacts(train, LOGISTIC).score(test, LOGISTIC)
    return scored.select("contact_id", F.round("p_positive", 6).alias("p_positive"))


PER_SCORE = f"""
WITH {SCORED}, per_score AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
  FROM scored GROUP BY score
), curve AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos,
         sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
         sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM per_score
)"""
AUC_SQL = f"""{PER_SCORE}
SELECT {rnd("cast(sum((cum_pos - pos / 2.0) * neg) / (min(all_pos) * min(all_neg)) as double)", 6)} AS auc
FROM curve"""


@query("i10_evaluator_auc", AUC_SQL)
def evaluator_auc(spark, sf_dir):
    auc = m.evaluator_auc(scored_documents(spark, sf_dir), "label", "score", num_bins=0)
    return inline_table(spark, [(round(auc, 6),)], "auc double")


CLASSES = f"""
WITH {SCORED}, per_class AS (
  SELECT c, count(*) FILTER (WHERE label = c) AS support,
         count(*) FILTER (WHERE prediction = c) AS predicted,
         count(*) FILTER (WHERE label = c AND prediction = c) AS hits
  FROM scored, (VALUES (0), (1)) AS v(c) GROUP BY c
)"""


@query(
    "i11_accuracy",
    f"""WITH {SCORED}
SELECT {rnd("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)", 6)} AS accuracy FROM scored""",
)
def accuracy(spark, sf_dir):
    value = m.evaluator_score(
        scored_documents(spark, sf_dir).select(
            F.col("label").cast("double"), F.col("prediction").cast("double")
        ),
        "accuracy",
    )
    return inline_table(spark, [(round(value, 6),)], "accuracy double")


@query(
    "i12_weighted_f1",
    f"""{CLASSES}
SELECT {rnd("sum(support * (2.0 * hits / (support + predicted))) / sum(support)", 6)} AS f1
FROM per_class""",
)
def weighted_f1(spark, sf_dir):
    scores = m.classification_scores(scored_documents(spark, sf_dir), "label", "prediction")
    return scores.select(F.round("f1", 6).alias("f1"))


@query(
    "i13_confusion_matrix",
    f"""WITH {SCORED}
SELECT cast(a AS integer) AS label, cast(b AS integer) AS prediction,
       count(*) FILTER (WHERE label = a AND prediction = b) AS "count"
FROM scored, (VALUES (0), (1)) AS v(a), (VALUES (0), (1)) AS w(b) GROUP BY a, b""",
)
def confusion(spark, sf_dir):
    return m.confusion_matrix(scored_documents(spark, sf_dir), "label", "prediction")


@query(
    "i14_roc_points",
    f"""{PER_SCORE}
SELECT score, cast(cum_pos AS bigint) AS cum_pos, cast(cum_neg AS bigint) AS cum_neg,
       {rnd("cast(cum_pos as double) / all_pos", 6)} AS tpr,
       {rnd("cast(cum_neg as double) / all_neg", 6)} AS fpr FROM curve""",
)
def roc_points(spark, sf_dir):
    points = m.roc_points(scored_documents(spark, sf_dir), "label", "score")
    return points.select(
        "score", "cum_pos", "cum_neg", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr")
    )


@query(
    "i14_roc_order_status",
    f"""
WITH per_score AS (
  SELECT o_totalprice AS score, count(*) FILTER (WHERE o_orderstatus = 'F') AS pos,
         count(*) FILTER (WHERE o_orderstatus <> 'F') AS neg FROM orders GROUP BY 1
), curve AS (
  SELECT score, sum(pos) OVER (ORDER BY score DESC) AS cum_pos,
         sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
         sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg FROM per_score
)
SELECT score AS threshold, {rnd("cast(cum_neg as double) / all_neg", 6)} AS fpr,
       {rnd("cast(cum_pos as double) / all_pos", 6)} AS tpr FROM curve
UNION ALL SELECT cast('inf' AS double), 0.0, 0.0""",
)
def roc_order_status(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("label"), "o_totalprice"
    )
    curve = m.roc_curve(orders, "label", "o_totalprice")
    return curve.select(
        "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr")
    )


@query("i14_exact_auc", AUC_SQL)
def exact_auc(spark, sf_dir):
    auc = m.exact_auc(scored_documents(spark, sf_dir), "label", "score")
    return auc.select(F.round("auc", 6).alias("auc"))


@query("i15_feature_importances")
def importances(spark, sf_dir):
    train, _ = contact_split(stored_contacts(spark, sf_dir))
    ranked = feature_importances(fit_contacts(train, FOREST), train)
    return top_rows(ranked, 15, "importance", "feature")


@query("i16_model_comparison")
def model_comparison(spark, sf_dir):
    train, test = contact_split(stored_contacts(spark, sf_dir))
    comparison = compare_models(fit_contacts(train), test)
    best = champion(comparison).select("model", F.lit("champion").alias("role"))
    return comparison_long(comparison).join(F.broadcast(best), "model", "left")


@query(
    "i17_precision_recall",
    f"""{CLASSES}
SELECT {rnd("cast(hits as double) / predicted", 6)} AS "precision",
       {rnd("cast(hits as double) / support", 6)} AS recall FROM per_class WHERE c = 1""",
)
def precision_recall(spark, sf_dir):
    scores = m.classification_scores(scored_documents(spark, sf_dir), "label", "prediction")
    return scores.select(
        F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall")
    )
