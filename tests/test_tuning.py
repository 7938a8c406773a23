import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import tuning
from tidemark.operators.models import logistic_regression


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, "ab"[i % 2], float(i % 17), "yes" if i % 17 > 8 + i % 3 else "no") for i in range(300)]
    rows += [(None, "a", 1.0, "no"), (900, "b", 2.0, None)]
    return spark.createDataFrame(rows, "id long, kind string, x double, y string").repartition(3)


CANDIDATES = {"weak": lambda: logistic_regression(3).setRegParam(10.0), "strong": lambda: logistic_regression(10)}


@pytest.fixture(scope="module")
def scored(people):
    return tuning.cross_validated_scores(people, "id", 3, ["kind"], ["x"], "y", "yes", CANDIDATES, seed=None)


def test_each_labelled_row_is_scored_once_per_candidate(scored, people):
    counts = {(r["candidate"], r["fold"]): r["n"] for r in scored.groupBy("candidate", "fold").agg(F.count("*").alias("n")).collect()}
    assert counts == {(c, f): 100 + (f == 0) for c in CANDIDATES for f in range(3)}


def test_metrics_equal_sql_on_the_kept_scores(scored):
    kept = scored.toPandas()  # noqa: F841
    want = duckdb.sql("""SELECT candidate, fold, count(*), count(*) FILTER (label = 1), avg((label = prediction)::int),
        avg(-ln(CASE WHEN label = 1 THEN p_positive ELSE 1 - p_positive END)),
        2.0 * count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1), 0)
        FROM kept GROUP BY 1, 2""").fetchall()
    got = {(r["candidate"], r["fold"]): tuple(r)[2:] for r in tuning.fold_metrics(scored).collect()}
    assert len(got) == len(want) == 6
    for c, f, *values in want:
        assert all(math.isclose(a, b or 0.0, rel_tol=1e-9, abs_tol=1e-12) for a, b in zip(got[(c, f)], values, strict=True))


def test_best_candidate_and_ties(scored, spark):
    assert tuning.best_candidate(scored).first()["candidate"] == "strong"
    tie = spark.createDataFrame([("b", 1.0, 1.0, 0.5), ("a", 0.0, 1.0, 0.5)], "candidate string, label double, prediction double, p_positive double")
    assert tuning.best_candidate(tie).first()["candidate"] == "a"
    assert tuning.fold_metrics(tie.limit(0), ["candidate"]).count() == 0
    sure = tie.selectExpr("candidate", "label", "prediction", "1D as p_positive")
    assert all(math.isfinite(r["log_loss"]) for r in tuning.fold_metrics(sure, ["candidate"]).collect())


def test_folds_follow_the_key(people):
    folds = tuning.with_folds(people, "id", 4)
    again = tuning.with_folds(people.repartition(9), "id", 4)
    assert sorted(map(str, folds.collect())) == sorted(map(str, again.collect()))
    assert folds.where("id is null").first()["fold"] == 0


def test_boosted_trees_stop_and_add_up(people):
    fitted = tuning.boosted_trees(people, "id", ["kind"], ["x"], "y", "yes", most_trees=30, depth=3, checkpoint_every=2)
    model = fitted.classifiers["Boosted Trees"]
    assert 1 <= len(model.trees) < 30  # a rule this simple stops early
    out = tuning.recomputed_probability(fitted.score(people.where("y is not null"), "Boosted Trees"), model)
    rows = out.select("label", "prediction", "p_positive", "p_recomputed").collect()
    assert len(rows) == 301
    assert all(abs(r["p_positive"] - r["p_recomputed"]) < 1e-9 for r in rows)
    assert sum(r["label"] == r["prediction"] for r in rows) > 280


def test_boosted_trees_read_partitions_of_bounded_size(people, monkeypatch):
    seen = []

    class Watched(tuning.GBTClassifier):
        def fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset)

    monkeypatch.setattr(tuning, "GBTClassifier", Watched)
    monkeypatch.setattr("tidemark.operators.models.PARTITION_ROWS", 20)
    tuning.boosted_trees(people, "id", ["kind"], ["x"], "y", "yes", most_trees=1, depth=2)
    assert seen == [16]  # 301 rows with a label
