import numpy as np
import pytest

from tidemark.operators import metrics as m

rng = np.random.default_rng(5)


def frame(spark, labels, scores):
    rows = [(int(a), float(b)) for a, b in zip(labels, scores, strict=True)]
    return spark.createDataFrame(rows, "label int, score double").repartition(4)


def rank_sum_auc(labels, scores):
    labels, scores = np.asarray(labels), np.asarray(scores, dtype=float)
    pos, neg = scores[labels == 1], scores[labels != 1]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


CASES = {
    "distinct": (rng.integers(0, 2, 900), rng.random(900)),
    "ties": (rng.integers(0, 2, 900), rng.integers(0, 6, 900)),
    "hot_score": (rng.integers(0, 2, 900), np.where(rng.random(900) < 0.4, 0.5, rng.random(900))),
    "negative": (rng.integers(0, 2, 300), rng.normal(-3, 50, 300)),
    "narrow": (rng.integers(0, 2, 500), 0.5 + rng.random(500) * 1e-9),
    "perfect": (np.arange(50) >= 25, np.arange(50)),
    "one_score": (np.arange(10) % 2, np.ones(10)),
}


@pytest.mark.parametrize("case", CASES)
def test_auc_is_the_rank_sum(spark, case):
    labels, scores = CASES[case]
    df = frame(spark, labels, scores)
    got = m.exact_auc(df, "label", "score").first()["auc"]
    assert got == pytest.approx(rank_sum_auc(labels, scores), abs=1e-12)
    assert m.evaluator_auc(df, "label", "score", 0) == pytest.approx(got, abs=1e-9)


@pytest.mark.parametrize("case", CASES)
def test_roc_is_monotone_and_complete(spark, case):
    labels, scores = CASES[case]
    df = frame(spark, labels, scores)
    curve = [tuple(r) for r in m.roc_curve(df, "label", "score").collect()]
    curve.sort(key=lambda r: -r[0])
    assert curve[0] == (float("inf"), 0.0, 0.0)
    assert curve[-1][1:] == (1.0, 1.0)
    assert len(curve) == len(set(map(float, scores))) + 1
    for before, after in zip(curve, curve[1:]):
        assert before[1] <= after[1] and before[2] <= after[2]
    area = sum(
        (b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(curve, curve[1:])
    )
    assert area == pytest.approx(rank_sum_auc(labels, scores), abs=1e-9)


def test_roc_does_not_depend_on_partitions(spark):
    df = frame(spark, *CASES["ties"])
    want = sorted(m.roc_points(df, "label", "score").collect())
    assert sorted(m.roc_points(df.repartition(13), "label", "score").collect()) == want


def test_one_class_only(spark):
    df = frame(spark, [1, 1, 1], [0.1, 0.2, 0.3])
    assert m.exact_auc(df, "label", "score").first()["auc"] is None
    points = m.roc_points(df, "label", "score").collect()
    assert all(r["fpr"] is None for r in points) and max(r["tpr"] for r in points) == 1.0


def test_no_rows(spark):
    df = spark.createDataFrame([], "label int, score double")
    assert m.exact_auc(df, "label", "score").first()["auc"] is None
    assert sum(r["count"] for r in m.confusion_matrix(df, "label", "label").collect()) == 0
    assert m.classification_scores(df, "label", "label").first()["accuracy"] is None


def scored(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")


PAIRS = [(1, 1)] * 5 + [(1, 0)] * 3 + [(0, 1)] * 2 + [(0, 0)] * 10


def test_scores_by_hand(spark):
    df = scored(spark, PAIRS)
    row = m.classification_scores(df, "label", "prediction").first()
    f1_pos, f1_neg = 10 / (10 + 3 + 2), 20 / (20 + 3 + 2)
    assert row["rows"] == 20
    assert row["accuracy"] == pytest.approx(15 / 20)
    assert row["f1"] == pytest.approx((8 * f1_pos + 12 * f1_neg) / 20)
    assert row["precision"] == pytest.approx(5 / 7)
    assert row["recall"] == pytest.approx(5 / 8)
    assert m.evaluator_score(df, "f1") == pytest.approx(row["f1"])
    assert m.evaluator_score(df, "accuracy") == pytest.approx(row["accuracy"])


def test_no_predicted_positive(spark):
    row = m.classification_scores(scored(spark, [(1, 0), (0, 0)]), "label", "prediction").first()
    assert (row["precision"], row["recall"]) == (0.0, 0.0)


def test_confusion_matrix_is_complete(spark):
    cells = {tuple(r)[:2]: r["count"] for r in m.confusion_matrix(scored(spark, [(0, 0)] * 4), "label", "prediction").collect()}
    assert cells == {(0, 0): 4, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    full = {tuple(r)[:2]: r["count"] for r in m.confusion_matrix(scored(spark, PAIRS), "label", "prediction").collect()}
    assert full == {(0, 0): 10, (0, 1): 2, (1, 0): 3, (1, 1): 5}
