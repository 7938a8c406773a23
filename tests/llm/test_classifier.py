import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import SF_DIR, clashing, document, documents, prose
from tidemark.llm.classifier import (
    classify_quality, dual_coordinate_descent, fit_quality, indicators, log_count_ratios, score_quality, training_rows,
)

LABELS = "doc_id bigint, quality int, toxic int"


def junk(i):
    rng = random.Random(i)
    return " ".join(f"j{rng.randrange(5000)}{rng.choice(['!!', '$$$', '***'])}" for _ in range(40))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [document(i, junk(i) if i % 4 == 0 else prose(f"good{i}", 4)) for i in range(240)]
    return documents(spark, rows), spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(240)], LABELS)


def test_held_out_accuracy_on_the_test_table(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify_quality(docs, labels).collect()
    want = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    hits = [r["predicted"] == want[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in want]
    assert len(hits) > 50 and np.mean(hits) >= 0.95


def test_labels_of_the_fold_are_not_used(labelled, spark):
    docs, labels = labelled
    turned = spark.createDataFrame(
        [(r["doc_id"], 1 - r["quality"] if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 else r["quality"], 1) for r in labels.collect()], LABELS
    )
    a, b = (sorted(classify_quality(docs.repartition(n), x).collect()) for n, x in ((1, labels), (5, turned)))
    assert a == b


def test_bound_holds_and_conflicts_are_left_out(labelled, spark):
    docs, labels = labelled
    assert training_rows(docs, labels, 30).count() == 30
    conflict = labels.union(spark.createDataFrame([(i, 0, 0) for i in range(240)] + [(None, 1, 0), (3, None, 0)], LABELS))
    assert {r["class"] for r in training_rows(docs, conflict, 500).collect()} == {0}
    other = labels.selectExpr("doc_id", "quality + 5 as quality")
    assert training_rows(docs, other, 500).count() == 0


def test_descent_solves_the_dual_problem():
    rng = np.random.default_rng(1)
    dense = rng.normal(size=(40, 6))
    classes = np.sign(dense[:, 0] + 0.3 * rng.normal(size=40))
    rows, cost = [np.arange(6)] * 40, np.full(40, 0.7)
    weights = dual_coordinate_descent(rows, list(dense), classes, 6, cost, rounds=2000, least=1e-9)

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - classes * (dense @ w))).sum()

    best = loss(weights)
    assert all(loss(weights + 1e-3 * rng.normal(size=6)) >= best - 1e-9 for _ in range(300))


def test_ratios_and_indicators():
    held = np.array([[1.0, 3.0], [3.0, 1.0]])
    assert np.allclose(log_count_ratios(held, [6.0, 6.0], 1.0), np.log([(4 / 6) / (2 / 6), (2 / 6) / (4 / 6)]))
    assert indicators("a b a b", 20).size == len(set(indicators("a b a b", 20)))
    assert indicators("Éan Éan Éan", 20).size and not indicators("  \n", 20).size and not indicators(None, 20).size
    assert set(indicators("same same", 20)) != set(indicators("same other", 20))


def test_odd_and_empty(labelled, spark, odd, empty):
    docs, labels = labelled
    model = fit_quality(docs, labels)
    rows = score_quality(clashing(odd), model).collect()
    assert len(rows) == odd.count() and sorted(map(str, rows)) == sorted(map(str, score_quality(odd, model).collect()))
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert classify_quality(empty, labels).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in classify_quality(odd, none).collect()} == {0.5}
    assert all(r["predicted"] == 1 for r in classify_quality(docs, labels.where("quality = 1")).collect())
    assert len(classify_quality(clashing(docs), labels.selectExpr("*", "'x' as text", "'y' as class")).collect()) == 240
