import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyed_joins, quantiles as q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
rng = np.random.default_rng(3)

SHAPES = {
    "normal": rng.normal(0, 1, 3001),
    "integers": rng.integers(-50, 50, 3000).astype(float),
    "hot_value": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(5, 100, 3000)),
    "heavy_tail": np.exp(rng.normal(0, 15, 2500)) * rng.choice([-1, 1], 2500),
    "narrow": 1e6 + rng.random(2000) * 1e-6,
    "outlier": np.append(rng.random(1000), 1e300),
    "small_and_one": np.append(rng.random(4000) * 1e-6, 0.0155),
    "many": rng.normal(0, 1, 60_000),
    "constant": np.full(50, 3.25),
    "two": np.array([1.0, 2.0]),
    "single": np.array([5.0]),
    "tiny": np.array([1e-300, 2e-300, 5e-320, -4e-310, 0.0]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_matches_brute_force(spark, shape):
    data = SHAPES[shape]
    df = spark.createDataFrame(pd.DataFrame({"v": data})).repartition(5)
    got = {r["prob"]: r["quantile"] for r in q.quantiles(df, "v", PROBS).collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(data, p), rel=1e-12, abs=1e-320)


def groups(spark, n_groups, null_group=True):
    rows = [(f"g{i % n_groups}", float((i * 7919) % 1000)) for i in range(3000)]
    if null_group:
        rows += [(None, float(i)) for i in range(11)]
    rows += [("g0", None), ("empty", None), ("g0", float("nan"))]
    return spark.createDataFrame(rows, "k string, v double"), rows


@pytest.mark.parametrize("n_groups", [2, 150])
def test_groups_nulls_and_nan(spark, n_groups):
    df, rows = groups(spark, n_groups)
    got = {(r["k"], r["prob"]): r["quantile"] for r in q.quantiles(df, "v", [0.25, 0.9], ["k"]).collect()}
    by = {}
    for k, v in rows:
        if v is not None and v == v:
            by.setdefault(k, []).append(v)
    want = {(k, p): np.quantile(v, p) for k, v in by.items() for p in (0.25, 0.9)}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_same_result_when_settled_parts_are_checkpointed(spark, monkeypatch):
    df, _ = groups(spark, 7)
    want = sorted(map(str, q.quantiles(df, "v", [0.5], ["k"]).collect()))
    monkeypatch.setattr(q, "settle", lambda d, bounded=False: keyed_joins.checkpointed(d))
    assert sorted(map(str, q.quantiles(df, "v", [0.5], ["k"]).collect())) == want


def test_settle_reads_back_what_it_wrote(spark):
    settled = keyed_joins.settle(spark.range(20))
    assert sorted(r[0] for r in settled.collect()) == list(range(20))
    assert "Range" not in settled._jdf.queryExecution().toString()


def test_empty_input(spark):
    empty = spark.createDataFrame([], "v double")
    assert q.quantiles(empty, "v", [0.5]).collect() == []
    assert q.trim_to_percentiles(empty, "v").count() == 0


def test_trim_on_the_bounds(spark):
    df = spark.range(101).select(F.col("id").cast("int").alias("v"))
    assert q.trim_to_percentiles(df, "v", closed=True).count() == 99
    assert q.trim_to_percentiles(df, "v", closed=False).count() == 97


def test_trim_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").cast("double").alias("v")).write.parquet(path)
    trimmed = q.trim_to_percentiles(spark.read.parquet(path), "v")
    plan = trimmed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(v," in plan


def test_approximate_form(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    got = {r["prob"]: r["quantile"] for r in q.approximate_quantiles(df, "v", [0.1, 0.5]).collect()}
    assert got[0.1] == pytest.approx(100, abs=1) and got[0.5] == pytest.approx(500, abs=1)


def test_quantile_row(spark):
    df = spark.range(5).select(F.col("id").alias("v"))
    assert tuple(q.quantile_row(df, "v", {"a": 0.5, "b": 1.0}).first()) == (2.0, 4.0)
