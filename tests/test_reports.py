import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import partitioning as pt
from tidemark.plans import reports
from tidemark.sources.files import inline_table
from tidemark.sources.schemas import CONTACT_SCHEMA
from tidemark.streaming.replay import disjoint_batches, replay


def lines(df):
    return {(r["insight"], r["key"]): r["value"] for r in df.collect()}


def test_exploration_report(contacts, contact_rows):
    frame = pd.DataFrame(contact_rows, columns=CONTACT_SCHEMA.names)
    frame["hit"] = (frame["y"] == "yes") * 100.0
    got = lines(reports.exploration_report(contacts))
    assert got[("overall_rate_pct", "yes")] == pytest.approx(frame["hit"].mean(), abs=0.005)
    durations = frame.groupby("y")["duration"].mean()
    for value in ("yes", "no"):
        assert got[("avg_duration", value)] == pytest.approx(durations[value], abs=0.05)
    for insight, column, measure in (
        ("best_education_rate_pct", "education", "hit"),
        ("best_job_avg_balance", "job", "balance"),
        ("best_outcome_rate_pct", "poutcome", "hit"),
    ):
        means = frame.groupby(column)[measure].mean().round(2)
        best = means[means == means.max()].index.min()
        assert got[(insight, best)] == pytest.approx(means[best], abs=0.01)
    assert len(got) == 6


def test_exploration_ties_and_nulls(spark):
    rows = [("yes", 1, 1, "b", "x", "p"), ("yes", 1, 1, "a", "x", "p"), ("yes", 1, 9, None, None, None)]
    df = spark.createDataFrame(
        rows, "y string, duration int, balance int, job string, education string, poutcome string"
    )
    got = lines(reports.exploration_report(df))
    assert got[("best_job_avg_balance", "a")] == 1.0
    assert got[("avg_duration", "no")] is None


def test_exploration_is_one_scan(spark, contacts, tmp_path):
    contacts.write.parquet(str(tmp_path / "c"))
    report = reports.exploration_report(spark.read.parquet(str(tmp_path / "c")))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_modelling_report(spark):
    comparison = spark.createDataFrame(
        [("Random Forest", 0.9, 0.8, 0.7, 0.6, 0.5), ("Logistic Regression", 0.8, 0.9, 0.6, 0.4, 0.3)],
        "model string, auc double, accuracy double, f1 double, precision double, recall double",
    )
    importances = inline_table(
        spark, [(f"f{i}", i / 10) for i in range(8)], "feature string, importance double"
    )
    got = lines(reports.modelling_report(comparison, importances))
    assert got[("champion_auc", "Random Forest")] == 0.9
    assert got[("recall", "Random Forest")] == 0.5
    assert sorted(k for i, k in got if i == "top_feature") == ["f3", "f4", "f5", "f6", "f7"]


def test_streaming_and_final_report(spark, contacts, tmp_path):
    keyed = contacts.coalesce(1).select(F.monotonically_increasing_id().alias("id"), "job", "balance")
    table = replay(disjoint_batches(keyed, "id", 2), "job", "balance", str(tmp_path))
    streaming = reports.streaming_report(table, "job", "avg_balance")
    got = lines(streaming)
    assert got[("total_streamed", "all")] == 240 and got[("batches", "all")] == 2
    assert got[("top_segment_txns", "blue-collar")] == 80

    timings = inline_table(spark, [(1, 0.5), (8, 0.2), (4, 0.2)], "partitions int, time_sec double")
    exploration = reports.exploration_report(contacts)
    final = lines(reports.final_summary(contacts, exploration, streaming, streaming, timings))
    assert final[("rows", "data")] == 240 and final[("columns", "data")] == 17
    assert final[("fastest_partitions", "sweep")] == 4


def test_partition_sizes(contacts):
    sizes = [r["rows"] for r in pt.partition_sizes(pt.spread_evenly(contacts, 6)).collect()]
    assert len(sizes) == 6 and sum(sizes) == 240 and max(sizes) - min(sizes) <= 4


def test_sweep_is_invariant(contacts):
    got = {}
    for r in pt.sweep_results(contacts, ["job", "education"], ["balance", "duration"], pt.SWEEP_COUNTS).collect():
        got.setdefault(r["partitions"], set()).add(
            (r["job"], r["education"], round(r["avg_balance"], 9), round(r["avg_duration"], 9), r["rows"])
        )
    assert sorted(got) == pt.SWEEP_COUNTS
    assert len({frozenset(v) for v in got.values()}) == 1


def test_sweep_timings(contacts):
    timings = pt.sweep_timings(contacts, ["job"], ["balance"], [1, 2], runs=1)
    rows = timings.collect()
    assert [r["partitions"] for r in rows] == [1, 2] and all(r["time_sec"] > 0 for r in rows)
    assert pt.fastest_setting(timings).first()["time_sec"] == min(r["time_sec"] for r in rows)
