import pytest
from pyspark.sql import functions as F

from tidemark.operators import grouping as g
from tidemark.operators.ordering import best_row, calendar_order, sort_descending, top_rows


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [("a", 1.0, "yes"), ("a", 2.0, "no"), ("b", 4.0, "yes"), (None, 3.0, "no"), ("b", None, "yes")],
        "k string, v double, y string",
    )


def test_segment_summary_with_null_key_and_measure(small):
    got = as_dict(g.segment_summary(small, "k", "v", F.col("y") == "yes"))
    assert got == {"a": (1.5, 2, 1), "b": (4.0, 2, 2), None: (3.0, 1, 0)}


def test_rates(small):
    assert as_dict(g.rate_by(small, "k", F.col("y") == "yes")) == {
        "a": (50.0, 2), "b": (100.0, 2), None: (0.0, 1)
    }
    assert g.overall_rate(small, F.col("y") == "yes").first()[0] == pytest.approx(60.0)


def test_empty_frame(small):
    empty = small.limit(0)
    assert g.row_count(empty).first()[0] == 0
    assert g.segment_summary(empty, "k", "v", F.col("y") == "yes").count() == 0
    assert g.overall_rate(empty, F.col("y") == "yes").first()[0] is None
    assert g.share_of_total(empty, "k").count() == 0


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([("a", 1.005), ("b", 1.025)], "k string, v double")
    assert as_dict(g.average_by(df, "k", "v", digits=2)) == {"a": (1.01,), "b": (1.03,)}


def test_average_for_value(small):
    assert tuple(g.average_for_value(small, "y", "v", ["yes", "no"]).first()) == (2.5, 2.5)


def test_category_and_distinct_counts(small):
    counts = {tuple(r)[:2]: r[2] for r in g.category_counts(small, ["k", "y"]).collect()}
    assert counts == {("k", "a"): 2, ("k", "b"): 2, ("k", None): 1, ("y", "yes"): 3, ("y", "no"): 2}
    assert as_dict(g.distinct_counts(small, ["k", "y"])) == {"k": (3,), "y": (2,)}
    assert as_dict(g.distinct_counts(small, ["k", "y"], 0.01)) == {"k": (3,), "y": (2,)}


def test_cross_tab_fills_zero(small):
    want = {"a": (1, 1), "b": (0, 2), None: (1, 0)}
    assert as_dict(g.cross_tab(small, "k", "y", ["no", "yes"])) == want
    assert as_dict(g.cross_tab(small, "k", "y")) == want


def test_cross_tab_refuses_too_many_values(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        with pytest.raises(ValueError):
            g.cross_tab(spark.range(20).withColumn("k", F.lit(1)), "k", "id")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_shares_sum_to_hundred(contacts):
    shares = g.share_of_total(contacts, "job", digits=6).collect()
    assert sum(r["share_pct"] for r in shares) == pytest.approx(100)


def test_mean_of_means_and_weighted_mean(spark):
    segments = spark.createDataFrame([("a", 1, 10.0), ("b", 9, 20.0)], "k string, n bigint, m double")
    assert tuple(g.roll_up_segments(segments, "n", "m").first()) == (10, 15.0, 19.0)


def test_snapshots_and_peak(spark):
    a = spark.createDataFrame([(1, 5)], "batch int, total int")
    b = spark.createDataFrame([(9, 2)], "total int, batch int")
    history = g.append_snapshots(a, b)
    assert sorted(map(tuple, history.collect())) == [(1, 5), (2, 9)]
    assert g.history_peak(history, "total").first()["peak"] == 9


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_results_do_not_depend_on_partitions(contacts, parts):
    want = as_dict(g.segment_summary(contacts, "job", "balance", F.col("y") == "yes"))
    moved = contacts.repartition(parts)
    assert as_dict(g.segment_summary(moved, "job", "balance", F.col("y") == "yes")) == want


def test_order_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("c", 2), ("b", 5), ("a", 5), ("d", 1)], "k string, n int")
    assert [r["k"] for r in sort_descending(df, "n", "k").collect()] == ["a", "b", "c", "d"]
    assert [(r["k"], r["rank"]) for r in top_rows(df, 3, "n", "k").orderBy("rank").collect()] == [
        ("a", 1), ("b", 2), ("c", 3)
    ]
    assert best_row(df, "n", "k").first()["k"] == "a"
    assert best_row(df, "n", "k", lowest=True).first()["k"] == "d"


def test_calendar_order_puts_unknown_last(spark):
    df = spark.createDataFrame([("dec",), ("jan",), ("odd",), ("may",)], "month string")
    rows = calendar_order(df, "month").collect()
    assert [r["month"] for r in rows] == ["jan", "may", "dec", "odd"]
    assert rows[-1]["month_no"] is None
