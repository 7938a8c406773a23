"""Rows without a class, a label or a key."""

from tidemark.operators.grouping import cross_tab
from tidemark.operators.metrics import classification_scores
from tidemark.operators.ordering import top_rows
from tidemark.operators.sampling import assign_batches, keyed_split


def test_cross_tab_counts_rows_without_a_class(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None)], "k string, c string")
    got = {r["k"]: (r["x"], r["null"]) for r in cross_tab(df, "k", "c").collect()}
    assert got == {"a": (1, 1), "b": (0, 1)}


def test_rows_without_a_label_are_not_evaluated(spark):
    rows = [(1, 1), (0, 0), (None, 1), (None, 0), (1, None)]
    got = classification_scores(spark.createDataFrame(rows, "y int, p int"), "y", "p").first()
    assert (got["rows"], got["accuracy"], got["precision"], got["recall"]) == (2, 1.0, 1.0, 1.0)


def test_a_null_key_is_in_one_part(spark):
    df = spark.createDataFrame([(1,), (None,), (7,), (None,)], "k bigint")
    train, test = keyed_split(df, "k", seed=None)
    assert train.count() + test.count() == 4
    assert assign_batches(df, "k", 5, seed=None).where("batch_no is null").count() == 0


def test_ranking_of_more_than_twelve_segments(spark):
    df = spark.range(20).withColumnRenamed("id", "txn_count")
    assert [r["rank"] for r in top_rows(df, df.count(), "txn_count").orderBy("rank").collect()] == list(range(1, 21))


def test_nan_and_null_are_left_out_of_profiles_and_roc(spark):
    from tidemark.operators import metrics, profile, quantiles

    nan = float("nan")
    rows = [(float(i), float(i % 4), i % 2) for i in range(10)] + [(nan, 1.0, 1), (None, 1.0, 0), (3.0, nan, 1)]
    df = spark.createDataFrame(rows, "v double, w double, y int")
    clean = df.where("v is not null and not isnan(v)")
    for form in (
        lambda d: profile.histogram(d, "v", 4),
        lambda d: profile.density(d, "v", points=5),
        lambda d: profile.box_statistics(d, "v"),
        lambda d: quantiles.quantiles(d, "v", [0.1, 0.5]),
        lambda d: metrics.roc_points(d, "y", "v"),
    ):
        assert sorted(map(str, form(df).collect())) == sorted(map(str, form(clean).collect()))
    cells = profile.binned_pairs(df, "v", "w", "y", 2, 2).collect()
    assert sum(r["count"] for r in cells) == 10


def test_history_looks_backwards(spark):
    from datetime import datetime

    from tidemark.sources.contacts import with_history

    dates = [None, datetime(2020, 1, 3), datetime(2020, 1, 3), datetime(2020, 1, 20), datetime(2020, 5, 1), datetime(2021, 5, 2)]
    rows = [(10 - i if i == 2 else i, 1, "FOP"[i % 3], d) for i, d in enumerate(dates)] + [(50, 2, "F", dates[4]), (51, None, "F", dates[4])]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp")
    got = {r["o_orderkey"]: (r["n_before"], r["last_date"], r["last_status"]) for r in with_history(orders).collect()}
    own = sorted((r for r in rows if r[1] == 1), key=lambda r: (r[3] is not None, r[3] or dates[1], r[0]))
    want = {r[0]: (i, own[i - 1][3] if i else None, own[i - 1][2] if i else None) for i, r in enumerate(own)}
    assert got == want | {50: (0, None, None), 51: (0, None, None)}
