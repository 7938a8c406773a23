import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import global_order as g
from tidemark.operators import sketches as sk
from tidemark.operators import snapshots as sn


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one value; some are null; ranges begin inside a value."""
    values = [7] * 200 + [None] * 40 + [i % 50 for i in range(360)]
    return spark.createDataFrame(list(enumerate(values)), "id long, v int").repartition(7)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_ranks_equal_a_window_over_everything(spark, skewed, descending, partitions):
    from pyspark.sql import Window

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(g.number_rows(skewed, "v", ["id"], tiles=17, descending=descending))
        along = F.desc("v") if descending else F.asc("v")
        by_value, by_row = Window.orderBy(along), Window.orderBy(along, "id")
        want = skewed.select(
            "id", "v", F.row_number().over(by_row), F.rank().over(by_value), F.dense_rank().over(by_value), F.ntile(17).over(by_row)
        )
        assert got == rows(want)
        previous = skewed.select("id", "v", F.lag("v").over(Window.orderBy("v", "id")))
        assert rows(g.previous_value(skewed, ["v", "id"], "v")) == rows(previous)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranks_of_few_and_no_rows(spark):
    two = spark.createDataFrame([(1, 5), (2, 5)], "id long, v int")
    assert rows(g.number_rows(two, "v", ["id"], tiles=4)) == [(1, 5, 1, 1, 1, 1), (2, 5, 2, 1, 1, 2)]
    assert g.number_rows(two.limit(0), "v", ["id"], tiles=4).count() == 0
    assert g.previous_value(two.limit(0), ["id"], "v").count() == 0


def test_no_window_over_all_rows(skewed):
    plan = g.number_rows(skewed, "v", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_snapshots(spark):
    schema = "k int, v string"
    old = [(1, "a"), (1, "a"), (2, None), (2, None), (3, "c"), (None, "n"), (5, "e")]
    new = [(1, "a"), (2, None), (2, None), (3, "d"), (None, "n"), (None, "n"), (6, "f")]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    x, y = Counter(old), Counter(new)
    want = [(*r, "added", n) for r, n in (y - x).items()] + [(*r, "removed", n) for r, n in (x - y).items()]
    assert rows(sn.multiset_difference(a, b.select("v", "k"))) == sorted(want, key=str)
    assert rows(sn.multiset_intersection(a, b)) == sorted([(*r, n) for r, n in (x & y).items()], key=str)
    assert rows(sn.changed_keys(a, b, ["k"])) == sorted(
        [(1, "changed", 1, 0), (3, "changed", 1, 1), (None, "changed", 0, 1), (5, "removed", 1, 0), (6, "added", 0, 1)], key=str
    )
    assert sn.multiset_difference(a, a).count() == 0 and sn.multiset_difference(a.limit(0), b.limit(0)).count() == 0
    assert rows(sn.multiset_difference(a.limit(0), b)) == sorted([(*r, "added", n) for r, n in y.items()], key=str)
    with pytest.raises(ValueError):
        sn.multiset_difference(a, b.withColumnRenamed("v", "w"))


def test_distinct_in_a_group_of_a_third_of_the_rows(spark):
    data = [("hot", i % 500) for i in range(1000)] + [(f"k{i % 40}", i % 7) for i in range(1000)] + [(None, None), ("hot", None)]
    df = spark.createDataFrame(data, "k string, v int")
    want = df.groupBy("k").agg(F.count("*"), F.count_distinct("v"))
    got = sk.distinct_in_groups(df, ["k"], "v")
    assert rows(got.drop("top_times")) == rows(want)
    top = {r["k"]: r["top_times"] for r in got.collect()}
    assert top["hot"] == 2 and top[None] == 0
    assert sk.distinct_in_groups(df.limit(0), ["k"], "v").count() == 0


def test_partial_rows_of_a_hot_group_are_dealt_by_key_and_value(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(10)], "k long, v long")
    plan = sk.distinct_in_groups(df, ["k"], "v")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(k#\d+L?, v#\d+L?", text)


def test_merged_states_keep_their_error(spark):
    data = spark.range(20_000).selectExpr("id % 9 as batch", "id % 3 as k", "xxhash64(id) % 6000 as v", "cast(id as double) as x")
    states = sk.batch_sketches(data, ["batch", "k"], "v", "x")
    merged = sk.merge_sketches(states.where("batch < 5").unionByName(states.where("batch >= 5")), ["k"])
    exact = {r["k"]: r for r in data.groupBy("k").agg(F.count_distinct("v").alias("d"), F.count("*").alias("n")).collect()}
    for r in sk.read_sketches(merged, ["k"]).collect():
        assert r["n_rows"] == exact[r["k"]]["n"]
        assert abs(r["n_distinct"] - exact[r["k"]]["d"]) <= 3 * 1.04 / 64 * exact[r["k"]]["d"]
        assert all(abs(q - p * 20_000) <= 0.03 * 20_000 for q, p in zip(r["quantiles"], (0.25, 0.5, 0.75), strict=True))
    odd = spark.createDataFrame([(1, None, None), (1, 4, None)], "k int, v int, x double")
    one = sk.read_sketches(sk.merge_sketches(sk.batch_sketches(odd, ["k"], "v", "x"))).first()
    assert one["n_rows"] == 2 and one["n_distinct"] == 1 and one["quantiles"] is None
    assert sk.merge_sketches(sk.batch_sketches(odd.limit(0), ["k"], "v", "x"), ["k"]).count() == 0
