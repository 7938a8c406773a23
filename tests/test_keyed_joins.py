import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyed_joins as kj


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_sums(spark, by, descending):
    # group 0 holds two thirds of the rows, one group is null
    data = [(None if i % 7 == 1 else int(i % 3 == 1), float((i * 7919) % 1009), i % 5) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, x double, v int").repartition(6)
    rows = kj.running_sums(df, "x", ["v"], by, descending).collect()
    assert len(rows) == len(data)
    sums = {}
    for k, x, v in sorted(data, key=lambda r: -r[1] if descending else r[1]):
        group = k if by else 0
        sums[x] = sums.get(("all", group), 0)
        sums["all", group] = sums[x] + v
    for r in rows:
        assert r["v_before"] == sums[r["x"]]
        assert r["v_total"] == sums["all", r["k"] if by else 0]


def test_running_sums_deal_a_crowd_of_small_values_to_several_tasks(spark):
    crowd = spark.range(20_000).select((F.col("id") * 1e-12).alias("x"), F.lit(1).alias("v"))
    df = crowd.union(spark.createDataFrame([(0.0155, 1)], "x double, v int"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = df.repartitionByRange(F.asc("x")).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in ranged) <= 3 * 20_001 / parts
    assert kj.running_sums(df, "x", ["v"]).where("v_before = 20000").first()["x"] == 0.0155


def test_attach_matches_null_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    facts = spark.createDataFrame([("a", 10), (None, 20)], "k string, f int")
    got = {tuple(r) for r in kj.attach(rows, facts, ["k"]).collect()}
    assert got == {("a", 1, 10), (None, 2, 20)}
    kept = {tuple(r) for r in kj.attach(rows, facts, ["k"], "left").collect()}
    assert kept == got | {("b", 3, None)}


def test_attach_without_keys_adds_constants(spark):
    rows = spark.range(3)
    one = kj.settle(spark.range(1).select(F.lit(7).alias("f")), bounded=True)
    assert {tuple(r) for r in kj.attach(rows, one, []).collect()} == {(0, 7), (1, 7), (2, 7)}
    assert kj.attach(rows, one.where("f > 7"), []).collect() == []
