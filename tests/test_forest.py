import math
import os

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.operators import forest as fo
from tidemark.operators import models as mo
from tidemark.operators.metrics import exact_auc


@pytest.fixture(scope="module")
def rows(spark):
    """Three columns that tell the label (one by its square), three that do not."""
    n = F.col("id")
    table = spark.range(6000, numPartitions=3).select(
        (n % 97).cast("double").alias("a"), ((n * 37) % 101 - 50.0).alias("b"), (n % 2).cast("double").alias("c"),
        ((n * 7919) % 1009).cast("double").alias("d"), F.lit(3.0).alias("e"), ((n * 31) % 13).cast("double").alias("f"),
    )
    label = ((F.col("a") > 60) | (F.col("b") * F.col("b") > 1600)) & ((F.col("c") == 1) | (F.col("d") > 200))
    table = table.withColumn("label", label.cast("double"))
    return VectorAssembler(inputCols=list("abcdef"), outputCol="features").transform(table).select("label", "features").cache()


def nodes(spark, model, path):
    model.save(path)
    out = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        out.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    return out


def test_nodes_hold_what_the_bags_send_to_them(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(fo, "BLOCK_ROWS", 500)
    model = fo.BinnedForest(labelCol="label", featuresCol="features", numTrees=4, maxDepth=4, seed=-5, minInstancesPerNode=20).fit(rows)
    vectors = rows.select("label", fo.vector_to_array("features").alias("values"))
    cuts = fo.thresholds(vectors, 6000, 32, -5, set())
    assert [c.size for c in cuts] == [31, 31, 1, 31, 0, 12]
    held = fo.blocks(vectors, cuts).collect()
    assert sum(r["n"] for r in held) == 6000 and max(r["n"] for r in held) == 500
    # Blocks come in the order of the rows.
    bags = np.concatenate([fo.bags(-5 % 2**64, r["part"], r["place"], 4, r["n"]) for r in held], axis=1)
    values = np.array([r["values"] for r in vectors.collect()])
    label = np.array([r["label"] for r in rows.select("label").collect()]).astype(int)
    for t, tree in nodes(spark, model, str(tmp_path / "m")).items():
        assert len(tree) > 3

        def check(at, inside):
            node = tree[at]
            stats = [float(bags[t][inside & (label == c)].sum()) for c in (0, 1)]
            assert node["impurityStats"] == stats and node["rawCount"] == sum(stats) >= 20
            assert node["prediction"] == float(stats[1] > stats[0])
            if node["leftChild"] < 0:
                return
            f, (cut,) = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"]
            left = inside & (values[:, f] <= cut)
            check(node["leftChild"], left)
            check(node["rightChild"], inside & ~left)

        check(0, np.ones(6000, bool))

        # The root is split by the best of the features it was given.
        def gain(f, cut):
            def impurity(part):
                n = bags[t][part].sum()
                return n * (1 - sum((bags[t][part & (label == c)].sum() / n) ** 2 for c in (0, 1)))

            left = values[:, f] <= cut
            return (impurity(left | ~left) - impurity(left) - impurity(~left)) / bags[t].sum()

        given = fo.subsets(-5 % 2**64, 0, t, 6, 3)[0]
        best = max((gain(f, cut), -f, cut) for f in given for cut in cuts[f])
        assert (tree[0]["gain"], tree[0]["split"]["featureIndex"]) == (pytest.approx(best[0]), -best[1])


def test_forest_is_as_good_as_that_of_sparks_trainer(rows, tmp_path):
    settings = {"labelCol": "label", "featuresCol": "features", "numTrees": 30, "maxDepth": 6, "seed": 3}
    own, other = fo.BinnedForest(**settings).fit(rows), RandomForestClassifier(**settings).fit(rows)
    assert isinstance(own, RandomForestClassificationModel) and own.getNumTrees == 30 == len(own.trees)
    assert own.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray(), abs=0.1)
    assert 0.7 < own.totalNumNodes / other.totalNumNodes < 1.4

    def auc(model):
        return exact_auc(model.transform(rows).select("label", fo.vector_to_array("probability")[1].alias("p")), "label", "p").first()[0]

    assert auc(own) > 0.95 and abs(auc(own) - auc(other)) < 0.02
    own.save(str(tmp_path / "own"))
    again = RandomForestClassificationModel.load(str(tmp_path / "own"))
    assert again.featureImportances == own.featureImportances and auc(again) == auc(own)


def test_forest_keeps_a_byte_or_less_a_feature(spark, rows):
    """Spark's trainer keeps each row's count in each bag and its node in each tree: over 1 KB a row for 100 trees."""
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    mo.random_forest(100, 3).fit(rows)
    new = set(os.listdir(folder)) - before
    kept = [os.path.getsize(f"{folder}/{d}/{x}") for d in new if "forest" in d for x in os.listdir(f"{folder}/{d}") if x.endswith(".parquet")]
    assert kept and sum(kept) / 6000 <= 7
    assert not any("bagged" in (r.name() or "") for r in spark.sparkContext._jsc.getPersistentRDDs().values())


def test_trees_that_do_not_fit_into_memory_together_take_several_passes(rows):
    plans = {t: (None, None, None, 100) for t in range(5)}
    assert list(fo._groups(plans, 1700)) == [[0, 1], [2, 3], [4]] and list(fo._groups(plans, 1)) == [[t] for t in range(5)]
    forest = fo.BinnedForest(labelCol="label", featuresCol="features", numTrees=3, maxDepth=3, seed=1)
    whole = forest.fit(rows).toDebugString.split("\n", 1)[1]
    parted = forest.copy({forest.maxMemoryInMB: 0}).fit(rows).toDebugString.split("\n", 1)[1]
    assert whole == parted


def test_bag_counts_are_poisson():
    counts = np.bincount(fo.bags(7, 0, 0, 50, 20_000).ravel()) / 1e6
    assert counts[:5] == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(5)], abs=2e-3)


def test_what_the_trainer_does_not_know_goes_to_sparks(spark, rows):
    forest = fo.BinnedForest(labelCol="label", featuresCol="features", numTrees=2, maxDepth=2, seed=1)
    assert forest.known(rows)
    other = forest.copy({forest.subsamplingRate: 0.5})
    assert not other.known(rows) and other.fit(rows).getNumTrees == 2
    with pytest.raises(Exception):  # noqa: B017
        forest.fit(rows.limit(0))
    with pytest.raises(Exception):  # noqa: B017
        forest.fit(rows.withColumn("label", F.lit(0.5)))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_random_forest_query_trains_over_blocks(spark):
    assert_blocks(spark, "i8_random_forest", 4)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_model_comparison_query_trains_its_forest_over_blocks(spark):
    assert_blocks(spark, "i16_model_comparison", 6)


def assert_blocks(spark, query, rows):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    assert contract.queries()[query](spark, "/root/testdata/sf0.001").count() == rows
    assert sum("tidemark-forest" in d for d in set(os.listdir(folder)) - before) == 1
