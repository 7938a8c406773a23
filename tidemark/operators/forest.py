"""Spark's random forest, trained over blocks of binned rows so that hardly anything is kept between levels."""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# What tasks run is sent to them as it is: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 16_384
#: Rows that thresholds are taken from, as Spark's trainer does; more for many bins.
SAMPLE_ROWS = 10_000
#: How often a row is in a tree's bag, by 16 random bits: Poisson with mean 1.
_CHANCE = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_BAG = np.searchsorted(_CHANCE, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
_BLOCK = "part int, place long, n int, labels binary, bins binary"
_SPLIT = "tree int, node int, stats array<double>, feature int, cut int, gain double, lower array<double>"
_NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
])


class BinnedForest(RandomForestClassifier):
    """Spark's estimator with its own training; the result is Spark's model (without a training summary).

    Spark's trainer keeps every row with its bins and its count in each bag, and
    several generations of its node in each tree: over 1 KB a row for 100 trees.
    Here rows are written once as blocks of bins, a byte a feature. Bags are
    drawn anew in every pass from the place of a block, and nodes are found by
    walking the trees. A level is one scan for all trees (for as many as
    ``maxMemoryInMB`` allows, at deep levels): tasks add up class counts by node, feature
    and bin, and each tree's best splits are chosen in a shuffle by tree.

    Thresholds, feature subsets of a node, Gini gain, the limits on nodes and the
    merging of leaves that predict alike are those of Spark's trainer, random
    draws are not. Parameters that this does not know (:meth:`known`), and tables
    that cannot be trained on, go to Spark's trainer.
    """

    def known(self, dataset: DataFrame) -> bool:
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        return (
            self.getImpurity() == "gini" and self.getBootstrap() and self.getSubsamplingRate() == 1
            and self.getFeatureSubsetStrategy() in ("auto", "sqrt") and not (self.isDefined("weightCol") and self.getWeightCol())
            and self.getMinWeightFractionPerNode() == 0 and 0 < self.getMaxDepth() <= 16 and self.getMaxBins() <= 256
            and not attributes.get("nominal")
        )

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        label = F.col(self.getLabelCol()).cast("double")
        bad = label.isNull() | F.isnan(label) | (label < 0) | (label != F.floor(label)) | (label > 255) | F.col(self.getFeaturesCol()).isNull()
        n, top, wrong = dataset.agg(F.count(F.lit(1)), F.max(label), F.count_if(bad)).first()
        if not n or wrong or not self.known(dataset):
            return super()._fit(dataset)
        classes, seed = max(2, int(top) + 1), self.getSeed() % 2**64
        vectors = dataset.select(label.alias("label"), vector_to_array(self.getFeaturesCol()).alias("values"))
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        cuts = thresholds(vectors, n, self.getMaxBins(), self.getSeed(), {a["idx"] for a in attributes.get("binary", [])})
        path = scratch_path(dataset.sparkSession, "forest")
        blocks(vectors, cuts).write.option("compression", "zstd").parquet(path)
        kept = dataset.sparkSession.read.schema(_BLOCK).parquet(path)
        every = self.getFeatureSubsetStrategy() == "auto" and self.getNumTrees() == 1
        slots = len(cuts) if every else math.ceil(math.sqrt(len(cuts)))
        trees = grow(
            kept, cuts, classes, self.getNumTrees(), self.getMaxDepth(), slots, seed,
            self.getMinInstancesPerNode(), self.getMinInfoGain(), self.getMaxMemoryInMB() << 20,
        )
        return self._copyValues(self._model(dataset, trees, cuts, classes))

    def _model(self, dataset: DataFrame, trees: list[dict], cuts: list[np.ndarray], classes: int) -> RandomForestClassificationModel:
        """The trees in the form that Spark's model is saved in, loaded."""
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, "model")
        about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "paramMap": {"impurity": "gini", "maxDepth": self.getMaxDepth()}, "defaultParamMap": {}}
        whole = about | {
            "class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "uid": self.uid,
            "numFeatures": len(cuts), "numClasses": classes, "numTrees": len(trees), "paramMap": about["paramMap"] | {"numTrees": len(trees)},
        }
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        part = about | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel"}
        rows = [(t, json.dumps(part | {"uid": f"dtc_{uuid.uuid4().hex[:12]}"}), 1.0) for t in range(len(trees))]
        spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        nodes = [(t, node) for t, tree in enumerate(trees) for node in node_rows(tree, cuts)]
        table = pa.table({"treeID": pa.array([t for t, _ in nodes], pa.int32()), "nodeData": pa.array([x for _, x in nodes], _NODE)})
        spark.createDataFrame(table).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


def gini(stats: np.ndarray) -> np.ndarray:
    """Along the last axis; 0 without rows."""
    n = stats.sum(-1, keepdims=True)
    return np.where(n[..., 0] > 0, 1 - ((stats / np.maximum(n, 1)) ** 2).sum(-1), 0.0)


def thresholds(vectors: DataFrame, n: int, bins: int, seed: int, binary: set[int]) -> list[np.ndarray]:
    """Per feature the values that part its bins: all midpoints, or those nearest to equal shares of a sample."""
    share = min(1.0, max(bins * bins, SAMPLE_ROWS) / n)
    sample = vectors.select("values") if share == 1 else vectors.select("values").sample(False, share, seed)
    lists = sample.toArrow().column(0).combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    return [np.array([0.5]) if f in binary else feature_thresholds(values[:, f], min(bins, n) - 1) for f in range(values.shape[1])]


def feature_thresholds(sample: np.ndarray, most: int) -> np.ndarray:
    values, counts = np.unique(sample, return_counts=True)
    middle = (values[:-1] + values[1:]) / 2
    if middle.size <= most:
        return middle
    stride, upto = sample.size / (most + 1), np.cumsum(counts)
    chosen, target = [], stride
    for before, after, cut in zip(upto[:-1], upto[1:], middle, strict=True):
        if abs(before - target) < abs(after - target):
            chosen.append(cut)
            target += stride
    return np.array(chosen)


def blocks(vectors: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Rows as blocks ``part, place, n, labels, bins``: bins are bytes, feature by feature. ``part, place`` name a block."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(start, BLOCK_ROWS)
                n = some.num_rows
                values = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                if not np.isfinite(values).all():
                    raise ValueError("features must not be NaN or infinite")
                held = b"".join(np.searchsorted(cut, values[:, f]).astype(np.uint8).tobytes() for f, cut in enumerate(cuts))
                labels = some.column(0).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([n], pa.int32()),
                     pa.array([labels], pa.binary()), pa.array([held], pa.binary())],
                    names=["part", "place", "n", "labels", "bins"],
                )
                place += n

    return vectors.mapInArrow(binned, _BLOCK)


def bags(seed: int, part: int, place: int, trees: int, n: int) -> np.ndarray:
    """How often each row of a block is in the bag of each tree."""
    return _BAG[np.random.default_rng([seed, part, place]).integers(0, 1 << 16, (trees, n), np.uint16)]


def subsets(seed: int, level: int, tree: int, features: int, slots: int) -> np.ndarray:
    """The features that each node of a level may be split by."""
    drawn = np.random.default_rng([seed, level, tree, 1]).random((1 << level, features))
    return np.sort(drawn.argpartition(slots - 1, axis=1)[:, :slots], axis=1)


def grow(
    kept: DataFrame, cuts: list[np.ndarray], classes: int, trees: int, depth: int, slots: int, seed: int,
    least_rows: int, least_gain: float, memory: int,
) -> list[dict]:
    """Per tree its nodes by number (root 1, children 2i and 2i + 1): class counts, and feature, cut and gain where it is split."""
    sizes = np.array([cut.size + 1 for cut in cuts]) * classes
    out: list[dict] = [{} for _ in range(trees)]
    feature = np.zeros((trees, 2 << depth), np.int16)
    cut = np.full((trees, 2 << depth), 255, np.uint8)  # what is no inner node sends its rows on to the left
    live = [np.array([1]) for _ in range(trees)]
    for level in range(depth):
        plans = {}
        for t in range(trees):
            if live[t].size:
                chosen = subsets(seed, level, t, len(cuts), slots)[live[t] - (1 << level)]
                width = sizes[chosen].ravel()
                plans[t] = (live[t], chosen, (np.cumsum(width) - width).reshape(chosen.shape), int(width.sum()))
            live[t] = np.array([], np.int64)
        for group in _groups(plans, memory):
            walked = {t: (feature[t, : 1 << level].copy(), cut[t, : 1 << level].copy()) for t in group}
            for r in level_splits(kept, {t: plans[t] for t in group}, walked, level, cuts, classes, trees, seed, least_rows, least_gain):
                tree, node, stats = out[r["tree"]], r["node"], np.array(r["stats"])
                tree[node] = {"stats": stats}
                if r["feature"] is None:
                    continue
                tree[node] |= {"feature": r["feature"], "cut": r["cut"], "gain": r["gain"]}
                feature[r["tree"], node], cut[r["tree"], node] = r["feature"], r["cut"]
                lower = np.array(r["lower"])
                for child, own in ((2 * node, lower), (2 * node + 1, stats - lower)):
                    tree[child] = {"stats": own}
                    if level + 1 < depth and gini(own) > 0:
                        live[r["tree"]] = np.append(live[r["tree"]], child)
        live = [np.sort(nodes) for nodes in live]
        if not any(nodes.size for nodes in live):
            break
    return out


def _groups(plans: dict, memory: int) -> Iterator[list[int]]:
    """Trees whose counts fit into ``memory`` together, one at least."""
    group, held = [], 0
    for t, (*_, width) in plans.items():
        if group and held + 8 * width > memory:
            yield group
            group, held = [], 0
        group.append(t)
        held += 8 * width
    if group:
        yield group


def level_splits(kept, plans, walked, level, cuts, classes, trees, seed, least_rows, least_gain) -> list:
    """Per live node of the trees in ``plans`` its class counts and its best split, if it has one."""
    features, first = len(cuts), 1 << level
    context = kept.sparkSession.sparkContext
    shared = context.broadcast((plans, walked))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans, walked = shared.value
        sums = {t: np.zeros(plan[3], np.int64) for t, plan in plans.items()}
        # Each node's place in the plan, those without one last.
        order = {t: np.full(first, -1) for t in plans}
        for t, plan in plans.items():
            order[t][plan[0] - first] = np.arange(plan[0].size)
        seen = False
        for batch in batches:
            for part, place, n, labels, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen = True
                bins = np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(features, n).T).ravel()
                label = np.frombuffer(labels, np.uint8)
                drawn = bags(seed, part, place, trees, n)
                for t, (_, chosen, offsets, width) in plans.items():
                    rows = np.flatnonzero(drawn[t])
                    at, node = rows * features, np.ones(rows.size, np.int64)
                    for _ in range(level):
                        node = 2 * node + (bins.take(at + walked[t][0].take(node)) > walked[t][1].take(node))
                    spot = order[t].take(node - first)
                    if spot.size and spot.min() < 0:
                        lives = spot >= 0
                        rows, at, spot = rows[lives], at[lives], spot[lives]
                    cell = bins.take(at[:, None] + chosen.take(spot, 0)).astype(np.int64)
                    cell *= classes
                    cell += offsets.take(spot, 0)
                    cell += label.take(rows)[:, None]
                    weight = np.repeat(drawn[t].take(rows).astype(np.float64), chosen.shape[1])
                    sums[t] += np.bincount(cell.ravel(), weight, width).astype(np.int64)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["tree", "sums"]
            )

    def choose(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        nodes, chosen, offsets, width = shared.value[0][tree]
        total = np.zeros(width, np.int64)
        for held in table.column("sums"):
            total += np.frombuffer(held.as_buffer(), np.int64)
        best, split = np.zeros(nodes.size), np.full((nodes.size, 2), -1)
        stats, lowest = np.zeros((nodes.size, classes)), np.zeros((nodes.size, classes))
        for f in np.unique(chosen).tolist():
            which, slot = np.nonzero(chosen == f)
            cells = offsets[which, slot][:, None] + np.arange((cuts[f].size + 1) * classes)
            lower = np.cumsum(total[cells].reshape(which.size, -1, classes), 1, dtype=np.float64)
            stats[which] = whole = lower[:, -1]
            lower = lower[:, :-1]
            if not lower.shape[1]:
                continue
            upper = whole[:, None] - lower
            low, high = lower.sum(2), upper.sum(2)
            gain = gini(whole)[:, None] - (low * gini(lower) + high * gini(upper)) / np.maximum(whole.sum(1), 1)[:, None]
            gain[(low < least_rows) | (high < least_rows) | (gain < least_gain)] = -1
            k = gain.argmax(1)
            found = gain[np.arange(which.size), k]
            better = found > best[which]
            at, k = which[better], k[better]
            best[at], split[at, 0], split[at, 1], lowest[at] = found[better], f, k, lower[better, k]
        rows = [
            (tree, node, own, *((f, k, gain, low) if f >= 0 else [None] * 4))
            for node, own, (f, k), gain, low in zip(nodes.tolist(), stats.tolist(), split.tolist(), best.tolist(), lowest.tolist(), strict=True)
        ]
        types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64())]
        names = ["tree", "node", "stats", "feature", "cut", "gain", "lower"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    # A number of partitions that is named is not coalesced: the few small rows of a tree are much work.
    counted = kept.mapInArrow(count, "tree int, sums binary").repartition(min(len(plans), context.defaultParallelism), "tree")
    out = counted.groupBy("tree").applyInArrow(choose, _SPLIT).collect()
    shared.destroy()
    return out


def node_rows(tree: dict, cuts: list[np.ndarray]) -> list[dict]:
    """A tree's nodes in Spark's order. Two leaves that predict the same become one."""
    guess = {i: int(x["stats"].argmax()) for i, x in tree.items()}
    inner = {i for i, x in tree.items() if "feature" in x}
    for i in sorted(inner, reverse=True):
        if not {2 * i, 2 * i + 1} & inner and guess[2 * i] == guess[2 * i + 1]:
            inner.discard(i)
    rows: list[dict] = []

    def add(i: int) -> int:
        at, own = len(rows), tree[i]
        row = {
            "id": at, "prediction": float(guess[i]), "impurity": float(gini(own["stats"])), "impurityStats": own["stats"].tolist(),
            "rawCount": int(own["stats"].sum()), "gain": -1.0, "leftChild": -1, "rightChild": -1,
            "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1},
        }
        rows.append(row)
        if i in inner:
            row["gain"] = own["gain"]
            row["split"] = {"featureIndex": own["feature"], "leftCategoriesOrThreshold": [float(cuts[own["feature"]][own["cut"]])], "numCategories": -1}
            row["leftChild"], row["rightChild"] = add(2 * i), add(2 * i + 1)
        return at

    add(1)
    return rows
