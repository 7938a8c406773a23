"""Quality classifier: n-gram indicators scaled by the classes' log-count ratios, and a linear hinge-loss model over them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, outline_hashes, word_hashes, write_through


def _runs(words: np.ndarray, n: int, kind: int) -> np.ndarray:
    size = max(0, words.size - n + 1)
    out = np.full(size, np.uint64(kind))
    for j in range(n):
        out = mix(out * np.uint64(0x100000001B3) + words[j : j + size])
    return out


def indicators(text: str | None, bits: int) -> np.ndarray:
    """Numbers under ``2 ** bits`` of the n-grams that a text has, each once, in order.

    N-grams are one and two words of the lower-cased text, and one to three
    outlines: a word's outline has its marks, its case and whether it repeats
    the word before, but not its letters.
    """
    if not text:
        return np.empty(0, np.int64)
    words = word_hashes(text)
    outlines = outline_hashes(text)
    if words.size == outlines.size:  # lower case has no other white space, so it always is
        again = np.r_[False, words[1:] == words[:-1]] if words.size else np.empty(0, bool)
        outlines = np.where(again, mix(outlines), outlines)
    grams = [_runs(words, 1, 1), _runs(words, 2, 2), *(_runs(outlines, n, 2 + n) for n in (1, 2, 3))]
    return np.unique((np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int64))


def log_count_ratios(held: np.ndarray, whole: Sequence[float], smoothing: float) -> np.ndarray:
    """Of ``held[class, n-gram]``, the documents of each class with each n-gram, the log of the classes' shares' ratio.

    ``whole`` is each class' sum of smoothed counts over all n-grams.
    """
    return np.log((held[1] + smoothing) / whole[1]) - np.log((held[0] + smoothing) / whole[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], classes: np.ndarray, width: int,
    cost: np.ndarray, rounds: int = 30, least: float = 1e-3, seed: int = 7,
) -> np.ndarray:
    """Weights of the linear model of least squared length plus hinge losses, of ``classes`` 1 and -1.

    Row i has ``values[i]`` at ``rows[i]``, and its loss counts ``cost[i]``. Each
    step solves the dual problem for one row exactly and carries it over into
    the weights. A round takes the rows in another order; it ends when no dual
    gradient is above ``least``, or after ``rounds`` rounds.
    """
    weights, dual = np.zeros(width), np.zeros(len(rows))
    lengths = np.array([float(v @ v) for v in values])
    dice = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in dice.permutation(len(rows)).tolist():
            if not lengths[i]:
                continue
            gradient = classes[i] * float(weights[rows[i]] @ values[i]) - 1.0
            step = min(max(dual[i] - gradient / lengths[i], 0.0), cost[i]) - dual[i]
            if step:
                worst = max(worst, abs(gradient))
                dual[i] += step
                weights[rows[i]] += step * classes[i] * values[i]
        if worst < least:
            break
    return weights


@dataclass
class QualityModel:
    """``weights`` already hold the ratios: a text's margin is the sum over its n-grams, over its length, plus ``bias``."""

    bits: int
    ratios: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Probability-like score: the logistic function of the margin; 0.5 exactly at margin 0."""
        own = indicators(text, self.bits)
        length = float(np.sqrt(np.square(self.ratios[own], dtype=np.float64).sum()))
        margin = self.bias + (float(self.weights[own].sum(dtype=np.float64)) / length if length else 0.0)
        return float(1.0 / (1.0 + np.exp(-2.0 * np.clip(margin, -30, 30))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that labels are not learned from; rows without an id are learned from neither."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """``key, class, text`` of labelled documents outside the fold: at most ``fit_rows`` ids, the first by a hash of the id.

    So many ids, not texts, are sent to the tasks. Ids whose labels disagree, or
    are not 0 or 1, are left out.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    known = known.where("low = high and low in (0, 1)").select("doc_id", F.col("low").cast("int").alias("class"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = docs.where("text is not null").select("doc_id", "text")
    return texts.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id", "text").alias("key"), "class", "text")


def fit_quality(
    docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, bits: int = 18, least_documents: int = 3,
    cost: float = 1.0, smoothing: float = 1.0,
) -> QualityModel:
    """A model of ``labels (doc_id, quality)`` from the texts of ``docs (doc_id, text)`` alone.

    The documented bound: at most ``fit_rows`` labelled documents, whose n-grams
    are counted in Spark tasks and which one task fits. N-grams of fewer than
    ``least_documents`` of them have ratio 0. Both classes count alike in sum.
    The driver gets two counts and one weight for each of ``2 ** bits`` numbers
    at most. Without labelled documents of both classes every score is that of
    the class there is, or 0.5.
    """
    width = 1 << bits

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [indicators(t.as_py(), bits) for t in batch.column(2)]
            ends = np.cumsum([0, *(h.size for h in held)])
            flat = np.concatenate(held).astype(np.int32) if held else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["key", "class", "grams"],
            )

    seen = training_rows(docs, labels, fit_rows).mapInArrow(look, "key long, class int, grams array<int>")
    seen = write_through(seen, "indicators")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, width), np.int64)
        for batch in batches:
            classes, grams = np.asarray(batch.column(1)), batch.column(2)
            each = np.repeat(classes, np.asarray(grams.value_lengths()))
            for c in (0, 1):
                held[c] += np.bincount(np.asarray(grams.flatten())[each == c], minlength=width)
        gram = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int32()), pa.array(held[0][gram]), pa.array(held[1][gram])], names=["gram", "n0", "n1"])

    sums = seen.mapInArrow(count, "gram int, n0 long, n1 long").groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    #: Sizes of the classes over all n-grams, and the n-grams that get a ratio: at most 2 ** bits rows.
    often = sums.where(F.col("n0") + F.col("n1") >= least_documents).withColumns({c: F.col(c).cast("int") for c in ("n0", "n1")})
    whole = sums.agg(F.sum(F.col("n0") + smoothing), F.sum(F.col("n1") + smoothing)).first()
    sizes = dict(seen.groupBy("class").count().collect())
    if len(sizes) < 2:
        bias = 1.0 if 1 in sizes else -1.0 if 0 in sizes else 0.0
        return QualityModel(bits, np.zeros(width, np.float32), np.zeros(width, np.float32), bias)
    counted = often.toPandas()
    ratios = np.zeros(width, np.float32)
    ratios[counted["gram"]] = log_count_ratios(counted[["n0", "n1"]].to_numpy(np.float64).T, whole, smoothing)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        keys, classes, rows = [], [], []
        for batch in batches:
            keys.append(np.asarray(batch.column(0)))
            classes.append(np.asarray(batch.column(1)))
            for grams in batch.column(2):
                own = np.asarray(grams.values)
                rows.append(own[ratio[own] != 0])
        if not rows:
            return
        keys, classes = np.concatenate(keys), np.concatenate(classes)
        order = np.lexsort((classes, keys))
        signs = np.where(classes[order] == 1, 1.0, -1.0)
        places, values = [], []
        for i in order.tolist():
            scaled = ratio[rows[i]].astype(np.float64)
            length = np.sqrt(scaled @ scaled)
            places.append(np.append(rows[i], width))
            values.append(np.append(scaled / length if length else scaled, 1.0))
        share = np.where(signs > 0, (signs > 0).sum(), (signs < 0).sum())
        weights = dual_coordinate_descent(places, values, signs, width + 1, cost * signs.size / (2.0 * share))
        gram = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(weights[gram])], names=["gram", "weight"])

    fitted = seen.coalesce(1).mapInArrow(fit, "gram long, weight double").toPandas()
    weights = np.zeros(width + 1)
    weights[fitted["gram"].to_numpy(np.int64)] = fitted["weight"].to_numpy()
    return QualityModel(bits, ratios, (weights[:width] * ratios).astype(np.float32), float(weights[width]))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs (doc_id, text)``; whole texts are read.

    ``predicted`` is 1 where the score is at least 0.5. Null, empty and wordless
    texts have no n-grams and get the score of the model's bias. Equal rows get
    a row each, equal texts equal scores; a null id is not held out. An empty
    table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    out = docs.select("doc_id", held_out().alias("held_out"), scored("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """:func:`score_quality` of ``docs`` by a model that :func:`fit_quality` learns from ``labels``."""
    return score_quality(docs, fit_quality(docs, labels, **settings))
