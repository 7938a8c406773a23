"""Hard negatives by slots: the upper limits of an anchor's positives part the scores, and each slot keeps its best rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import write_through

#: Scores stay within this, so that they fit a long.
_MOST = 2**63 - 1


def scaled_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """``id, label, vector`` of the rows that may take part, the vector as whole numbers ``floor(scale * x)``.

    Rows with a null label, a null vector, or a null or non-finite component are
    left out. What is beyond a long is held at its limit. An empty vector stays.
    """
    x = F.col(vector)
    sound = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(F.col(label).isNotNull() & x.isNotNull() & sound).select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("vector"),
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones filled up with zeros."""
    values = column.combine_chunks()
    sizes = np.asarray(values.value_lengths())
    flat = np.asarray(values.flatten())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _widest(*columns: pa.ChunkedArray) -> int:
    return max((int(np.max(c.combine_chunks().value_lengths(), initial=0)) for c in columns), default=0)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products of the rows of ``a`` and ``b``, held within a long."""
    top = [max((abs(int(x.min())), abs(int(x.max())))) if x.size else 0 for x in (a, b)]
    if a.shape[1] * top[0] * top[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return np.clip(a.astype(object) @ b.T.astype(object), -_MOST, _MOST).astype(np.int64)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best allowed scores of each row; of equal scores those of lower columns."""
    if scores.shape[1] > k:
        held = np.where(allowed, scores, -_MOST)
        allowed = allowed & (scores >= np.partition(held, -k, axis=1)[:, -k, None])
    rows, columns = np.nonzero(allowed)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(rows.size) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


Pick = Callable[[np.ndarray, np.ndarray, pa.Table], list[tuple[np.ndarray, np.ndarray, int]]]


def _cells(anchors: DataFrame, rows: DataFrame, pick: Pick, blocks: int, parts: int, at_once: int) -> DataFrame:
    """``anchor, slot, score, id, key`` of what ``pick`` takes in each cell of a block of anchors and a part of the rows.

    A cell is one group of bounded size: each block of anchors goes to every
    part of the rows, each row to every block of anchors. No cell sees a whole side.
    """

    def run(block: pa.Table, part: pa.Table) -> pa.Table:
        if not block.num_rows or not part.num_rows:
            return _NONE
        ids = part.column("id").combine_chunks()
        none = np.asarray(ids.is_null())
        order = np.lexsort((np.asarray(part.column("key")), np.asarray(ids.fill_null(0)), none))
        part = part.take(pa.array(order))
        width = _widest(block.column("vector"), part.column("vector"))
        own, other = _matrix(block.column("vector"), width), _matrix(part.column("vector"), width)
        own_label, other_label = np.asarray(block.column("label")), np.asarray(part.column("label"))
        own_key, other_key = np.asarray(block.column("key")), np.asarray(part.column("key"))
        out = {name: [] for name in ("anchor", "slot", "score", "place")}
        for low in range(0, block.num_rows, at_once):
            some = slice(low, low + at_once)
            scores = inner_products(own[some], other)
            alike = own_label[some, None] == other_label[None, :]
            itself = own_key[some, None] == other_key[None, :]
            for slot, (r, c) in pick(scores, alike & ~itself, ~alike, block.slice(low, at_once)):
                out["anchor"].append(own_key[some][r])
                out["slot"].append(np.full(r.size, slot, np.int32))
                out["score"].append(scores[r, c])
                out["place"].append(c)
        if not out["anchor"]:
            return _NONE
        got = {name: np.concatenate(values) for name, values in out.items()}
        place = pa.array(got["place"])
        return pa.table({
            "anchor": got["anchor"].astype(np.int64), "slot": got["slot"], "score": got["score"].astype(np.int64),
            "id": part.column("id").take(place), "key": part.column("key").take(place),
        }, schema=_FOUND)

    # New names for the rows' columns: both sides come from one table, and a cogroup tells them apart by their origin.
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spark = rows.sparkSession
    # A number of tasks of its own: cells are small in bytes and long in work, so they are not to be put together.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    left = anchors.select("*", every(parts).alias("part")).repartition(tasks, "block", "part").groupBy("block", "part")
    right = rows.select(*[F.col(c).alias(c) for c in rows.columns], every(blocks).alias("block"))
    right = right.repartition(tasks, "block", "part").groupBy("block", "part")
    return left.cogroup(right).applyInArrow(run, "anchor long, slot int, score long, id long, key long")


_FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64()), ("key", pa.int64())])
_NONE = _FOUND.empty_table()


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best ``k`` rows of each group with their place; Spark keeps ``k`` of a group in each task before it moves rows."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    lower: int = 50,
    upper: int = 95,
    block_anchors: int = 8192,
    block_rows: int = 131072,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over ``vectors (id, label, vector)``.

    The score of two rows is the inner product of their vectors, shorter ones
    filled up with zeros; the first of equal scores is the lower id. An anchor's
    positives are its first other rows of its label. A positive of score ``p``
    gets the first rows of other labels whose score lies from ``lower`` to
    ``upper`` per cent of ``p``, both included.

    The upper limits of an anchor's positives part its scores into disjoint
    slots. Each cell, and Spark before its shuffle, keeps the best rows of each
    slot; a window then is the slots from its own limit downwards, merged, as
    far as its lower limit. All rows are scored twice, once for the limits.

    Equal rows are one; rows that share an id and differ are different rows. A
    null id comes after all others and is an anchor only if ``is_anchor`` says
    true for it. Null labels or vectors must have been left out. A positive of
    negative score has an empty window. Fewer rows than asked for are given if
    there are not more. Empty tables and tables without an anchor give no rows.
    Cells hold ``block_anchors`` anchors and near ``block_rows`` rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("id", "label", "vector", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).distinct()
    rows = write_through(rows.withColumn("key", F.xxhash64("id", "label", "vector")), "vectors")
    n, m = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-n // block_rows))
    blocks = max(1, -(-m // block_anchors))
    at_once = max(1, (1 << 22) // max(1, -(-n // parts)))
    dealt = rows.select("id", "label", "vector", "key", F.pmod("key", F.lit(parts)).cast("int").alias("part"))
    anchors = rows.where("is_anchor").select(
        "id", "label", "vector", "key", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")
    )

    def same_label(scores, alike, other, block):
        return [(0, _best(scores, alike, positives))]

    found = _cells(anchors, dealt, same_label, blocks, parts, at_once)
    whole = "decimal(38,0)"
    first = _first(found, ["anchor"], positives).select(
        "anchor", "place", F.col("id").alias("positive_id"), "score",
        F.when(F.col("score") >= 0, F.expr(f"cast(cast(score as {whole}) * {upper} div 100 as long)")).alias("high"),
        F.when(F.col("score") >= 0, F.expr(f"cast((cast(score as {whole}) * {lower} + 99) div 100 as long)")).alias("low"),
    )
    first = write_through(first, "positives")
    slots = first.where("high is not null").groupBy("anchor").agg(
        F.sort_array(F.collect_set("high"), asc=False).alias("limits"), F.min("low").alias("least")
    )
    slotted = anchors.join(slots, anchors["key"] == slots["anchor"]).drop("anchor")

    def slot_heads(scores, alike, other, block):
        limits = [np.asarray(x) for x in block.column("limits").to_pylist()]
        least = np.asarray(block.column("least"))[:, None]
        out = []
        for slot in range(max(map(len, limits), default=0)):
            high = np.array([x[slot] if slot < len(x) else -_MOST for x in limits])[:, None]
            beyond = np.array([x[slot + 1] if slot + 1 < len(x) else -_MOST for x in limits])[:, None]
            out.append((slot, _best(scores, other & (scores <= high) & (scores > beyond) & (scores >= least), negatives)))
        return out

    heads = _first(_cells(slotted, dealt, slot_heads, blocks, parts, at_once), ["anchor", "slot"], negatives)
    merged = heads.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("slot", "place", "score", "id"))).alias("heads")
    )
    window = F.filter("heads", lambda h: (h["score"] <= F.col("high")) & (h["score"] >= F.col("low")))
    mined = first.join(merged, "anchor").select(
        "anchor", "positive_id", "score", F.posexplode(F.slice(window, 1, negatives)).alias("rank", "negative")
    )
    names = rows.where("is_anchor").select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    return mined.join(names, "anchor").select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
        F.col("score").alias("positive_score"), F.col("negative.score").alias("negative_score"),
    )
