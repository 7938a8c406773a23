"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_words, shingles

BITS = 64


def window_size(n: int) -> tuple[int, int]:
    """Step and size of the windows, in shingles, for items of ``n`` shingles.

    Items of one size class, from a power of two to the next, share them; all
    from 16 on are one class. A window is three steps and an item at least four,
    so any run of ``4 * step - 1`` shingles of a document holds a whole window
    that begins at a multiple of the step. A window of an item's size that is
    similar to it at 0.8 has lost at most a ninth of its shingles, a changed word
    inside at least four; the longest run between changes then still holds a
    window that has none.
    """
    step = max(1, min(4, (1 << (n.bit_length() - 1)) // 4))
    return step, 3 * step if n >= 3 else 1


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(values: np.ndarray, step: int, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles, a multiple of ``step``, that begin at 0, step, 2 step ..."""
    blocks = values.size // step
    n = blocks - size // step + 1
    if n < 1:
        return np.empty(0, np.uint64)
    if size == 1:
        return values
    wide = np.uint8 if size < 256 else np.int64
    out = np.empty(n, np.uint64)
    part = max(1, (1 << 16) // step)  # blocks at a time: memory stays bounded on very long texts
    for low in range(0, n, part):
        high = min(n, low + part)
        own = _bits(values[low * step : (high - 1) * step + size])
        sums = own.reshape(-1, step, BITS).sum(axis=1, dtype=wide)
        total = sums[: high - low].copy()
        for j in range(1, size // step):
            total += sums[j : j + high - low]
        out[low:high] = np.packbits(total > size // 2, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


@dataclass
class SizeClass:
    """Windows of the items of one size class, indexed by each of ``radius + 1`` blocks of their bits.

    Two fingerprints that differ in at most ``radius`` bits agree in a whole
    block, so looking up every block misses none of them.
    """

    step: int
    size: int
    prints: list[int] = field(default_factory=list)
    items: list[int] = field(default_factory=list)
    places: list[int] = field(default_factory=list)

    def build(self, radius: int) -> None:
        order = np.array(self.prints, np.uint64)
        self.owner, self.place = np.array(self.items), np.array(self.places)
        edges = np.linspace(0, BITS, radius + 2).astype(int)
        self.radius, self.blocks = radius, []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            mask = np.uint64((1 << int(high - low)) - 1)
            keys = (order >> np.uint64(low)) & mask
            rank = np.argsort(keys, kind="stable")
            # Which keys there are, as a bit per value of the lower 16 bits: most windows end here.
            some = np.zeros(1 << 16, bool)
            some[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.blocks.append((np.uint64(low), mask, keys[rank], rank, some))
        self.order = order

    def near(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a window of the text and a window of an item within the radius, block by block."""
        for low, mask, keys, rank, some in self.blocks:
            own = (prints >> low) & mask
            hit = np.flatnonzero(some[(own & np.uint64(0xFFFF)).astype(np.int64)])
            left = np.searchsorted(keys, own[hit], "left")
            count = np.searchsorted(keys, own[hit], "right") - left
            window = np.repeat(hit, count)
            if window.size:
                inner = np.arange(window.size) - np.repeat(np.cumsum(count) - count, count)
                entry = rank[np.repeat(left, count) + inner]
                close = np.bitwise_count(prints[window] ^ self.order[entry]) <= self.radius
                yield window[close], entry[close]


def weighted_shingles(text: str | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a text, and for each its weight: the bytes of its words, as long words tell more."""
    words, lengths = plain_words(text or "")
    values = shingles(words, k)
    if not values.size:
        return values, lengths
    sums = np.r_[0, np.cumsum(lengths)]
    k = min(k, words.size)
    return values, sums[k:] - sums[:-k]


class BenchmarkIndex:
    """Shingles and weights of benchmark items, and their windows by size class."""

    def __init__(self, items: list[tuple[int, str]], radius: int = 3, k: int = 5) -> None:
        self.k, self.ids, self.values, self.weights = k, [], [], []
        self.classes: dict[tuple[int, int], SizeClass] = {}
        for item_id, text in items:
            values, weights = weighted_shingles(text, k)
            if not values.size:
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            self.values.append(values)
            self.weights.append(weights)
            step, size = window_size(values.size)
            own = self.classes.setdefault((step, size), SizeClass(step, size))
            for place in range(values.size - size + 1):
                own.prints.append(int(fingerprints(values[place : place + size], step, size)[0]))
                own.items.append(number)
                own.places.append(place)
        for own in self.classes.values():
            own.build(radius)

    def search(self, text: str | None, least: float) -> list[tuple[int, float, int]]:
        """``(item number, similarity, first word)`` of the best window for each item found with at least ``least``."""
        values, weights = weighted_shingles(text, self.k)
        if not values.size:
            return []
        found: dict[int, set[int]] = {}
        for own in self.classes.values():
            prints = fingerprints(values, own.step, own.size)
            for window, entry in own.near(prints):
                items, starts = own.owner[entry], window * own.step - own.place[entry]
                for item, start in set(zip(items.tolist(), starts.tolist(), strict=True)):
                    found.setdefault(item, set()).add(start)
        best = []
        for item, starts in found.items():
            similarity, place = self.verify(item, values, weights, starts)
            if similarity >= least:
                best.append((item, similarity, place))
        return best

    def verify(self, item: int, values: np.ndarray, weights: np.ndarray, starts: set[int]) -> tuple[float, int]:
        """Highest weighted Jaccard similarity of the item and an item-sized window within a quarter of its size of a start."""
        own = self.values[item]
        size = min(own.size, values.size)
        slack = own.size // 4
        tried = {min(max(0, start), values.size - size) for start in starts}
        for start in starts:
            tried.update(range(max(0, start - slack), min(values.size - size, start + slack) + 1))
        goal: dict[int, int] = {}
        full = 0
        for v, w in zip(own.tolist(), self.weights[item].tolist(), strict=True):
            goal[v] = goal.get(v, 0) + 1
            full += w
        top, where, last = 0.0, 0, None
        have: dict[int, int] = {}
        common = other = 0  # weights of what both have, and of what only the window has

        def change(low: int, high: int, by: int) -> None:
            nonlocal common, other
            for v, w in zip(values[low:high].tolist(), weights[low:high].tolist(), strict=True):
                n, most = have.get(v, 0), goal.get(v, 0)
                have[v] = n + by
                gained = min(n + by, most) - min(n, most)
                common += w * gained
                other += w * (by - gained)

        for start in sorted(tried):
            if last is None or start - last >= size:
                have.clear()
                common = other = 0
                change(start, start + size, 1)
            else:
                change(last, start, -1)
                change(last + size, start + size, 1)
            last = start
            similarity = common / (full + other)
            if similarity > top:
                top, where = similarity, start
        return top, where


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``block_bytes`` of text; a benchmark of any size is searched block by block."""
    slim = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = slim.agg(F.coalesce(F.sum(F.length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        part = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r[0], r[1]) for r in part.orderBy("item_id", "text").collect()]


def _searcher(index, least: float) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, scores, places = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                for item, similarity, place in index.value.search(text.as_py(), least):
                    rows.append(i)
                    items.append(index.value.ids[item])
                    scores.append(similarity)
                    places.append(place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), pa.array(scores, pa.float64()), pa.array(places, pa.int64())],
                names=["doc_id", "item_id", "similarity", "first_word"],
            )

    return search


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 3, block_bytes: int = 4 << 20
) -> DataFrame:
    """``doc_id, item_id, similarity, first_word``: documents that hold a benchmark item, once per item.

    Words are runs of letters and digits in lower case (ASCII punctuation parts
    them), shingles five words. Every window of a document of the size of an
    item's size class gets a fingerprint; those within ``radius`` bits of a
    window of an item are candidates; ``similarity`` is the weighted Jaccard
    similarity of the item's shingles and the best item-sized window there, a
    shingle weighing the bytes of its words.

    Null, empty and wordless texts and items match nothing. Items or texts under
    five words are one shingle and match each other whole. A null item id is
    ignored; a null doc id is a document. Equal rows each give their rows. An
    empty table gives no rows. Item texts are shared with the executors in
    blocks of about ``block_bytes``; a further block is a further scan.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = None
    for items in _blocks(benchmark, block_bytes):
        index = spark.sparkContext.broadcast(BenchmarkIndex(items, radius))
        found = docs.where("text is not null").select("doc_id", "text").mapInArrow(
            _searcher(index, least), f"doc_id {kind}, item_id bigint, similarity double, first_word bigint"
        )
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 3, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns stay as they are."""
    for items in _blocks(benchmark, block_bytes):
        docs = docs.where(_clean(docs.sparkSession.sparkContext.broadcast(BenchmarkIndex(items, radius)), least)("text"))
    return docs


def _clean(index, least: float) -> Callable:
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not index.value.search(t, least) for t in texts], dtype=bool)

    return clean
