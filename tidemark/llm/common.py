"""What several operators share: reading, writing through the shared folder, running sums, components, word hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import scratch_path

#: A word is a run of characters other than ASCII white space. Java's, Python's and RE2's syntax agree on it.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def write_through(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the folder that the cluster shares, and read again.

    What follows reads files that survive a lost executor, and several readers
    do not compute ``df`` again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the files of results of :func:`write_through` that nothing reads any more."""
    for frame in frames:
        discard_path(frame.sparkSession, frame.written_to)


def discard_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def text_key(text: str = "text") -> Column:
    """64 bits that stand for a whole text; null and empty texts share one key."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality on all names at once, null being equal to null."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def running_total(df: DataFrame, group: str, bucket: str, order: list[str], value: str, as_name: str) -> DataFrame:
    """Sum of ``value`` over the rows of ``group`` that come before each row.

    ``bucket`` numbers ranges of the order: all rows of a lower bucket come
    first. Only one bucket of one group is sorted in one task; the sums of the
    buckets before it, one row each, are added.
    """
    sums = df.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col(group).alias("_group"), F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(sums, local[group].eqNullSafe(sums["_group"]) & (local[bucket] == sums["_bucket"]))
    return joined.withColumn(as_name, F.col("_before") + F.col("_local")).drop(
        "_group", "_bucket", "_before", "_local"
    )


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root``: the least node of each connected component, for all nodes that occur in ``edges (a, b)``.

    Alternating stars: every node links its larger neighbours, then its smaller
    ones, to the least node that it knows. Each round is written to the shared
    folder; nothing but a count comes to the driver. Neighbourhoods are only
    ever reduced to their minimum, never gathered.
    """
    links = write_through(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), label
    )
    past = []
    while True:
        discard(*past)
        past = [links]
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        links = write_through(small.union(low.select("a", F.col("low").alias("b"))).distinct(), label)
        # Stars, if no node has two lower ends and no lower end has one itself.
        twice = links.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        passed = links.select("a").join(links.select(F.col("b").alias("a")), "a", "left_semi")
        if not twice.union(passed).limit(1).count():
            break
    discard(*past)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


# ---------------------------------------------------------------- word hashes

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 2**64)
_SPACE = np.ones(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = False
_CLOSE = np.zeros(256, bool)
_CLOSE[[ord(c) for c in ".!?\n"]] = True
_PLAIN = _SPACE.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = False

#: Outlines: a for small letters and for all beyond ASCII, A for capitals, 0 for digits; runs of these are merged.
_SIGNS = np.arange(256, dtype=np.uint8)
_SIGNS[[b for b in range(256) if b > 127 or 97 <= b <= 122]] = ord("a")
_SIGNS[ord("A") : ord("Z") + 1] = ord("A")
_SIGNS[ord("0") : ord("9") + 1] = ord("0")
_MERGED = np.zeros(256, bool)
_MERGED[[ord("a"), ord("A"), ord("0")]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers so that any bits of the result may serve as a hash."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _BACK, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of the lower-cased text, in order."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    return _hashed(raw, _SPACE[raw])[0]


def sentence_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the lower-cased text, the number of the first word of each sentence, and the words' bytes.

    White space and ``. ! ?`` part words; the latter and line ends close a
    sentence. Every sentence has a word.
    """
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    close = _CLOSE[raw]
    words, starts, ends = _hashed(raw, _SPACE[raw] & ~close)
    closed = np.cumsum(close)[starts]
    return words, np.flatnonzero(np.diff(closed, prepend=-1)), ends - starts


def _hashed(raw: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not starts.size:
        return np.empty(0, np.uint64), starts, ends
    size = 1 << max(12, int(raw.size).bit_length())
    up, down = _powers(size)
    sums = np.zeros(raw.size + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: raw.size], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def outline_hashes(text: str) -> np.ndarray:
    """A hash of each word's outline, in order: runs of small letters, of capitals and of digits are one sign each, marks stay."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    signs = _SIGNS[raw]
    same = np.r_[False, (signs[1:] == signs[:-1]) & _MERGED[signs[1:]]] if signs.size else np.empty(0, bool)
    signs = signs[~same]
    return _hashed(signs, _SPACE[signs])[0]


def plain_words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte lengths of the words; ASCII characters other than letters and digits part them too."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    words, starts, ends = _hashed(raw, _PLAIN[raw])
    return words, ends - starts


def run_hash(words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of the words from each start up to each stop."""
    up, down = _powers(1 << max(12, int(words.size).bit_length()))
    sums = np.zeros(words.size + 1, np.uint64)
    np.cumsum(words * up[: words.size], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """A hash of every run of ``k`` words; of all words together if there are fewer; nothing without words."""
    if not words.size:
        return words
    k = min(k, words.size)
    n = words.size - k + 1
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = mix(out ^ words[j : j + n]) if j == 0 else mix(out * _STEP + words[j : j + n])
    return out


def occurrence(values: np.ndarray) -> np.ndarray:
    """How often the same value stands before each position."""
    ranked = np.sort(values)
    if not (ranked[1:] == ranked[:-1]).any():
        return np.zeros(values.size, np.int64)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    count = np.arange(values.size) - np.repeat(first, np.diff(np.r_[first, values.size]))
    out = np.empty(values.size, np.int64)
    out[order] = count
    return out
