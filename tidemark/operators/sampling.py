"""Splits and batches that depend on row keys, not on where rows happen to lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_hash(key: Column, seed: int, portable: bool = False) -> Column:
    """A whole number that stands for a key and a seed.

    ``portable`` takes 60 bits of the MD5 of ``key:seed`` in text, which any other
    system can repeat; else a faster hash of Spark's own. A null key has a
    number of its own, or null if portable.
    """
    if not portable:
        return F.xxhash64(key, F.lit(seed))
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def stable_bucket(key: Column, buckets: int, seed: int | None = 42, portable: bool = False) -> Column:
    """Bucket 0 .. ``buckets - 1`` of a row key.

    A seeded hash by default (see :func:`seeded_hash`); ``seed=None`` takes an
    integer key modulo ``buckets``. A null key is in bucket 0, but where it has a
    hash of its own.
    """
    base = key.cast("bigint") if seed is None else seeded_hash(key, seed, portable)
    return F.coalesce(F.pmod(base, F.lit(buckets)), F.lit(0)).cast("int")


def keyed_split(
    df: DataFrame, key: str, test_buckets: int = 1, buckets: int = 5, seed: int | None = 42, portable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key; the default holds out a fifth.

    Filters on an expression of the key: no shuffle, no sort, and the same rows
    on every run whatever the partitioning.
    """
    bucket = stable_bucket(F.col(key), buckets, seed, portable)
    return df.where(bucket >= test_buckets), df.where(bucket < test_buckets)


def random_split(
    df: DataFrame, train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's ``randomSplit``; repeatable only for one physical layout."""
    first, second = df.randomSplit([train, 1.0 - train], seed=seed)
    return first, second


def assign_batches(
    df: DataFrame, key: str, batches: int, seed: int | None = 42, batch_as: str = "batch_no"
) -> DataFrame:
    """Disjoint replay batches numbered from 1, covering every row once."""
    return df.withColumn(batch_as, stable_bucket(F.col(key), batches, seed) + 1)


def sample_batch(df: DataFrame, key: str, rows: int, seed: int, portable: bool = False) -> DataFrame:
    """Exactly ``rows`` rows without replacement, a new choice for each seed.

    The rows with the smallest seeded hashes: a per-task heap, so no task sees
    more than ``rows`` rows of another. Batches with different seeds may overlap.
    """
    return df.orderBy(seeded_hash(F.col(key), seed, portable), key).limit(rows)
