"""Mixing sources to target weights: hash-random order, running sums of sizes, an exact cut at each source's budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, running_total, write_through


def size_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source, source_size, target`` from one row per source with ``source, source_size``.

    Sources by code point, null last, weigh ``weights``, repeated. They divide
    ``share`` times the total size; a target stops at ``most`` times its
    source's size and the rest is shared again by weight. The end of that is a
    level L with ``target = least(cap, L * weight)``; sources in the order of
    ``cap / weight`` are full until the first that is not.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    sized = sizes.select(
        "source", "source_size", (F.col("source_size") * most).alias("cap"),
        F.element_at(cycle, ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = sized.withColumn("level", (F.col("total") * F.lit(float(share)) - full) / rest)
    level = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "source", "level")))
    level = level.over(Window.partitionBy())["level"]
    return leveled.withColumn("final", F.coalesce(level, F.lit(0.0))).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"),
    )


def _row_key(seed: int) -> Column:
    """60 bits that stand for a row's id and text, and for its place in the random order."""
    return F.conv(
        F.substring(F.md5(F.concat(
            F.lit("" if seed == 0 else f"{seed}:"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("")),
        )), 1, 15), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    buckets: int = 1024,
    seed: int = 0,
) -> DataFrame:
    """How many words of each document a mix of the sources takes, one row per row of ``docs``.

    Reads ``doc_id, text, source``; other columns are ignored. Returns ``doc_id,
    source, key, size, source_size, target, taken``; the key stands for id and text. Each source's rows are in the
    order of a hash of id, text and seed. A target is whole epochs of the source
    and a remainder; the remainder ends inside the document where the running
    sum reaches it, so the words taken of a source are its target rounded down.

    Null and empty texts have size 0 and give 0. A null source is a source. Null
    ids and repeated rows are documents like any other; equal rows get equal
    hashes and follow each other. Sources without a word have target 0. An empty
    table gives an empty one. A source may hold any part of the rows: ``buckets``
    ranges of the hash are sorted by themselves.
    """
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _row_key(seed).alias("key"),
    )
    sized = write_through(sized, "mix").withColumn("bucket", F.floor(F.col("key") / F.lit((1 << 60) // buckets)))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = size_targets(sizes, weights, share, most).select(F.col("source").alias("_source"), "source_size", "target")
    placed = running_total(sized, "source", "bucket", ["key", "doc_id", "size"], "size", "before")
    placed = placed.join(targets, placed["source"].eqNullSafe(targets["_source"]))
    whole = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    part = whole - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), part - F.col("before")))
    return placed.select("doc_id", "source", "key", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_corpus(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 0) -> DataFrame:
    """The mix itself: ``docs`` with all columns and ``taken``, each text as many words long as :func:`mix_sources` takes of it.

    A text that is taken several times stands so often, parted by line ends; one
    that is taken in part is cut after a word, and keeps its white space up to
    there. Documents of which nothing is taken are left out, and so are null and
    empty texts. Equal ids, sources and texts are one row, whose words are taken
    together. An empty table gives an empty one.
    """
    mix = mix_sources(docs, weights, share, most, seed=seed)
    mix = mix.groupBy("doc_id", "source", "key").agg(F.sum("taken").alias("_mix_taken"), F.max("size").alias("_mix_size"))
    mix = mix.where("_mix_taken > 0").withColumnsRenamed({c: f"_mix_{c}" for c in ("doc_id", "source", "key")})
    rows = docs.withColumn("_mix_own", _row_key(seed))
    on = rows["doc_id"].eqNullSafe(mix["_mix_doc_id"]) & rows["source"].eqNullSafe(mix["_mix_source"])
    joined = rows.join(mix, on & (rows["_mix_own"] == mix["_mix_key"])).dropDuplicates(["_mix_doc_id", "_mix_source", "_mix_key"])
    whole = F.floor(F.col("_mix_taken") / F.col("_mix_size")).cast("int")
    part = (F.col("_mix_taken") % F.col("_mix_size")).cast("int")
    words = F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), part)
    texts = F.concat(F.array_repeat("text", whole), F.when(part > 0, F.array(F.array_join(words, ""))).otherwise(F.array()))
    taken = "taken" if "taken" not in docs.columns else "mix_taken"
    return joined.withColumn("text", F.array_join(texts, "\n")).select(*docs.columns, F.col("_mix_taken").alias(taken))
