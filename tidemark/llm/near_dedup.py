"""Near-duplicates by order MinHash: sketches that keep the text order of their k-mers, verified by banded alignment."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, components, discard, discard_path, mix, occurrence, shingles, text_key, word_hashes, write_through
from tidemark.session import scratch_path


def labelled_kmers(text: str, k: int = 5) -> np.ndarray:
    """Hashes of the text's runs of ``k`` words in order, each labelled with its occurrence: all are different."""
    values = shingles(word_hashes(text), k)
    again = occurrence(values)
    return np.where(again == 0, values, mix(values ^ again.astype(np.uint64)))


def sketches(kmers: np.ndarray, bands: int, length: int, first: int = 0) -> np.ndarray:
    """Per band a hash of the ``length`` k-mers of lowest rank under the band's hash function, in text order.

    Two texts agree in a band with probability near J ** length, J being the
    Jaccard similarity of their labelled k-mers, if what they share stands in
    one order. Shorter texts give all they have. Bands are numbered from ``first``.
    """
    out = []
    part = max(1, (1 << 20) // kmers.size)  # bands at a time: memory stays bounded on very long texts
    for low in range(first, first + bands, part):
        number = np.arange(low, min(first + bands, low + part), dtype=np.uint64)[:, None]
        if kmers.size > length:
            ranks = (kmers ^ mix(number)) * (mix(~number) | np.uint64(1))
            ranks ^= ranks >> np.uint64(32)
            chosen = np.sort(np.argpartition(ranks, length, axis=1)[:, :length], axis=1)
            picked = kmers[chosen]
        else:
            picked = np.broadcast_to(kmers, (number.size, kmers.size))
        placed = picked + mix(np.arange(picked.shape[1], dtype=np.uint64)) * (number + np.uint64(1))
        out.append(mix(np.bitwise_xor.reduce(mix(placed), axis=1) + number[:, 0]))
    return np.concatenate(out)


#: Bands and k-mers a band of each level. The first is for all texts, the others for texts of crowded buckets.
LEVELS = ((40, 6), (64, 12), (160, 18))
#: Texts of so many k-mers are short: a band's choice is a large part of them. They get bands of two k-mers besides.
SHORT, SHORT_BANDS = 40, 12
#: Most bits of a text's bitmap. Longer texts have fewer bits a k-mer: more of their pairs are aligned, none is lost.
PARITY_BITS = 4096


def band_keys(kmers: np.ndarray, level: int, levels: tuple[tuple[int, int], ...]) -> np.ndarray:
    """All sketches of a text at a level; no two levels share a hash function.

    A text that has few k-mers for the level's bands gets bands of the first
    level's length, and near the limit both.
    """
    bands, length = levels[level]
    first = sum(n + SHORT_BANDS for n, _ in levels[:level])
    least = levels[0][1]
    out = []
    if length == least or kmers.size > 4 * length:
        out.append(sketches(kmers, bands, length, first))
    if length != least and kmers.size <= 5 * length:
        out.append(sketches(kmers, bands, least, first + (1 << 32)))
    if kmers.size <= SHORT:
        out.append(sketches(kmers, SHORT_BANDS, 2, first + bands))
    return np.concatenate(out)


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Similarity of two texts by alignment of their labelled k-mers; 0 where it cannot reach ``least``.

    With C the longest chain of common k-mers in one order it is
    ``C / (|a| + |b| - C)``. A similarity of ``least`` leaves room for only so
    many k-mers outside the chain; a pair of places further apart than that, the
    band, belongs to no such chain and is left out.
    """
    if not a.size or not b.size:
        return 0.0
    need = least / (1 + least) * (a.size + b.size)
    if min(a.size, b.size) < need - 1e-9:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = a.size + b.size - 2 * need
    close = np.abs(i - j) <= band + 1e-9
    i, j = i[close], j[close]
    if i.size < need - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        chain = j.size
    else:
        ends: list[int] = []
        for place in j.tolist():
            at = bisect_left(ends, place)
            ends[at : at + 1] = [place]
        chain = len(ends)
    similarity = chain / (a.size + b.size - chain)
    return similarity if similarity >= least - 1e-12 else 0.0


def _sketched(texts: DataFrame, level: int, levels: tuple[tuple[int, int], ...], k: int) -> DataFrame:
    """``node, band_key, n``, a row per band of each text of ``n`` k-mers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, sizes = [], [], []
            for i, text in enumerate(batch.column(1)):
                kmers = labelled_kmers(text.as_py(), k)
                if kmers.size:
                    keys.append(band_keys(kmers, level, levels))
                    rows.append(np.full(keys[-1].size, i))
                    sizes.append(np.full(keys[-1].size, kmers.size))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sizes))],
                    names=["node", "band_key", "n"],
                )

    return texts.select("node", "text").mapInArrow(run, "node bigint, band_key bigint, n bigint")


def _verified(pairs: DataFrame, texts: DataFrame, least: float, k: int) -> DataFrame:
    """``a, b, similarity`` of ``pairs (a, b)``, hubs and members; similarity is 0 under ``least``.

    ``texts`` lies in buckets by node, so it is not moved to be joined with the
    members. The join with the hubs' texts goes by a key of its own, which no
    side lies by: a hub of very many members is then a hot key between two plain
    exchanges, which adaptive execution splits.
    """
    hubs = texts.join(pairs.select(F.col("a").alias("node")).distinct(), "node")
    hubs = hubs.select(F.bitwise_not("node").alias("hub"), F.col("text").alias("text_a"))
    members = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = members.withColumn("hub", F.bitwise_not("a")).join(hubs, "hub").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kmers = None, None
        for batch in batches:
            out = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, kmers = a, labelled_kmers(x.as_py(), k)
                out.append(aligned(kmers, labelled_kmers(y.as_py(), k), least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"]
            )

    return both.mapInArrow(run, "a bigint, b bigint, similarity double")


def _with_hubs(rows: DataFrame, roots: DataFrame | None, by_bucket: bool) -> DataFrame:
    """``band_key, node, n, root, turn, a, n_a, root_a, turn_a``: members of buckets that hold several texts, and their hub.

    The hub is the member of the lowest turn: its number, so that the same texts
    are hubs of many buckets and pairs are few; or ``by_bucket`` a hash of both,
    so that each bucket has another. Buckets of one class are left out.
    """
    turn = F.xxhash64("node", "band_key") if by_bucket else F.col("node")
    if roots is None:
        rows = rows.withColumn("root", F.col("node"))
    else:
        rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = rows.select("band_key", "node", "n", "root", turn.alias("turn"))
    hubs = rows.groupBy("band_key").agg(
        F.min(F.struct("turn", "node", "n", "root")).alias("h"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    hubs = hubs.where("low < high").select(
        "band_key", F.col("h.node").alias("a"), F.col("h.n").alias("n_a"), F.col("h.root").alias("root_a"), F.col("h.turn").alias("turn_a")
    )
    return rows.join(hubs, "band_key")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``band_key`` of the buckets whose members but the hub are of several classes: pairs there were not aligned."""
    rest = members.where("node <> a").select("band_key", "node").join(roots, "node", "left")
    rest = rest.select("band_key", F.coalesce("root", "node").alias("root"))
    return rest.groupBy("band_key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band_key")


def parity_bits(kmers: np.ndarray) -> np.ndarray:
    """64-bit parts of a bitmap in which each k-mer turns one bit: two bitmaps of a length differ in no more bits than their texts in k-mers.

    There are two bits a k-mer or more, up to ``PARITY_BITS`` in all. Parts that
    are turned by each other make the bitmap of a shorter length.
    """
    size = min(PARITY_BITS, 64 << ((kmers.size - 1) // 32).bit_length())
    bits = np.bincount((mix(kmers) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _differing(a: str, b: str) -> Column:
    """In how many bits the bitmaps ``a`` and ``b`` differ, the longer one made shorter: no more than the k-mers that only one text has."""
    least = f"least(size({a}), size({b}))"
    shorter = "if(size({0}) = {1}, {0}, transform(sequence(0, {1} - 1), i -> aggregate(sequence(i, size({0}) - 1, {1}), 0L, (x, j) -> x ^ {0}[j])))"
    return F.expr(f"aggregate(zip_with({shorter.format(a, least)}, {shorter.format(b, least)}, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)")


def _overlapping(texts: DataFrame, roots: DataFrame, least: float, k: int) -> DataFrame:
    """``a, b``: all pairs of ``texts`` of different classes that may have a similarity of ``least``.

    Similar texts share ``least / (1 + least)`` of their k-mers together. Put in
    any one order, the first that both have comes early in both: as many must
    follow. What only one class has is first in that order, then what few texts
    have. Of texts that meet so, pairs remain whose bitmaps leave room for as
    many shared k-mers; nothing that is similar is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, root, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                kmers = labelled_kmers(text.as_py(), k)
                if kmers.size:
                    lists = [pa.array([part], pa.list_(pa.int64())) for part in (kmers.view(np.int64), parity_bits(kmers))]
                    one = [pa.array([x], pa.int64()) for x in (node, root, kmers.size)]
                    yield pa.RecordBatch.from_arrays([*one, *lists], names=["node", "root", "n", "kmers", "bits"])

    rooted = texts.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "text")
    sets = write_through(rooted.mapInArrow(run, "node bigint, root bigint, n bigint, kmers array<bigint>, bits array<bigint>"), "kmers")
    kmers = sets.select("node", "root", "n", F.explode("kmers").alias("kmer"))
    held = kmers.groupBy("kmer").agg(F.count("*").alias("texts"), (F.min("root") < F.max("root")).alias("several"))
    order = Window.partitionBy("node").orderBy("several", "texts", "kmer")
    first = kmers.join(held, "kmer").withColumn("place", F.row_number().over(order) - 1)
    first = first.where("several").where(F.col("place") <= F.lit(1 - least) * F.col("n") + 1e-9)
    first = write_through(first.select("node", "kmer", "place").join(sets.select("node", "root", "n", "bits"), "node"), "rare")
    one, other = (first.select("kmer", *[F.col(c).alias(c + end) for c in ("node", "n", "place", "root", "bits")]) for end in ("_a", "_b"))
    need = F.lit(least / (1 + least)) * (F.col("n_a") + F.col("n_b")) - F.lit(1e-9)
    early = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= need
    alike = _differing("bits_a", "bits_b") <= F.col("n_a") + F.col("n_b") - F.lit(2) * need
    met = one.join(other, "kmer").where("node_a < node_b and root_a <> root_b").where(early & alike)
    pairs = write_through(met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "pairs")
    discard(sets, first)
    return pairs


def near_links(
    texts: DataFrame, least: float, levels: tuple[tuple[int, int], ...], k: int, exact: bool
) -> DataFrame:
    """``node, root`` of the classes of ``texts (node, text)`` that links of similar texts connect.

    Texts with equal sketches form a bucket, whose members are aligned with one
    of them, its hub: as many pairs as members, whatever the bucket's size. Links
    make classes. A bucket is crowded if its other members are of several
    classes then. The texts of crowded buckets go to the next level, where
    longer sketches by other hash functions deal them to smaller buckets, each
    with a hub of its own; members of the hub's class are not aligned again.

    Longer sketches lose some links. ``exact`` therefore ends with a join of all
    texts of the first level's crowded buckets, by their rarest k-mers: every
    pair that met there is of one class then, or was aligned.
    """
    judged, roots, some, crowds = [], None, texts, None

    def align(pairs: DataFrame) -> None:
        nonlocal roots
        found = write_through(_verified(pairs, texts, least, k).where("similarity > 0").select("a", "b"), "links")
        judged.append(found)
        discard(pairs)
        if roots is None or found.limit(1).count():
            if roots is not None:
                discard(roots)
            links = judged[0]
            for more in judged[1:]:
                links = links.union(more)
            roots = write_through(components(links), "roots")

    for level in range(len(levels)):
        rows = write_through(_sketched(some, level, levels, k), "sketches")
        members = write_through(_with_hubs(rows, roots, level > 0), "members")
        pairs = members.where("root <> root_a").where(F.least("n", "n_a") >= F.lit(least - 1e-9) * F.greatest("n", "n_a"))
        align(write_through(pairs.select("a", F.col("node").alias("b")).distinct(), "pairs"))
        if level == len(levels) - 1 and (level > 0 or not exact):
            discard(rows, members)
            break
        crowded = write_through(_open(members, roots), "crowded")
        waiting = write_through(members.join(crowded, "band_key").select("node").distinct(), "waiting")
        discard(rows, members, crowded)
        if level == 0:
            crowds = waiting
        if not waiting.limit(1).count():
            break
        some = texts.join(waiting, "node", "left_semi")
    if exact and crowds is not None and crowds.limit(1).count():
        align(_overlapping(texts.join(crowds, "node", "left_semi"), roots, least, k))
    discard(*judged)
    return roots


def near_classes(
    docs: DataFrame, least: float = 0.8, levels: tuple[tuple[int, int], ...] = LEVELS, k: int = 5, exact: bool = True
) -> DataFrame:
    """``doc_id, key, class_id, class_size, is_first`` per row of ``docs (doc_id, text)``.

    Texts with equal words are copies; of different texts those are linked whose
    alignment of labelled five-word k-mers has a similarity of at least
    ``least``; a class is what links connect. A pair of similarity J shares one
    of the first level's 40 bands of 6 k-mers with probability 1 - (1 - J ** 6)
    ** 40: all but one in about 190,000 at 0.8. Where a bucket stays crowded its
    texts meet again in 64 bands of 12 (0.989 at 0.8) and 160 of 18 (0.945 at
    0.8, 0.9998 at 0.85) with other hubs; ``exact`` then aligns what those lose.
    ``class_id`` is the least id of the class; ``is_first`` marks one text of
    it, the one with that id. Only one of several copies is sketched and aligned.

    Null, empty and wordless texts are in no class: ``class_id`` is their id.
    Null ids count as greater than all others; a class of null ids only has a
    null ``class_id``. Rows of equal id and text are the same document. An empty
    table gives an empty one.
    """
    slim = docs.select("doc_id", "text", F.xxhash64(F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")))).alias("node"))
    blank = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    ids = write_through(slim.select("doc_id", text_key().alias("key"), "node", blank.alias("blank")), "nodes")
    spark = docs.sparkSession
    table = f"near_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = scratch_path(spark, "texts")
    texts = slim.where(~blank).select("node", "text").dropDuplicates(["node"])
    texts.write.bucketBy(parts, "node").option("path", kept).saveAsTable(table)
    try:
        roots = near_links(spark.table(table), least, levels, k, exact)
    finally:
        spark.sql(f"DROP TABLE {table}")
        discard_path(spark, kept)
    nodes = ids.where("not blank").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = nodes.join(roots, "node", "left").select("node", "least", "n", F.coalesce("root", "node").alias("root"))
    nodes = write_through(nodes, "classes")
    classes = nodes.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("first")
    )
    nodes = nodes.join(classes, "root").select("node", "class_id", "class_size", (F.col("first.node") == F.col("node")).alias("leads"))
    nodes = write_through(nodes, "members")
    out = ids.join(nodes, "node", "left")
    alone = F.col("blank") | F.col("class_size").isNull()
    return out.select(
        "doc_id", "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        (alone | (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("is_first"),
    )


def drop_near_duplicates(docs: DataFrame, least: float = 0.8, levels: tuple[tuple[int, int], ...] = LEVELS, k: int = 5) -> DataFrame:
    """``docs`` with one document of each class, the one of least id; all columns stay as they are.

    Rows with blank texts stay, but equal rows are one document.
    """
    marked = near_classes(docs, least, levels, k).where("is_first")
    plain = (F.coalesce("doc_id", F.lit(0)).alias("_llm_id"), F.col("doc_id").isNull().alias("_llm_null"))
    on = ["_llm_id", "_llm_null", "_llm_key"]
    first = marked.select(*plain, F.col("key").alias("_llm_key")).distinct()
    texts = docs.select("*", *plain, text_key().alias("_llm_key"))
    return texts.join(first, on).dropDuplicates(on).select(docs.columns)
