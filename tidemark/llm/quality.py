"""Quality rules: text statistics, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, text_key, write_through

#: Fixed values of the statistics.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def text_statistics(docs: DataFrame, place_bits: int = 0) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Repeats of three words are found by sorting: each run's hash stands in the
    upper bits of a number and its place in the lower ones, so equal runs are
    neighbours and name their places. In a very long text the place takes many
    of the bits; what is left of the hash then names a few runs too many, so the
    runs named, and only they, are sorted by a second hash again. The place takes
    ``place_bits`` at least. Null texts count as empty.
    """
    text = F.coalesce("text", F.lit(""))
    kept = docs.columns
    out = docs.withColumns({"_text": text, "_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0))})
    out = out.withColumns({
        "_n": F.size("_words"),
        "_bits": F.greatest(F.length(F.bin(F.size("_words"))), F.lit(place_bits)),
        "_lines": F.expr(r"filter(split(_text, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"),
    })
    def again(runs: str) -> str:
        """Places of sorted numbers whose upper bits are those of a neighbour, in order."""
        return f"""sort_array(filter(transform({runs}, (v, i) -> if(
            coalesce(shiftright(v, _bits) = shiftright(get({runs}, i - 1), _bits), false)
            or coalesce(shiftright(v, _bits) = shiftright(get({runs}, i + 1), _bits), false),
        v & (shiftleft(1L, _bits) - 1), null)), v -> v is not null))"""

    runs = """sort_array(if(_n < 3, cast(array() as array<bigint>), transform(sequence(0, greatest(_n, 3) - 3),
        i -> shiftleft(xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)), _bits) | i)))"""
    checked = """sort_array(transform(_named, i -> shiftleft(
        xxhash64(17, get(_words, int(i) + 2), get(_words, int(i) + 1), get(_words, int(i))), _bits) | i))"""
    out = out.withColumn("_runs", F.expr(runs)).withColumn("_named", F.expr(again("_runs")))
    out = out.withColumn("_checked", F.expr(checked)).withColumn("_places", F.expr(again("_checked")))
    covered = """aggregate(transform(_places, (v, i) -> least(3L, coalesce(get(_places, i + 1) - v, 3L))),
        0L, (a, v) -> a + v)"""
    long = lambda c: c.cast("long")
    return out.select(
        *kept,
        long(F.col("_n")).alias("n_words"),
        long(F.length(F.translate("_text", SPACES, ""))).alias("word_chars"),
        long(F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(F.expr(covered)).alias("n_repeat_words"),
    )


def _normal(line: Column) -> Column:
    """A line in lower case, one space between words, every digit a 0."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "), "[0-9]", "0")))


def document_lines(docs: DataFrame, host: str) -> DataFrame:
    """``doc_id, host, key, hash, words``: each different line with a word of each document, and the words of its copies there."""
    lines = docs.select(
        "doc_id", F.col(host).alias("host"), text_key().alias("key"), F.explode(F.split("text", "\n", -1)).alias("line")
    )
    lines = lines.select(
        "doc_id", "host", "key", F.xxhash64(_normal(F.col("line"))).alias("hash"), F.regexp_count("line", F.lit(WORD)).cast("long").alias("words")
    ).where("words > 0")
    return lines.groupBy("doc_id", "host", "key", "hash").agg(F.sum("words").alias("words"))


def frequent_lines(held: DataFrame, line_documents: int) -> DataFrame:
    """``_host, _hash, often`` of lines that more than ``line_documents`` documents of a host have."""
    often = held.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") > line_documents)
    return often.select(F.col("host").alias("_host"), F.col("hash").alias("_hash"), F.lit(True).alias("often"))


def frequent_line_words(docs: DataFrame, host: str, line_documents: int) -> DataFrame:
    """Per document, ``words`` and those of them in lines that more than ``line_documents`` documents of its host have.

    A line is normalised (case, white space, digits as 0) and hashed. A document
    is its id, host and text. Counts are made before rows are moved; a line in a
    third of all documents is one row per document on the join's larger side,
    which adaptive execution splits.
    """
    held = write_through(document_lines(docs, host), "lines")
    often = frequent_lines(held, line_documents)
    joined = held.join(often, held["host"].eqNullSafe(often["_host"]) & (held["hash"] == often["_hash"]), "left")
    return joined.groupBy("doc_id", "host", "key").agg(
        F.sum("words").alias("words"), F.sum(F.when(F.col("often"), F.col("words")).otherwise(0)).alias("gone")
    )


def remove_frequent_lines(docs: DataFrame, host: str = "source", line_documents: int = 10) -> DataFrame:
    """``docs`` with all columns, their texts without lines that more than ``line_documents`` documents of the host have.

    Lines are compared as in :func:`frequent_line_words`; every copy of such a
    line goes, also where the count came from. Lines without a word stay, and so
    do null and empty texts. Rows keep their number; equal rows are one document
    when documents are counted. An empty table gives an empty one.
    """
    names = {c: f"_line_{c}" for c in ("doc_id", "host", "key")}
    slim = docs.select("doc_id", "text", F.col(host).alias("host"))
    held = write_through(document_lines(slim, "host"), "lines")
    often = frequent_lines(held, line_documents)
    gone = held.join(often, held["host"].eqNullSafe(often["_host"]) & (held["hash"] == often["_hash"]))
    gone = gone.groupBy("doc_id", "host", "key").agg(F.collect_set("hash").alias("_line_gone")).withColumnsRenamed(names)
    rows = docs.withColumn("_line_own", text_key())
    on = (
        rows["doc_id"].eqNullSafe(gone["_line_doc_id"]) & rows[host].eqNullSafe(gone["_line_host"]) & (rows["_line_own"] == gone["_line_key"])
    )
    left = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains("_line_gone", F.xxhash64(_normal(x))))
    text = F.when(F.col("_line_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return rows.join(gone, on, "left").withColumn("text", text).select(docs.columns)


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    line_documents: int = 10,
    least_left: float = 0.5,
    least_words: int = 50,
    most_repeated: float = 0.5,
) -> DataFrame:
    """Statistics and verdict per row of ``docs``; reads ``doc_id, text`` and ``host`` only.

    ``removed_words`` are in lines that more than ``line_documents`` documents of
    the host have. ``kept`` is false for texts that fail the base rules and for
    depleted ones, which have under ``least_left`` of their words left.

    Null and empty texts have no words and fail. A null host is a host. Equal
    rows are one document when documents are counted, and each gets a row. An
    empty table gives an empty one.
    """
    slim = docs.select("doc_id", "text", F.col(host).alias("host"))
    base = text_statistics(slim.withColumn("key", text_key())).drop("text")
    gone = frequent_line_words(slim, "host", line_documents)
    on = (
        base["doc_id"].eqNullSafe(gone["doc_id"]) & base["host"].eqNullSafe(gone["host"]) & (base["key"] == gone["key"])
    )
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > F.col("n_words") * F.lit(most_repeated))
    #: Equal rows add up in both sums alike.
    removed = F.coalesce((gone["gone"] * base["n_words"] / gone["words"]).cast("long"), F.lit(0))
    out = base.join(gone, on, "left").select(
        base["doc_id"], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), removed.alias("removed_words"),
    )
    depleted = F.col("n_words") - F.col("removed_words") < F.col("n_words") * F.lit(least_left)
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)
