"""Language identification by a bit-sliced Bloom filter of n-grams that returns all languages of an n-gram at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import mix

#: Orders of the character n-grams; a word counts with one blank on either side.
ORDERS = (2, 3, 4)
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint32)


def gram_hashes(text: str) -> np.ndarray:
    """Hashes of all n-grams of the letters of a lower-cased text; other characters part words."""
    codes = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = codes == 32
    if blank.all():
        return np.empty(0, np.uint64)
    keep = ~(blank & np.r_[True, blank[:-1]])
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint64)
    out = []
    for n in ORDERS:
        size = max(0, codes.size - n + 1)
        value = np.full(size, np.uint64(n))
        across = np.zeros(size, bool)
        for j in range(n):
            part = codes[j : j + size]
            value = value * np.uint64(0x100000001B3) + part
            if 0 < j < n - 1:
                across |= part == 32
        out.append(value[~across])
    return mix(np.concatenate(out))


@dataclass
class LanguageFilter:
    """Bit rows of a Bloom filter, sliced by language: row r holds one bit per language.

    ``rows[w, r]`` is the w-th word of 64 languages. The size is fixed by
    ``slots`` and the number of languages, whatever the corpus.
    """

    languages: list[str]
    slots: int = 1 << 18
    probes: int = 3
    rows: np.ndarray = field(default=None)  # type: ignore[assignment]

    def __post_init__(self) -> None:
        if self.rows is None:
            self.rows = np.zeros((max(1, -(-len(self.languages) // 64)), self.slots), np.uint64)

    def places(self, grams: np.ndarray) -> list[np.ndarray]:
        step = grams >> np.uint64(32) | np.uint64(1)
        return [((grams + step * np.uint64(i)) % np.uint64(self.slots)).astype(np.int64) for i in range(self.probes)]

    def add(self, language: int, grams: np.ndarray) -> None:
        bit = np.uint64(1) << np.uint64(language % 64)
        for place in self.places(grams):
            self.rows[language // 64, place] |= bit

    def false_rates(self) -> np.ndarray:
        """Per language, how likely an n-gram that it does not have passes all probes."""
        fill = [
            float(np.mean(self.rows[i // 64] >> np.uint64(i % 64) & np.uint64(1))) for i in range(len(self.languages))
        ]
        return np.array(fill) ** self.probes

    def counts(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per language: n-grams of the text that it has, and those that it has and not all others have."""
        places = self.places(grams)
        all_bits, some = [], np.zeros(grams.size, bool)
        for w in range(self.rows.shape[0]):
            bits = self.rows[w, places[0]]
            for place in places[1:]:
                bits = bits & self.rows[w, place]
            full = np.uint64((1 << min(64, len(self.languages) - 64 * w)) - 1)
            some |= bits != full
            all_bits.append(bits)
        held = np.zeros(len(self.languages), np.int64)
        telling = np.zeros(len(self.languages), np.int64)
        for i in range(len(self.languages)):
            one = (all_bits[i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
            held[i], telling[i] = np.count_nonzero(one), np.count_nonzero(one & some)
        return held, telling

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, and the share of the text's n-grams that the language has.

        Counts are corrected by the expected number of false positives. The
        score is the language's part of the corrected counts of telling n-grams;
        ties go to the language that comes first by code point.
        """
        grams = gram_hashes(text) if text else np.empty(0, np.uint64)
        if not grams.size or not self.languages:
            return UNDETERMINED, 0.0, 0.0
        rate = self.rates
        held, telling = self.counts(grams)
        true = np.clip((held - rate * grams.size) / (1 - rate), 0, None)
        told = np.clip(telling - rate * grams.size, 0, None)
        basis = told if told.sum() > 0 else true
        best = int(np.argmax(basis))
        total = float(basis.sum())
        score = float(basis[best]) / total if total > 0 else 1.0 / len(self.languages)
        return self.languages[best], min(1.0, score), min(1.0, float(true[best]) / grams.size)

    @property
    def rates(self) -> np.ndarray:
        if not hasattr(self, "_rates"):
            self._rates = np.minimum(self.false_rates(), 0.999999)
        return self._rates


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learning_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """A sample of the rows to learn from, of about ``per_language`` documents a language, chosen by a hash of the id."""
    rows = docs.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null and text is not null")
    rows = rows.where(~held_out())
    #: One row per language; the filter holds all languages anyway.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    sizes = docs.sparkSession.createDataFrame(sizes, "_lang string, n bigint")
    place = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(sizes, rows["lang"] == sizes["_lang"])
    return chosen.where(place < F.lit(float(per_language)) / F.col("n")).select("text", "lang")


def learn_filter(docs: DataFrame, per_language: int = 1500, grams: int = 2000, slots: int = 1 << 18) -> LanguageFilter:
    """Per language, the ``grams`` most frequent n-grams that occur more than once, in one filter.

    Learns from documents outside the held-out fold only, a bounded sample of
    ``per_language`` a language. What comes to the driver is at most ``grams``
    numbers a language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                pieces = [gram_hashes(t) for t in texts]
                values, n = np.unique(np.concatenate(pieces), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": values.view(np.int64), "n": n.astype(np.int64)})

    counted = learning_rows(docs, per_language).mapInPandas(count, "lang string, gram bigint, n bigint")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("rank", rank).where(F.col("rank") <= grams).select("lang", "gram").toPandas()
    languages = sorted(best["lang"].unique(), key=lambda s: s.encode())
    out = LanguageFilter(languages, slots)
    for i, language in enumerate(languages):
        out.add(i, best.loc[best["lang"] == language, "gram"].to_numpy(np.int64).view(np.uint64))
    return out


def predicted(spark: SparkSession, learned: LanguageFilter) -> Callable[[str], Column]:
    """A function of a text column that gives a struct ``lang_pred, score, coverage``."""
    shared = spark.sparkContext.broadcast(learned)

    @F.pandas_udf("lang_pred string, score double, coverage double")
    def apply(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        rows = [model.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "coverage"])

    return apply


def identify_languages(docs: DataFrame, learned: LanguageFilter | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, coverage``, one row per row of ``docs``; the whole text is read.

    Learns from ``docs`` if no filter is given; then ``docs`` needs ``lang``.
    ``lang_pred`` is ``und``, with score 0, if the text is null or has no letter,
    or if nothing could be learned. Rows with null id are neither learned from
    nor held out. Repeated rows are predicted alike. Languages are any number;
    64 of them share a word of the filter. An empty table gives an empty one.
    """
    learned = learned or learn_filter(docs)
    out = docs.select("doc_id", held_out().alias("held_out"), predicted(docs.sparkSession, learned)("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.coverage")


def keep_known_languages(docs: DataFrame, learned: LanguageFilter | None = None, least_coverage: float = 0.2) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language; all columns stay as they are.

    Rejected are ``und`` and texts of which the best language has less than
    ``least_coverage`` of the n-grams.
    """
    learned = learned or learn_filter(docs)
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        rows = [shared.value.predict(t) for t in texts]
        return pd.Series([lang != UNDETERMINED and coverage >= least_coverage for lang, _, coverage in rows], dtype=bool)

    return docs.where(known("text"))
