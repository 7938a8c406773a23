"""Language-model scoring: the difference of per-token losses of a target and a background n-gram model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import write_through

#: Cells of three tokens below this are counted and looked up in one array of its third power; it bounds no vocabulary.
DENSE = 128
#: So many of the most frequent cells are sent to the tasks; texts meet the probabilities of all others in a shuffle.
HELD = 1 << 21
#: Weights of trigram, bigram and smoothed unigram.
MIXING = (0.6, 0.3, 0.1)
_PART = 1 << 20


def character_counts(texts: DataFrame) -> DataFrame:
    """``token, n``: how often each code point of the lower-cased texts occurs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for text in batch["text"]:
                codes = _codes(text)
                if codes.size:
                    seen = np.bincount(codes)
                    total[: seen.size] += seen
        token = np.flatnonzero(total)
        yield pd.DataFrame({"token": token, "n": total[token]})

    counted = texts.select("text").where("text is not null").mapInPandas(count, "token bigint, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def vocabulary(texts: DataFrame, size: int | None = None) -> tuple[np.ndarray, int]:
    """Token number by code point, the most frequent first, ties by code point; and how many tokens there are with token 0.

    Every character of ``texts`` is a token, unless ``size`` asks for the
    ``size - 1`` most frequent only. A table of code points is all that comes to
    the driver, however large the corpus.
    """
    counts = character_counts(texts).toArrow()
    token, n = (counts.column(c).to_numpy() for c in ("token", "n"))
    best = token[np.lexsort((token, -n))][: size - 1 if size else None]
    size = size or best.size + 1
    number = np.zeros(0x110000, np.uint8 if size <= 1 << 8 else np.uint16 if size <= 1 << 16 else np.uint32)
    number[best] = np.arange(1, best.size + 1)
    return number, size


def trigrams(text: str | None, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells ``(a * base + b) * base + c`` of a text, which two tokens 0 precede.

    First those of tokens below ``DENSE``, by that base (or ``size``, if it is
    less), then those with another token, by the base ``size``.
    """
    tokens = number[_codes(text)] if text else number[:0]
    tokens = np.concatenate((np.zeros(2, np.int32), tokens.astype(np.int32)))
    dense = min(size, DENSE)
    far = tokens >= dense
    if not far.any():
        return _cells(tokens, dense), np.empty(0, np.int64)
    tokens, far = tokens.astype(np.int64), far[:-2] | far[1:-1] | far[2:]
    return _cells(tokens, dense)[~far], _cells(tokens, size)[far]


def _cells(tokens: np.ndarray, base: int) -> np.ndarray:
    return (tokens[:-2] * base + tokens[1:-1]) * base + tokens[2:]


def spread(near: np.ndarray, size: int) -> np.ndarray:
    """Cells of tokens below ``DENSE``, by the base ``size``."""
    dense = min(size, DENSE)
    return (near // dense**2 * size + near // dense % dense) * size + near % dense


def trigram_counts(texts: DataFrame, number: np.ndarray, size: int) -> DataFrame:
    """``cell, n`` of every cell that occurs in ``texts``: counts to be added up by cell.

    A task adds up frequent tokens' cells in one array, and hands on those of
    others part by part.
    """
    shared = texts.sparkSession.sparkContext.broadcast(number)
    dense = min(size, DENSE)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(dense**3, np.int64)

        def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            held, waiting = [], 0
            for batch in batches:
                for text in batch["text"]:
                    held.append(trigrams(text, shared.value, size))
                    waiting += held[-1][0].size + held[-1][1].size
                    if waiting > _PART:
                        yield tuple(map(np.concatenate, zip(*held, strict=True)))
                        held, waiting = [], 0
            if held:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))

        for near, far in parts():
            total += np.bincount(near, minlength=dense**3)
            if far.size:
                cell, n = np.unique(far, return_counts=True)
                yield pd.DataFrame({"cell": cell, "n": n})
        cell = np.flatnonzero(total)
        yield pd.DataFrame({"cell": spread(cell, size), "n": total[cell]})

    return texts.select("text").where("text is not null").mapInPandas(count, "cell bigint, n bigint")


def log_probabilities(target: DataFrame, background: DataFrame, size: int, mixing: tuple[float, float, float] = MIXING) -> DataFrame:
    """``cell, n, goal, back`` of all cells of ``background (cell, n)``: log of P(c | a, b) under the models of both tables.

    Counts of a cell may be in several rows. Trigram, bigram and smoothed unigram are mixed; a context that was never seen
    leaves its part to the order below. Sums over contexts are made where the
    cells are, those over single tokens are a row a token at most.
    """
    zero = F.lit(0).cast("bigint")
    both = background.select("cell", F.col("n").alias("back"), zero.alias("goal")).unionByName(
        target.select("cell", zero.alias("back"), F.col("n").alias("goal"))
    )
    names = ("goal", "back")
    both = write_through(both.groupBy("cell").agg(*[F.sum(x).alias(x) for x in names]), "cells")
    totals = both.agg(*[F.coalesce(F.sum(x), zero).alias(x) for x in names]).first()
    head, one = F.expr(f"cell div {size}L % {size}L"), F.expr(f"cell % {size}L")
    out = both
    for key, name in ((f"cell div {size}L", "context"), (f"cell % {size * size}L", "two")):
        out = out.withColumns({f"{name}_{x}": F.sum(x).over(Window.partitionBy(F.expr(key))) for x in names})
    for key, name in ((head, "head"), (one, "one")):
        sums = both.groupBy(key.alias(name)).agg(*[F.sum(x).alias(f"{name}_{x}") for x in names])
        out = out.withColumn(name, key).join(F.broadcast(sums), name)

    def mixed(weight: float, part: Column, whole: Column, below: Column) -> Column:
        return F.when(whole > 0, weight * part / F.greatest(whole, F.lit(1)) + (1 - weight) * below).otherwise(below)

    def log_of(x: str) -> Column:
        one = (F.col(f"one_{x}") + 1.0) / (totals[x] + size)
        two = mixed(mixing[1] / (mixing[1] + mixing[2]), F.col(f"two_{x}"), F.col(f"head_{x}"), one)
        return F.log(mixed(mixing[0], F.col(x), F.col(f"context_{x}"), two)).cast("float")

    return out.where("back > 0").select("cell", F.col("back").alias("n"), log_of("goal").alias("goal"), log_of("back").alias("back"))


def least_count(table: DataFrame, most: int) -> int:
    """The least count of which, with all higher ones, ``table`` has ``most`` cells at most."""
    counts = table.groupBy("n").count().toArrow()
    n, cells = (counts.column(c).to_numpy() for c in ("n", "count"))
    order = np.argsort(-n)
    fit = int((np.cumsum(cells[order]) <= most).sum())
    return 0 if fit == n.size else int(n[order][fit]) + 1


def held_cells(table: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities by cell of tokens below ``DENSE`` (NaN where ``table`` has none); and other cells, sorted, with theirs."""
    rows = table.select("cell", "goal", "back").toArrow()
    cells, *logs = (rows.column(c).to_numpy() for c in ("cell", "goal", "back"))
    order = np.argsort(cells)
    cells, logs = cells[order], np.stack(logs, 1)[order]
    dense = min(size, DENSE)
    a, b, c = cells // size**2, cells // size % size, cells % size
    near = (a < dense) & (b < dense) & (c < dense)
    known = np.full((dense**3, 2), np.nan, np.float32)
    known[((a * dense + b) * dense + c)[near]] = logs[near]
    return known, cells[~near], logs[~near]


def score_documents(docs: DataFrame, target: DataFrame, size: int | None = None, held: int = HELD) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` per row of ``docs``.

    A token is a character. Losses are mean negative log probabilities per token
    under a model of ``target (text)`` and one of all of ``docs (doc_id, text)``;
    both models have the vocabulary of ``docs``, which is every character that
    occurs there unless ``size`` bounds it, the same orders and the same
    smoothing. ``score`` is target less background loss: the lower, the more a
    text is like the target. Whole texts are counted and scored; characters and
    trigrams are counted in every task and added up in a shuffle. The ``held`` most
    frequent cells are looked up in the tasks, the others are joined.

    Null and empty texts have no tokens, losses and score null. Equal rows are
    counted and scored each. Without target texts the target model is uniform.
    An empty table gives an empty one.
    """
    number, size = vocabulary(docs, size)
    table = write_through(log_probabilities(trigram_counts(target, number, size), trigram_counts(docs, number, size), size), "trigrams")
    least = least_count(table, held)
    shared = docs.sparkSession.sparkContext.broadcast((number, *held_cells(table.where(F.col("n") >= least), size)))

    @F.pandas_udf("n_tokens long, goal double, back double, cells array<long>, counts array<int>")
    def sums(texts: pd.Series) -> pd.DataFrame:
        numbers, dense, cells, logs = shared.value
        rows = []
        for text in texts:
            near, far = trigrams(text, numbers, size) if text else (np.empty(0, np.int64),) * 2
            found = dense.take(near, 0)
            left = []
            if far.size:
                at = np.searchsorted(cells, far)
                there = at < cells.size
                there[there] = cells[at[there]] == far[there]
                left.append(far[~there])
                found = np.concatenate((found, logs[at[there]]))
            total = found.sum(0, np.float64)
            if np.isnan(total[0]):
                left.append(spread(near[np.isnan(found[: near.size, 0])].astype(np.int64), size))
                total = np.nansum(found, 0, np.float64)
            left = np.concatenate(left) if left else far
            rows.append((near.size + far.size, *total, *(np.unique(left, return_counts=True) if left.size else (None, None))))
        return pd.DataFrame(rows, columns=["n_tokens", "goal", "back", "cells", "counts"])

    out = docs.select("doc_id", sums("text").alias("l")).select("doc_id", "l.*")
    if least:
        out = with_rare_cells(out, table.where(F.col("n") < least))
    goal, back = (F.when(F.col("n_tokens") > 0, -F.col(x) / F.greatest("n_tokens", F.lit(1))) for x in ("goal", "back"))
    out = out.select("doc_id", "n_tokens", goal.alias("target_loss"), back.alias("background_loss"))
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def with_rare_cells(sums: DataFrame, table: DataFrame) -> DataFrame:
    """``sums`` with the log probabilities of ``cells``, ``counts`` times each, added to ``goal`` and ``back``.

    Rows are numbered as they are written, so that equal ones stay apart.
    """
    kept = write_through(sums.withColumn("row", F.monotonically_increasing_id()), "sums")
    each = kept.where("cells is not null").select("row", F.inline(F.arrays_zip("cells", "counts"))).withColumnRenamed("cells", "cell")
    more = each.join(table.select("cell", F.col("goal").alias("g"), F.col("back").alias("b")), "cell").groupBy("row").agg(
        *[F.sum(F.col(x) * F.col("counts")).alias(f"{x}_more") for x in ("g", "b")]
    )
    joined = kept.join(more, "row", "left")
    return joined.withColumns({x: F.col(x) + F.coalesce(f"{x[0]}_more", F.lit(0.0)) for x in ("goal", "back")})


def labelled_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of all documents that ``labels (doc_id, quality, toxic)`` calls good and not toxic.

    The target has no bound: ids and texts meet in a shuffle by id, at every size.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return docs.select("doc_id", "text").join(good.hint("shuffle_hash"), "doc_id", "left_semi").select("text")
