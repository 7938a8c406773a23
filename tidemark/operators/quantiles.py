"""Exact, linearly interpolated quantiles without sorting or shuffling the rows.

Two column-pruned scans. The first sketches each group; the sketch's known rank
error gives a bracket of values around each wanted rank. The second counts rows
per value inside the brackets and per gap between them, combining on the map
side: what is shuffled are the gaps and the values of a few ten-thousandths of
the rows. Running sums over these entries give the exact ranks. A value that a
third of the rows share is one entry. The result does not depend on how the data
is distributed.

The scans run when the function is called, as with Spark's own
``approxQuantile``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import has_value
from tidemark.operators.keyed_joins import attach, running_sums, settle

# Rank error of the sketch: rows of the group divided by this.
ACCURACY = 10_000


def _wanted_ranks(probs: Sequence[float]) -> str:
    """Both neighbours of each interpolated position among ``total`` values."""
    entries = []
    for p in probs:
        position = f"({p!r}D * (total - 1))"
        for end in ("floor", "ceil"):
            entries.append(
                f"named_struct('prob', {p!r}D, 'fraction', {position} - floor({position}), "
                f"'rank', {end}({position}))"
            )
    return f"array({', '.join(entries)})"


# The wanted ranks that fall into an entry. A gap can only hold one at its edge,
# next to a bracket; its least or greatest value is then the one.
HELD = """
    transform(
      filter(ranks, r -> r.rank >= n_before AND r.rank < n_before + n),
      r -> named_struct(
        'prob', r.prob, 'fraction', r.fraction,
        'x', CASE WHEN r.rank = n_before OR low = high THEN low
                  WHEN r.rank = n_before + n - 1 THEN high
                  ELSE raise_error('rank outside its bracket') END))
"""


def quantiles(
    df: DataFrame,
    measure: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """``(*by, prob, quantile)``: the interpolated quantile at ``prob * (n - 1)``.

    Nulls and NaN are left out; a group without values gives no row.
    """
    keys = list(by)
    one_group = not keys
    probs = sorted({float(p) for p in probs})
    x = F.col("x")
    values = df.where(has_value(measure)).select(*keys, F.col(measure).cast("double").alias("x"))

    slack = 2 / ACCURACY
    edges = [e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = settle(
        values.groupBy(*keys)
        .agg(F.expr("count(1) AS total"), F.percentile_approx("x", edges, ACCURACY).alias("edges"))
        .where("total > 0")
        .select(*keys, "total", *[F.col("edges")[i].alias(f"e{i}") for i in range(len(edges))]),
        one_group,
    )

    placed = attach(values, sketch, keys)
    lows, highs = [F.col(f"e{i}") for i in range(0, len(edges), 2)], [F.col(f"e{i}") for i in range(1, len(edges), 2)]
    inside = reduce(or_, [x.between(low, high) for low, high in zip(lows, highs, strict=True)])
    gap = reduce(add, [F.when(x > high, 1).otherwise(0) for high in highs])
    entries = placed.groupBy(
        *keys, F.when(inside, x).alias("value"), F.when(~inside, gap).alias("gap")
    ).agg(F.expr("count(1) AS n"), F.min("x").alias("low"), F.max("x").alias("high"))
    counted = running_sums(entries.drop("value", "gap"), "low", ["n"], keys)
    found = counted.withColumnRenamed("n_total", "total").withColumn(
        "ranks", F.expr(_wanted_ranks(probs))
    )
    return settle(
        found.select(*keys, F.expr(f"inline({HELD})"))
        .groupBy(*keys, "prob")
        .agg(F.expr("min(x) + (max(x) - min(x)) * min(fraction) AS quantile")),
        one_group,
    )


def quantile_row(
    df: DataFrame, measure: str, names: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles as columns: one row per group, named by ``names``."""
    probs = list(dict.fromkeys(float(p) for p in names.values()))
    long = quantiles(df, measure, probs, by)
    return long.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(name)
            for name, p in names.items()
        ]
    )


def approximate_quantiles(
    df: DataFrame,
    measure: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """One-scan sketch form: rank error at most ``n / accuracy``, no interpolation."""
    found = df.groupBy(*by).agg(
        F.percentile_approx(measure, [float(p) for p in probs], accuracy).alias("qs")
    )
    pairs = F.arrays_zip(
        F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("qs").alias("quantile")
    )
    return found.select(*by, F.inline(pairs).alias("prob", "quantile"))


def trim_to_percentiles(
    df: DataFrame, measure: str, low: float = 0.01, high: float = 0.99, closed: bool = True
) -> DataFrame:
    """Rows between two quantiles of a measure, ends included or not.

    The bounds are two numbers, put into the filter as constants so that it
    reaches the file scan.
    """
    bounds = {r["prob"]: r["quantile"] for r in quantiles(df, measure, [low, high]).collect()}
    x, lowest, highest = F.col(measure), F.lit(bounds.get(low)), F.lit(bounds.get(high))
    if closed:
        return df.where((x >= lowest) & (x <= highest))
    return df.where((x > lowest) & (x < highest))
