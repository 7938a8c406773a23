"""Distribution profiles: summary statistics, correlation, histogram, density, box."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import bin_index, has_value
from tidemark.operators.keyed_joins import attach, settle
from tidemark.operators.quantiles import quantile_row
from tidemark.sources.files import inline_table


def summary_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed ``(column, count, mean, stddev, min, max)``; all columns in one scan."""
    wide = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.unpivot([], list(columns), "column", "s").select("column", "s.*")


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], missing: Mapping[str, float] | None = None
) -> DataFrame:
    """Pearson ``(col_x, col_y, corr)`` for every ordered pair, null without variance.

    Two scans, run when the function is called. The first takes means and
    counts, the second sums products of centred values. Complete columns share
    their sums among all pairs, which keeps the aggregate small enough to be
    compiled; a pair with an incomplete column has sums of its own over the rows
    where both values are present. ``missing`` names sentinel values (such as -1
    for "never") to leave out.
    """
    missing = missing or {}

    def present(c: str) -> Column:
        value = F.col(c).cast("double")
        is_value = ~F.isnan(value)
        return F.when(is_value & (value != missing[c]) if c in missing else is_value, value)

    places = range(len(columns))
    shown = df.select(*[present(c).alias(f"c{i}") for i, c in enumerate(columns)])
    known = shown.selectExpr(
        "count(1) AS n", *[f"count(c{i}) AS n{i}" for i in places],
        *[f"avg(c{i}) AS m{i}" for i in places],
    ).first()
    n = known["n"]
    complete = {i for i in places if known[f"n{i}"] == n}

    def centred(i: int) -> str:
        mean = known[f"m{i}"]
        shift = f"c{i} - {mean!r}D" if mean is not None and math.isfinite(mean) else f"c{i}"
        return f"coalesce({shift}, 0D)" if i in complete else shift

    pairs = [(i, j) for i in places for j in places if i <= j]
    sums = {f"s{i}": f"sum(d{i})" for i in complete}
    for i, j in pairs:
        sums[f"xy{i}_{j}"] = f"sum(d{i} * d{j})"
        if not complete.issuperset((i, j)):
            sums[f"n{i}_{j}"] = f"count(d{i} * d{j})"
            for name, value, other in (("x", i, j), ("y", j, i)):
                sums[f"{name}{i}_{j}"] = f"sum(if(d{other} IS NULL, NULL, d{value}))"
                sums[f"{name}{name}{i}_{j}"] = f"sum(if(d{other} IS NULL, NULL, d{value} * d{value}))"
    totals = (
        shown.selectExpr(*[f"{centred(i)} AS d{i}" for i in places])
        .selectExpr(*[f"{e} AS {name}" for name, e in sums.items()])
        .first()
    )

    def coefficient(i: int, j: int) -> float | None:
        if complete.issuperset((i, j)):
            rows, x, y = n, totals[f"s{i}"], totals[f"s{j}"]
            xx, yy, xy = (totals[f"xy{a}_{b}"] for a, b in ((i, i), (j, j), (i, j)))
        else:
            rows, x, y, xx, yy, xy = (
                totals[f"{name}{i}_{j}"] for name in ("n", "x", "y", "xx", "yy", "xy")
            )
        if not rows:
            return None
        spreads = [max(square - total * total / rows, 0.0) for square, total in ((xx, x), (yy, y))]
        scale = math.sqrt(spreads[0]) * math.sqrt(spreads[1])
        return (xy - x * y / rows) / scale if scale > 0 else None

    found = {p: coefficient(*p) for p in pairs}
    cells = [
        (columns[i], columns[j], found[min(i, j), max(i, j)]) for i in places for j in places
    ]
    return inline_table(df.sparkSession, cells, "col_x string, col_y string, corr double")


# Beyond this z, exp(-z * z / 2) is zero as a double: no part of the sum is cut.
KERNEL_REACH = 39.0


def _range_of(df: DataFrame, *measures: str) -> dict[str, tuple[Column, Column]]:
    """Minimum and maximum of each measure as constants; one scan, run when called."""
    row = df.agg(
        *[end(F.when(has_value(m), F.col(m).cast("double"))).alias(f"{name}{i}")
          for i, m in enumerate(measures) for name, end in (("min", F.min), ("max", F.max))]
    ).first()
    return {
        m: (F.lit(row[f"min{i}"]).cast("double"), F.lit(row[f"max{i}"]).cast("double"))
        for i, m in enumerate(measures)
    }


def histogram(df: DataFrame, measure: str, bins: int) -> DataFrame:
    """``(bin, bin_low, bin_high, count)`` over equal-width bins, empty ones included.

    A constant column is put in a range of width 1 around its value.
    """
    lo, hi = _range_of(df, measure)[measure]
    flat = lo == hi
    low, high = F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, hi + 0.5).otherwise(hi)
    x = F.col(measure).cast("double")
    # a zero for every bin makes the empty ones appear without a join
    none = df.sparkSession.range(bins).select(F.col("id").alias("bin"), F.lit(0).alias("n"))
    filled = df.where(has_value(measure)).select(
        bin_index(x, low, high, bins).alias("bin"), F.lit(1).alias("n")
    )
    width = (high - low) / bins
    return (
        filled.unionByName(none)
        .groupBy("bin")
        .agg(F.sum("n").alias("count"))
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_low"),
            (low + (F.col("bin") + 1) * width).alias("bin_high"),
            "count",
        )
    )


def density(
    df: DataFrame,
    measure: str,
    by: Sequence[str] = (),
    points: int = 200,
    combine_equal: bool = True,
) -> DataFrame:
    """Gaussian kernel density ``(*by, point, x, density)`` on an even grid.

    Bandwidth ``n ** (-1/5) * stddev_samp``, grid from minimum to maximum. Inside
    its task a value meets the grid points that its kernel reaches at double
    precision (with more rows the bandwidth shrinks, down to a point or two), and
    the sums combine there, so ``points`` rows per group and task are shuffled.
    ``combine_equal`` first merges equal values, right for whole numbers and
    money; turn it off where almost every value is different.
    """
    keys = list(by)
    rows = df.where(has_value(measure)).select(*keys, F.col(measure).cast("double").alias("v"))
    low, high, n = F.min("v"), F.max("v"), F.count(F.lit(1))
    stats = settle(
        rows.groupBy(*keys).agg(
            n.alias("n"),
            F.nullif(F.pow(n.cast("double"), F.lit(-0.2)) * F.stddev_samp("v"), F.lit(0.0))
            .alias("h"),
            low.alias("lo"),
            ((high - low) / (points - 1)).alias("step"),
        ),
        bounded=not keys,
    )
    if combine_equal:
        weighted = rows.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("w"))
    else:
        weighted = rows.withColumn("w", F.lit(1))
    v, lo, step, h = F.col("v"), F.col("lo"), F.col("step"), F.col("h")
    reach = KERNEL_REACH * h
    near = (
        attach(weighted, stats.where("h > 0"), keys)
        .withColumn("from", F.greatest(F.ceil((v - reach - lo) / step), F.lit(0)))
        .withColumn("to", F.least(F.floor((v + reach - lo) / step), F.lit(points - 1)))
        .where(F.col("from") <= F.col("to"))
        .select(*keys, "v", "w", "lo", "step", "h",
                F.explode(F.sequence("from", "to")).alias("point"))
    )
    z = (lo + F.col("point") * step - v) / h
    mass = near.groupBy(*keys, "point").agg(
        F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("mass")
    )
    grid = stats.select(
        *keys, "n", "h", "lo", "step",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1)).cast("array<bigint>")).alias("point"),
    )
    return attach(grid, mass, [*keys, "point"], "left").select(
        *keys, "point", (lo + F.col("point") * step).alias("x"),
        (F.coalesce("mass", F.lit(0.0)) / (F.col("n") * h * math.sqrt(2 * math.pi)))
        .alias("density"),
    )


def box_statistics(
    df: DataFrame, measure: str, by: Sequence[str] = (), whisker: float = 1.5
) -> DataFrame:
    """Quartiles, whiskers and number of outliers per group.

    Whiskers end at the outermost values within ``whisker`` times the
    interquartile range of the box, or at the box if there are none.
    """
    keys = list(by)
    rows = df.where(has_value(measure)).select(*keys, F.col(measure).cast("double").alias("v"))
    quartiles = quantile_row(rows, "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    placed = attach(rows, quartiles, keys)
    reach = whisker * (F.col("q3") - F.col("q1"))
    low_fence, high_fence = F.col("q1") - reach, F.col("q3") + reach
    v = F.col("v")
    return (
        placed.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("count"),
            *[F.min(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(v >= low_fence, v)).alias("lowest"),
            F.max(F.when(v <= high_fence, v)).alias("highest"),
            F.count_if((v < low_fence) | (v > high_fence)).alias("outliers"),
        )
        .select(
            *keys, "count", "q1", "median", "q3",
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def binned_pairs(
    df: DataFrame, x: str, y: str, by: str, x_bins: int = 50, y_bins: int = 50
) -> DataFrame:
    """Two measures coloured by class, as counts per ``(x_bin, y_bin, class)`` cell."""
    ranges = _range_of(df, x, y)

    def cell(m: str, bins: int) -> Column:
        return bin_index(F.col(m).cast("double"), *ranges[m], bins)

    return (
        df.where(has_value(x) & has_value(y))
        .groupBy(cell(x, x_bins).alias("x_bin"), cell(y, y_bins).alias("y_bin"), by)
        .agg(F.count(F.lit(1)).alias("count"))
    )
