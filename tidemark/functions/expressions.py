"""Column expressions shared by the operators; all are built-in, codegen-friendly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.sources.schemas import MONTHS


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Division that yields ``default`` where the denominator is zero."""
    return F.when(denominator != 0, numerator / denominator).otherwise(
        F.lit(default).cast("double")
    )


def percent_of_rows(condition: Column, digits: int = 2) -> Column:
    """Aggregate: share of the group's rows that meet the condition, 0 to 100."""
    return F.round(ratio(100 * F.sum(flag(condition)), F.count(F.lit(1)), None), digits)


def title_case(text: Column) -> Column:
    """Capitalise each run of letters, so ``blue-collar`` gives ``Blue-Collar``.

    ``initcap`` only looks at white space, hence the split into runs.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substring(run, 2, 1 << 30))),
        ),
        "",
    )


def month_name(moment: Column) -> Column:
    """Lower-case three-letter month of a date or timestamp."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(moment))


def category_position(value: Column, order: Sequence[str]) -> Column:
    """1-based place of a value in an ordered category list, null if not in it."""
    return F.nullif(
        F.array_position(F.array(*[F.lit(v) for v in order]), value), F.lit(0)
    )


def month_number(month: Column) -> Column:
    """1 to 12 for a lower-case month abbreviation, null for anything else."""
    return category_position(month, MONTHS)


def bin_index(x: Column, low: Column, high: Column, bins: int | Column) -> Column:
    """Equal-width bin of ``x`` in ``[low, high]``, the last bin closed on the right.

    A range of zero width is one bin, number 0.
    """
    count = F.lit(bins) if isinstance(bins, int) else bins
    position = F.floor((x - low) / (high - low) * count)
    return F.when(high > low, F.least(position, (count - 1).cast("bigint"))).otherwise(
        F.lit(0).cast("bigint")
    )


def has_value(name: str) -> Column:
    """Whether a number is there: neither null nor NaN. All profiles and metrics leave out the others."""
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
