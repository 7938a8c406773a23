"""Insight reports as ``(insight, key, value)`` rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import flag, ratio
from tidemark.operators.grouping import append_snapshots, history_peak
from tidemark.operators.models import FOREST, champion
from tidemark.operators.ordering import best_row, top_rows
from tidemark.operators.partitioning import fastest_setting
from tidemark.sources.catalog import table_shape
from tidemark.streaming.live import LiveTable


@dataclass
class ContactColumns:
    """Which columns of a table play the parts of the exploration report."""

    target: str = "y"
    positive: str = "yes"
    negative: str = "no"
    duration: str = "duration"
    balance: str = "balance"
    job: str = "job"
    education: str = "education"
    outcome: str = "poutcome"


def _line(insight: str, key: Column, value: Column) -> Column:
    return F.struct(
        F.lit(insight).alias("insight"),
        key.cast("string").alias("key"),
        value.cast("double").alias("value"),
    )


def _lines(df: DataFrame, *lines: Column) -> DataFrame:
    return df.select(F.inline(F.array(*lines)))


def exploration_report(df: DataFrame, columns: ContactColumns | None = None) -> DataFrame:
    """Overall rate, average duration by class, best education, job and outcome.

    One scan: grouping sets compute all four groupings and the total together,
    and the best row of each is taken from the grouped rows. Rates are rounded
    to 2 digits and durations to 1 before they are ranked; ties go to the name
    that sorts first.
    """
    c = columns or ContactColumns()
    keys = [c.target, c.education, c.job, c.outcome]
    grouped = df.groupingSets([[k] for k in keys] + [[]], *keys).agg(
        F.grouping_id().alias("grouping"),
        F.round(
            ratio(100 * F.sum(flag(F.col(c.target) == c.positive)), F.count(F.lit(1)), None), 2
        ).alias("rate"),
        F.round(F.avg(c.duration), 1).alias("avg_duration"),
        F.round(F.avg(c.balance), 2).alias("avg_balance"),
    )
    # grouping_id has a 0 bit for the grouped key, the first key being the highest
    everything = (1 << len(keys)) - 1
    of = {k: everything - (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}

    def best(key: str, by: str) -> Column:
        return F.min(
            F.when(
                (F.col("grouping") == of[key]) & F.col(key).isNotNull(),
                F.struct((-F.col(by)).alias("minus"), F.col(key).alias("name")),
            )
        )

    def duration_of(value: str) -> Column:
        is_it = (F.col("grouping") == of[c.target]) & (F.col(c.target) == value)
        return F.max(F.when(is_it, F.col("avg_duration")))

    found = grouped.agg(
        F.max(F.when(F.col("grouping") == everything, F.col("rate"))).alias("rate"),
        duration_of(c.positive).alias("d_pos"),
        duration_of(c.negative).alias("d_neg"),
        best(c.education, "rate").alias("education"),
        best(c.job, "avg_balance").alias("job"),
        best(c.outcome, "rate").alias("outcome"),
    )
    return _lines(
        found,
        _line("overall_rate_pct", F.lit(c.positive), F.col("rate")),
        _line("avg_duration", F.lit(c.positive), F.col("d_pos")),
        _line("avg_duration", F.lit(c.negative), F.col("d_neg")),
        _line("best_education_rate_pct", F.col("education.name"), -F.col("education.minus")),
        _line("best_job_avg_balance", F.col("job.name"), -F.col("job.minus")),
        _line("best_outcome_rate_pct", F.col("outcome.name"), -F.col("outcome.minus")),
    )


def modelling_report(
    comparison: DataFrame, importances: DataFrame, detail: str = FOREST, top: int = 5
) -> DataFrame:
    """Champion, each model's metrics, precision and recall, leading features."""
    metrics = _lines(
        comparison,
        *[_line(m, F.col("model"), F.col(m)) for m in ("auc", "accuracy", "f1")],
    )
    best = _lines(champion(comparison), _line("champion_auc", F.col("model"), F.col("auc")))
    positives = _lines(
        comparison.where(F.col("model") == detail),
        *[_line(m, F.col("model"), F.col(m)) for m in ("precision", "recall")],
    )
    leading = top_rows(importances, top, "importance", "feature", rank_as=None)
    features = _lines(leading, _line("top_feature", F.col("feature"), F.col("importance")))
    return append_snapshots(best, metrics, positives, features)


def streaming_report(table: LiveTable, key: str, average: str) -> DataFrame:
    """Rows streamed, number of batches, and the busiest segment."""
    history = table.history(average)
    total = _lines(
        history_peak(history, "total_txns"), _line("total_streamed", F.lit("all"), F.col("peak"))
    )
    batches = _lines(
        history_peak(history, "batch"), _line("batches", F.lit("all"), F.col("peak"))
    )
    busiest = _lines(
        best_row(table.current(), "txn_count", key),
        _line("top_segment_txns", F.col(key), F.col("txn_count")),
        _line("top_segment_avg", F.col(key), F.col(average)),
    )
    return append_snapshots(total, batches, busiest)


def final_summary(
    data: DataFrame,
    exploration: DataFrame,
    modelling: DataFrame,
    streaming: DataFrame,
    timings: DataFrame,
) -> DataFrame:
    """Table shape, the three reports and the fastest partition count."""
    shape = _lines(
        table_shape(data),
        _line("rows", F.lit("data"), F.col("rows")),
        _line("columns", F.lit("data"), F.col("columns")),
    )
    fastest = _lines(
        fastest_setting(timings),
        _line("fastest_partitions", F.lit("sweep"), F.col("partitions")),
        _line("fastest_seconds", F.lit("sweep"), F.col("time_sec")),
    )
    return append_snapshots(shape, exploration, modelling, streaming, fastest)
