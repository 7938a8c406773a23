"""Headline timings. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once untimed, then ``BENCH_RUNS`` times; the median counts.
Model training and the stream replay run once. With ``--compare`` the same
results are also computed by collecting rows into pandas on the driver, the
usual single-node way, and reported under ``driver_pandas``.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.expressions import month_name  # noqa: E402
from tidemark.operators import grouping as g  # noqa: E402
from tidemark.operators import metrics as m  # noqa: E402
from tidemark.operators import profile as p  # noqa: E402
from tidemark.operators.models import (  # noqa: E402
    FOREST,
    LOGISTIC,
    fit_models,
    logistic_regression,
    random_forest,
)
from tidemark.operators.partitioning import SWEEP_COUNTS, spread_evenly, timed  # noqa: E402
from tidemark.operators.quantiles import quantiles, trim_to_percentiles  # noqa: E402
from tidemark.operators.sampling import keyed_split  # noqa: E402
from tidemark.plans.reports import exploration_report  # noqa: E402
from tidemark.plans.streams import replayed  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sources.contacts import contacts_from_orders  # noqa: E402
from tidemark.sources.files import read_table  # noqa: E402
from tidemark.sources.schemas import CATEGORICAL, NUMERIC, POSITIVE, TARGET  # noqa: E402

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus),
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
         "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    customer = read_table(spark, sf_dir, "customer")
    orders = read_table(spark, sf_dir, "orders")
    lines = read_table(spark, sf_dir, "lineitem")
    events = read_table(spark, sf_dir, "events")
    done = F.col("o_orderstatus") == "F"
    monthly = orders.select("o_totalprice", month_name(F.col("o_orderdate")).alias("month"))
    scored = orders.select(
        done.cast("int").alias("label"), (F.col("o_totalprice") > 250000).cast("int").alias("guess"),
        F.col("o_totalprice").alias("score"),
    )
    two_keys = ["l_returnflag", "l_linestatus"]
    averaged = ["l_quantity", "l_extendedprice"]

    queries = {
        "q1_segment_summary": lambda: run(
            g.segment_summary(customer, "c_mktsegment", "c_acctbal", F.col("c_acctbal") < 0)
        ),
        "q2_rate_by_priority": lambda: run(g.rate_by(orders, "o_orderpriority", done)),
        "q3_volume_by_month": lambda: run(g.volume_by(monthly, "month", "o_totalprice")),
        "d3_two_key_frequency": lambda: run(g.frequency(lines, *two_keys)),
        "d9_summary_statistics": lambda: run(p.summary_statistics(lines, MEASURES)),
        "d11_cross_tab": lambda: run(
            g.cross_tab(orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
        ),
        "d12_correlation": lambda: run(p.correlation_matrix(lines, MEASURES)),
        "d13_quantiles": lambda: run(quantiles(lines, "l_extendedprice", [0.01, 0.99])),
        "d14_histogram": lambda: run(p.histogram(lines, "l_extendedprice", 40)),
        "b5_trim": lambda: run(
            trim_to_percentiles(lines.select("l_extendedprice"), "l_extendedprice", closed=False)
        ),
        "d15_density": lambda: run(p.density(lines, "l_extendedprice")),
        "d16_box": lambda: run(p.box_statistics(events, "value", ["event_type"])),
        "i12_scores": lambda: run(m.classification_scores(scored, "label", "guess")),
        "i14_roc": lambda: run(m.roc_curve(scored, "label", "score")),
        "i14_auc": lambda: run(m.exact_auc(scored, "label", "score")),
        "m1_exploration_report": lambda: run(
            exploration_report(contacts_from_orders(spark, sf_dir))
        ),
    }
    cached = lines.select(*two_keys, *averaged).persist()
    cached.count()
    for n in SWEEP_COUNTS:
        queries[f"l2_sweep_{n}"] = lambda n=n: run(
            g.keyed_averages(spread_evenly(cached, n), two_keys, averaged)
        )

    seconds = {}
    for name, action in queries.items():
        action()
        seconds[name] = timed(action, runs)
    cached.unpersist()

    start = time.perf_counter()
    live = replayed(spark, sf_dir)
    run(live.history("avg_value"))
    seconds["j1_stream_replay"] = time.perf_counter() - start
    rows = events.count()

    folder = scratch_path(spark, "bench-contacts")
    contacts_from_orders(spark, sf_dir, keep_key=True).write.parquet(folder)
    train, test = keyed_split(spark.read.parquet(folder), "contact_id")
    for key, name, estimator in (
        ("i7_logistic_regression", LOGISTIC, logistic_regression()),
        ("i8_random_forest", FOREST, random_forest()),
    ):
        start = time.perf_counter()
        fitted = fit_models(train, CATEGORICAL, NUMERIC, TARGET, POSITIVE, {name: estimator}, key="contact_id")
        run(fitted.score(test, name).select("prediction", "p_positive"))
        seconds[key] = time.perf_counter() - start

    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
        "stream_rows_per_sec": round(rows / seconds["j1_stream_replay"]),
    }
    if "--compare" in sys.argv:
        result["driver_pandas"] = compare(spark, lines, orders, events, runs)
    print(json.dumps(result))


def compare(spark, lines, orders, events, runs) -> dict[str, float]:
    """The same results computed on the driver from collected rows."""
    import numpy as np

    def histogram():
        np.histogram(lines.select("l_extendedprice").toPandas()["l_extendedprice"], bins=40)

    def trim():
        frame = lines.select("l_extendedprice").toPandas()
        x = frame["l_extendedprice"]
        return frame[(x > x.quantile(0.01)) & (x < x.quantile(0.99))]

    def roc():
        frame = orders.select("o_totalprice", "o_orderstatus").toPandas()
        frame = frame.sort_values("o_totalprice", ascending=False)
        hit = (frame["o_orderstatus"] == "F").to_numpy()
        return np.cumsum(hit), np.cumsum(~hit)

    def density():
        x = lines.select("l_extendedprice").toPandas()["l_extendedprice"].to_numpy()
        grid = np.linspace(x.min(), x.max(), 200)
        h = len(x) ** -0.2 * x.std(ddof=1)
        return [np.exp(-0.5 * ((at - x) / h) ** 2).sum() for at in grid]

    actions = {
        "d9_summary_statistics": lambda: lines.select(*MEASURES).toPandas().describe(),
        "d12_correlation": lambda: lines.select(*MEASURES).toPandas().corr(),
        "d14_histogram": histogram,
        "b5_trim": trim,
        "d15_density": density,
        "d16_box": lambda: events.select("value", "event_type").toPandas()
        .groupby("event_type")["value"].describe(),
        "i14_roc": roc,
    }
    out = {}
    for name, action in actions.items():
        action()
        out[name] = round(timed(action, runs), 3)
    return out


if __name__ == "__main__":
    main()
