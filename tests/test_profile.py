import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile as p
from tidemark.sources.schemas import CONTACT_SCHEMA, NUMERIC


@pytest.fixture(scope="module")
def frame(contact_rows):
    return pd.DataFrame(contact_rows, columns=CONTACT_SCHEMA.names)


def test_summary_statistics(contacts, frame):
    got = {r["column"]: r for r in p.summary_statistics(contacts, NUMERIC).collect()}
    for c in NUMERIC:
        want = frame[c].describe()
        assert got[c]["count"] == want["count"]
        for ours, theirs in (("mean", "mean"), ("stddev", "std"), ("min", "min"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[theirs])


def test_summary_of_nothing(contacts):
    row = p.summary_statistics(contacts.limit(0), ["age"]).first()
    assert tuple(row) == ("age", 0, None, None, None, None)


def test_correlation_matches_and_is_symmetric(contacts, frame):
    got = {(r["col_x"], r["col_y"]): r["corr"] for r in p.correlation_matrix(contacts, NUMERIC).collect()}
    want = frame[NUMERIC].corr()
    assert len(got) == len(NUMERIC) ** 2
    for (a, b), value in got.items():
        assert value == pytest.approx(want.loc[a, b])
        assert value == got[(b, a)]
        if a == b:
            assert value == pytest.approx(1)


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (None, 4.0, 6.0), (4.0, 8.0, 1.0), (5.0, 2.5, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for r in p.correlation_matrix(df, ["a", "b", "c"]).collect():
        assert r["corr"] == pytest.approx(want.loc[r["col_x"], r["col_y"]])


def test_correlation_of_constants_nan_and_nothing(spark):
    rows = [(1.0, 5.0, float("nan")), (2.0, 5.0, 1.0), (4.0, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in p.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] is None
    assert got[("a", "a")] == pytest.approx(1) and got[("a", "c")] == pytest.approx(1)
    empty = p.correlation_matrix(df.limit(0), ["a", "b"]).collect()
    assert len(empty) == 4 and all(r["corr"] is None for r in empty)


def test_correlation_can_leave_out_a_sentinel(contacts, frame):
    got = p.correlation_matrix(contacts, ["age", "pdays"], {"pdays": -1})
    value = got.where("col_x = 'age' AND col_y = 'pdays'").first()["corr"]
    kept = frame[frame["pdays"] != -1]
    assert value == pytest.approx(kept["age"].corr(kept["pdays"]))


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_matches_numpy(contacts, frame, bins):
    got = p.histogram(contacts, "age", bins).orderBy("bin").collect()
    counts, edges = np.histogram(frame["age"], bins=bins)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["bin_low"] for r in got] == pytest.approx(edges[:-1].tolist())
    assert got[-1]["bin_high"] == pytest.approx(edges[-1])


def test_histogram_of_a_constant_and_of_gaps(spark):
    flat = spark.createDataFrame([(4.0,)] * 3 + [(None,)], "v double")
    got = p.histogram(flat, "v", 4).orderBy("bin").collect()
    counts, edges = np.histogram([4.0] * 3, bins=4)
    assert [r["count"] for r in got] == counts.tolist()
    assert got[0]["bin_low"] == edges[0] and got[-1]["bin_high"] == edges[-1]
    gap = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    assert [r["count"] for r in p.histogram(gap, "v", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 1]


def brute_density(values, points):
    values = np.asarray(values, dtype=float)
    grid = np.linspace(values.min(), values.max(), points)
    h = len(values) ** -0.2 * values.std(ddof=1)
    kernel = np.exp(-0.5 * ((grid[:, None] - values[None, :]) / h) ** 2)
    return grid, kernel.sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("combine_equal", [True, False])
def test_density_matches_brute_force(contacts, frame, combine_equal):
    got = p.density(contacts, "balance", points=50, combine_equal=combine_equal)
    rows = got.orderBy("point").collect()
    grid, want = brute_density(frame["balance"], 50)
    assert [r["x"] for r in rows] == pytest.approx(grid.tolist())
    assert [r["density"] for r in rows] == pytest.approx(want.tolist(), rel=1e-9, abs=1e-18)


def test_density_far_from_any_value_is_zero(spark):
    values = [0.0] * 500 + [0.1] * 500 + [1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = p.density(df, "v", points=200).orderBy("point").collect()
    _, want = brute_density(values, 200)
    assert len(rows) == 200
    assert [r["density"] for r in rows] == pytest.approx(want.tolist(), rel=1e-9, abs=1e-20)


def test_density_by_class_and_of_a_constant(spark, contacts, frame):
    rows = p.density(contacts, "duration", ["y"], points=20).orderBy("y", "point").collect()
    for value, group in frame.groupby("y"):
        _, want = brute_density(group["duration"], 20)
        got = [r["density"] for r in rows if r["y"] == value]
        assert got == pytest.approx(want.tolist(), rel=1e-9)
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert all(r["density"] is None for r in p.density(flat, "v", points=5).collect())


def brute_box(values):
    values = np.sort(np.asarray(values, dtype=float))
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = values[(values >= low) & (values <= high)]
    return (len(values), q1, median, q3, inside.min(), inside.max(), len(values) - len(inside))


def test_box_statistics(contacts, frame):
    got = {r["y"]: tuple(r)[1:] for r in p.box_statistics(contacts, "duration", ["y"]).collect()}
    for value, group in frame.groupby("y"):
        assert got[value] == pytest.approx(brute_box(group["duration"]))
    assert tuple(p.box_statistics(contacts, "balance").first()) == pytest.approx(
        brute_box(frame["balance"])
    )


def test_box_with_outliers(spark):
    values = [float(i) for i in range(20)] + [500.0, -300.0]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    assert tuple(p.box_statistics(df, "v", ["k"]).first())[1:] == pytest.approx(brute_box(values))


def test_binned_pairs(contacts, frame):
    cells = p.binned_pairs(contacts, "age", "balance", "y", 5, 4).collect()
    assert sum(r["count"] for r in cells) == len(frame)
    for value, group in frame.groupby("y"):
        want, _, _ = np.histogram2d(
            group["age"], group["balance"], bins=[5, 4],
            range=[[frame["age"].min(), frame["age"].max()],
                   [frame["balance"].min(), frame["balance"].max()]],
        )
        got = np.zeros((5, 4))
        for r in cells:
            if r["y"] == value:
                got[r["x_bin"], r["y_bin"]] = r["count"]
        assert (got == want).all()


def test_grouped_profile_of_empty_frame(contacts):
    empty = contacts.where(F.lit(False))
    assert p.box_statistics(empty, "duration", ["y"]).count() == 0
    assert p.density(empty, "duration", ["y"]).count() == 0
