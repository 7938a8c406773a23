from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tidemark.streaming import windows as w

START = datetime(2024, 3, 1)
SCHEMA = "id long, at timestamp, who string, x double"


def at(minutes):
    return START + timedelta(minutes=minutes)


def table(spark, rows):
    return spark.createDataFrame([(i, None if m is None else at(m), who, x) for i, m, who, x in rows], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def state_rows(spark, folder, **options):
    return spark.read.format("statestore").options(**options).load(f"{folder}/checkpoint").count()


def test_sliding_windows_late_rows_and_bounded_state(spark, tmp_path):
    # The second batch is read under a watermark of 120 - 30 = 90 minutes, the third under 600 - 30.
    batches = [
        [(1, 0, "a", 1.0), (2, 10, "a", 2.0), (3, 120, "a", 4.0), (4, 120, "a", 4.0), (5, None, "a", 9.0)],
        [(6, 85, "a", 8.0), (7, 55, "a", 16.0), (8, 600, None, None)],
        [(9, 1200, "b", 1.0)],
    ]
    frames = [table(spark, b) for b in batches]
    got = w.arrive(frames, lambda s: w.sliding_totals(s, "at", ["who"], "x", "60 minutes", "30 minutes", "30 minutes"), str(tmp_path))
    want = defaultdict(list)
    for mark, batch in ((None, batches[0]), (90, batches[1]), (570, batches[2])):
        for _, m, who, x in batch:
            for start in [] if m is None else (m // 30 * 30, m // 30 * 30 - 30):
                if mark is None or start + 60 > mark:
                    want[(start, who)].append(x)
    want = [
        (at(s), at(s + 60), who, len(v), sum(x for x in v if x is not None) if any(x is not None for x in v) else None)
        for (s, who), v in want.items() if s + 60 <= 1170
    ]
    assert rows(got) == sorted(want, key=str)
    assert (at(60), at(120), "a", 1, 8.0) in want  # row 6 came in time for this window, row 7 for none
    assert not any(r["x"] == 16.0 for r in got.withColumnRenamed("sum_x", "x").collect())
    assert state_rows(spark, str(tmp_path)) == 2  # the windows of the last row


def test_sliding_windows_of_a_table_are_those_of_a_stream_without_late_rows(spark, tmp_path):
    data = table(spark, [(i, 7 * i, "ab"[i % 2], float(i)) for i in range(100)] + [(200, 5000, "a", 0.0)])
    build = lambda s: w.sliding_totals(s, "at", ["who"], "x", "40 minutes", "20 minutes", "10 minutes")
    streamed = w.arrive([data], build, str(tmp_path))
    assert rows(streamed) == rows(build(data).where(f"window_end <= timestamp'{at(4990)}'"))


def brute_sessions(events, gap, mark):
    out = []
    for who in {e[2] for e in events}:
        own = sorted((e[1], e[3]) for e in events if e[2] == who)
        run = [own[0]]
        for e in own[1:]:
            if e[0] - run[-1][0] <= gap:
                run.append(e)
            else:
                out.append((who, run))
                run = [e]
        out.append((who, run))
    return sorted(((at(r[0][0]), at(r[-1][0] + gap), who, len(r), sum(x for _, x in r)) for who, r in out if r[-1][0] + gap <= mark), key=str)


def test_sessions_merge_over_batches(spark, tmp_path):
    events = [(i, m, who, 1.0) for i, (m, who) in enumerate(
        [(0, "a"), (5, "a"), (5, "a"), (20, "a"), (30, "b"), (29, "a"), (39, "a"), (49, "a"), (100, None), (104, None), (300, "c")])]
    frames = [table(spark, events[:5]), table(spark, events[5:9]), table(spark, events[9:])]
    got = w.arrive(frames, lambda s: w.session_totals(s, "at", ["who"], "x", "10 minutes", "50 minutes"), str(tmp_path))
    assert rows(got) == brute_sessions(events, 10, 250)
    # A row that lies exactly one gap after another is of its session: 20, 29, 39 and 49 are one.
    assert (at(20), at(59), "a", 4, 4.0) in rows(got)
    assert state_rows(spark, str(tmp_path)) == 1


def test_a_late_row_closes_the_gap_between_two_sessions(spark, tmp_path):
    frames = [table(spark, [(1, 0, "a", 1.0), (2, 14, "a", 1.0)]), table(spark, [(3, 8, "a", 1.0)]), table(spark, [(4, 500, "z", 1.0)])]
    got = w.arrive(frames, lambda s: w.session_totals(s, "at", ["who"], "x", "10 minutes", "60 minutes"), str(tmp_path))
    assert rows(got) == [(at(0), at(24), "a", 3, 3.0)]


def test_repeats_are_dropped_over_batches_and_forgotten(spark, tmp_path):
    first = [(i, i, "a", 1.0) for i in range(20)]
    frames = [table(spark, first + first[:5]), table(spark, first[10:] + [(30, 30, None, 1.0), (None, 31, "n", 1.0), (None, 31, "n", 1.0)])]
    frames.append(table(spark, [(99, 500, "a", 1.0)]))
    got = w.arrive(frames, lambda s: w.drop_repeats(s, "at", ["id"], "60 minutes"), str(tmp_path))
    assert sorted((r["id"] is None, r["id"] or 0) for r in got.collect()) == [*((False, i) for i in [*range(20), 30, 99]), (True, 0)]
    assert state_rows(spark, str(tmp_path)) == 1
    assert w.drop_repeats(table(spark, first + first), "at", ["id"], "60 minutes").count() == 20


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_interval_join(spark, tmp_path, how):
    data = [(1, 0, "a", 1.0), (2, 5, "a", -1.0), (3, 10, "a", -2.0), (4, 11, "a", -3.0), (5, 40, "b", 1.0), (6, 45, None, 1.0), (7, 46, None, -1.0)]
    data += [(8, 60, "a", 1.0), (9, 60, "a", -4.0), (10, 500, "a", 1.0), (11, 500, "c", -1.0)]

    def build(df):
        left = df.where("x > 0").selectExpr("id as l", "at as l_at", "who")
        right = df.where("x < 0").selectExpr("id as r", "at as r_at", "who")
        return w.interval_join(left, right, ["who"], "l_at", "r_at", "10 minutes", "30 minutes", how).select("l", "r")

    frames = [table(spark, data[:2]), table(spark, data[2:9]), table(spark, data[9:])]
    pairs = {(a[0], b[0]) for a in data for b in data if a[3] > 0 > b[3] and a[2] == b[2] is not None and 0 <= b[1] - a[1] <= 10}
    assert pairs == {(1, 2), (1, 3), (8, 9)}
    lone = {(i, None) for i in (5, 6)}
    assert set(rows(w.arrive(frames, build, str(tmp_path)))) == pairs | (lone if how == "left_outer" else set())
    batch = set(rows(build(table(spark, data))))
    assert batch == pairs | (lone | {(10, None)} if how == "left_outer" else set())


def test_late_rows_are_counted(spark):
    data = [(1, 0, "a", 1.0), (2, 100, "a", 1.0), (3, 60, "b", 1.0), (4, 69, "b", 1.0), (5, 70, "b", 1.0), (6, None, "b", 1.0), (7, 10, "c", 1.0)]
    got = w.late_rows(table(spark, data), "who", "at", "30 minutes").collect()
    assert {r["who"]: (r["n_rows"], r["n_late"], r["watermark"]) for r in got} == {"a": (2, 0, None), "b": (3, 2, at(70)), "c": (1, 1, at(70))}


def test_empty_batches(spark, tmp_path):
    empty = table(spark, [])
    build = lambda s: w.sliding_totals(s, "at", ["who"], "x", "60 minutes", "30 minutes", "30 minutes")
    assert w.arrive([empty, empty], build, str(tmp_path / "a")).count() == 0
    assert w.late_rows(empty, "who", "at", "1 day").count() == 0 and build(empty).count() == 0
    with pytest.raises(ValueError):
        w.arrive([], build, str(tmp_path / "b"))
