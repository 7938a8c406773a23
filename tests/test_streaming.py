import pytest
from pyspark.sql import functions as F

from tidemark.sources.files import write_csv
from tidemark.sources.stream import read_csv_stream, read_parquet_stream
from tidemark.streaming import live as lv
from tidemark.streaming.replay import disjoint_batches, overlapping_batches, replay


@pytest.fixture(scope="module")
def keyed(contacts):
    return contacts.coalesce(1).select(
        F.monotonically_increasing_id().alias("id"), "job", "balance"
    ).cache()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_disjoint_replay_ends_at_the_batch_result(keyed, tmp_path):
    table = replay(disjoint_batches(keyed, "id", 3), "job", "balance", str(tmp_path))
    assert rows(table.current()) == rows(lv.segment_totals(keyed, "job", "balance"))
    history = table.history("avg_balance").orderBy("batch").collect()
    assert [r["batch"] for r in history] == [1, 2, 3]
    totals = [r["total_txns"] for r in history]
    assert totals == sorted(totals) and totals[-1] == 240
    assert all(r["avg_of_group_avgs"] is not None for r in history)


def test_overlapping_replay_counts_every_arrival(keyed, tmp_path):
    batches = overlapping_batches(keyed, "id", batches=3, rows=100)
    table = replay(batches, "job", "balance", str(tmp_path))
    totals = [r["total_txns"] for r in table.history("avg_balance").orderBy("batch").collect()]
    assert totals == [100, 200, 300]


def test_a_file_counts_once_across_drains(spark, keyed, tmp_path):
    incoming = str(tmp_path / "in")
    write_csv(keyed, incoming)
    stream = read_csv_stream(spark, incoming, keyed.schema)
    table = lv.LiveTable(lv.segment_totals(stream, "job", "balance"), str(tmp_path / "live"))
    table.drain()
    table.drain()
    assert rows(table.current()) == rows(lv.segment_totals(keyed, "job", "balance"))
    write_csv(keyed, incoming, mode="append")
    table.drain()
    assert sum(r["txn_count"] for r in table.current().collect()) == 480
    assert table.history("avg_balance").count() == 2


def test_one_file_per_batch(spark, keyed, tmp_path):
    incoming = str(tmp_path / "in")
    keyed.repartition(4).write.parquet(incoming)
    stream = read_parquet_stream(spark, incoming, keyed.schema, files_per_batch=1)
    table = lv.LiveTable(lv.segment_totals(stream, "job", "balance"), str(tmp_path / "live"))
    table.drain()
    totals = [r["total_txns"] for r in table.history("avg_balance").orderBy("batch").collect()]
    assert totals == [60, 120, 180, 240]


def test_repeated_batch_replaces_its_own_output(spark, keyed, tmp_path):
    stream = spark.readStream.schema(keyed.schema).parquet(str(tmp_path))
    table = lv.LiveTable(lv.segment_totals(stream, "job", "balance"), str(tmp_path / "live"))
    write = table._writer()
    snapshot = lv.segment_totals(keyed, "job", "balance")
    write(snapshot, 0)
    write(snapshot, 0)
    assert rows(table.current()) == rows(snapshot)


def test_memory_table_status_and_stop(spark, keyed, tmp_path):
    incoming = str(tmp_path / "in")
    write_csv(keyed, incoming)
    stream = read_csv_stream(spark, incoming, keyed.schema)
    query = lv.start_memory_table(lv.segment_totals(stream, "job", "balance"), "live_jobs")
    try:
        query.processAllAvailable()
        status = lv.query_status(query)
        assert status["name"] == "live_jobs" and status["active"] and status["error"] is None
        want = rows(lv.segment_totals(keyed, "job", "balance"))
        assert rows(spark.sql("SELECT * FROM live_jobs")) == want
    finally:
        query.stop()
    assert not lv.query_status(query)["active"]
    assert rows(lv.drain_to_memory(lv.segment_totals(stream, "job", "balance"))) == want


def test_drained_rows_are_all_there(spark, keyed, tmp_path):
    keyed.write.parquet(str(tmp_path / "in"))
    stream = read_parquet_stream(spark, str(tmp_path / "in"), keyed.schema)
    assert rows(lv.drain_rows(stream, str(tmp_path / "out"))) == rows(keyed)


def test_failure_is_raised(spark, keyed, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("balance,job,id\n1,2,3\n")
    stream = read_csv_stream(spark, str(tmp_path / "in"), keyed.schema)
    with pytest.raises(Exception, match="(?i)stream|header"):
        lv.drain_rows(stream, str(tmp_path / "out"))


def test_nothing_to_replay(tmp_path):
    with pytest.raises(ValueError):
        replay([], "job", "balance", str(tmp_path))


def test_state_partitions_follow_the_cores(spark, keyed, tmp_path):
    keyed.write.parquet(str(tmp_path / "in"))
    stream = read_parquet_stream(spark, str(tmp_path / "in"), keyed.schema)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        table = lv.LiveTable(lv.segment_totals(stream, "job", "balance"), str(tmp_path / "live"))
        table.drain()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    state = tmp_path / "live" / "checkpoint" / "state" / "0"
    assert len([p for p in state.iterdir() if p.name.isdigit()]) == 4
