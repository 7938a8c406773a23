from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import catalog
from tidemark.sources.files import input_path, inline_table, read_csv, write_csv
from tidemark.sources.schemas import CATEGORICAL, CONTACT_SCHEMA, NUMERIC, TARGET


def test_schema_roles_cover_all_columns():
    assert sorted([*CATEGORICAL, *NUMERIC, TARGET]) == sorted(CONTACT_SCHEMA.names)
    assert all(f.nullable for f in CONTACT_SCHEMA.fields)


def test_csv_round_trip(spark, contacts, tmp_path):
    path = str(tmp_path / "out")
    write_csv(contacts, path)
    back = read_csv(spark, path, CONTACT_SCHEMA)
    assert back.schema == CONTACT_SCHEMA
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, contacts.collect()))


def test_csv_with_reordered_header_fails(spark, tmp_path):
    header = list(CONTACT_SCHEMA.names)
    header[0], header[5] = header[5], header[0]
    (tmp_path / "a.csv").write_text(",".join(header) + "\n" + ",".join(["1"] * 17) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), CONTACT_SCHEMA).collect()


def test_csv_malformed_integer(spark, tmp_path):
    values = ["1"] * 17
    values[0] = "old"
    (tmp_path / "a.csv").write_text(",".join(CONTACT_SCHEMA.names) + "\n" + ",".join(values) + "\n")
    assert read_csv(spark, str(tmp_path), CONTACT_SCHEMA).first()["age"] is None
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_csv(spark, str(tmp_path), CONTACT_SCHEMA, mode="FAILFAST").collect()


def test_missing_path_is_reported(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"), CONTACT_SCHEMA)


def test_input_path():
    assert input_path("DATA", "here.csv", {}) == "here.csv"
    assert input_path("DATA", "here.csv", {"DATA": "there.csv"}) == "there.csv"
    with pytest.raises(FileNotFoundError):
        input_path("DATA", "", {})


def test_views_and_tables(spark, contacts):
    catalog.register_view(contacts, "contact_view")
    assert spark.sql("SELECT count(*) FROM contact_view").first()[0] == 240
    names = {r["tableName"] for r in catalog.list_tables(spark).collect()}
    assert "contact_view" in names
    assert catalog.drop_view(spark, "contact_view")
    assert not catalog.drop_view(spark, "contact_view")

    first = catalog.save_table(contacts, "contact_table")
    assert first.count() == 240
    again = catalog.save_table(contacts.limit(10), "contact_table")
    assert again.count() == 10


def test_external_table(spark, contacts, tmp_path):
    table = catalog.save_table(contacts.select("age"), "contact_external", str(tmp_path / "t"))
    assert table.count() == 240
    assert (tmp_path / "t").exists()


def test_inspection(contacts):
    described = catalog.describe_columns(contacts).orderBy("position").collect()
    assert [r["column"] for r in described] == CONTACT_SCHEMA.names
    assert described[0]["type"] == "int"
    assert tuple(catalog.table_shape(contacts).first()) == (240, 17)
    assert len(catalog.preview(contacts, 3).collect()) == 3


def test_inline_table(spark):
    table = inline_table(spark, [("a", 1.5)], "name string, score double")
    assert table.select(F.max("score")).first()[0] == 1.5


def _session(conf, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_path_uses_the_shared_folder():
    on_cluster = _session({"spark.checkpoint.dir": "hdfs:///shared/"}, "yarn")
    assert scratch_path(on_cluster, "x").startswith("hdfs:///shared/tidemark-x-")
    with pytest.raises(RuntimeError):
        scratch_path(_session({}, "yarn"), "x")
    assert "tidemark-x-" in scratch_path(_session({}, "local[2]"), "x")
