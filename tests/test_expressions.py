import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import expressions as x


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "title"),
    [
        ("blue-collar", "Blue-Collar"), ("self-employed", "Self-Employed"),
        ("admin.", "Admin."), ("1-URGENT", "1-Urgent"), ("they're here", "They'Re Here"),
        ("", ""), (None, None), ("éclair", "Éclair"),
    ],
)
def test_title_case(spark, text, title):
    assert one(spark, x.title_case(F.lit(text).cast("string"))) == title


def test_ratio_guards_zero(spark):
    assert one(spark, x.ratio(F.lit(3), F.lit(0))) == 0.0
    assert one(spark, x.ratio(F.lit(3), F.lit(0), None)) is None
    assert one(spark, x.ratio(F.lit(3), F.lit(4))) == 0.75


def test_months(spark):
    assert one(spark, x.month_number(F.lit("jan"))) == 1
    assert one(spark, x.month_number(F.lit("dec"))) == 12
    assert one(spark, x.month_number(F.lit("smarch"))) is None
    assert one(spark, x.month_name(F.lit("2020-09-30").cast("date"))) == "sep"


def test_flag_counts_null_as_zero(spark):
    assert one(spark, x.flag(F.lit(None).cast("string") == "yes")) == 0


@pytest.mark.parametrize(
    ("value", "expected"), [(0.0, 0), (0.999, 0), (1.0, 1), (9.0, 9), (10.0, 9)]
)
def test_bin_index(spark, value, expected):
    assert one(spark, x.bin_index(F.lit(value), F.lit(0.0), F.lit(10.0), 10)) == expected


def test_bin_index_of_a_point(spark):
    assert one(spark, x.bin_index(F.lit(4.0), F.lit(4.0), F.lit(4.0), 10)) == 0
