"""Batch ids, ages and staleness at their boundaries, against a plain calculation."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions.dates import age_at, check_batch_id, stale_at, strict_date


def test_batch_id():
    assert check_batch_id("20260926") == dt.date(2026, 9, 26)


@pytest.mark.parametrize("bad", ["2026926", "202609266", "2026-9-26", "abcdefgh", "99999999", "20260231", "", "２０２６０９２６"])
def test_bad_batch_id(bad):
    with pytest.raises(ValueError):
        check_batch_id(bad)


def completed_years(born, as_of):
    try:
        birthday = born.replace(year=as_of.year)
    except ValueError:
        birthday = dt.date(as_of.year, 2, 28)
    return as_of.year - born.year - (birthday > as_of)


DAYS = st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31))


@settings(max_examples=5, deadline=None)
@given(pairs=st.lists(st.tuples(DAYS, DAYS), min_size=50, max_size=200))
def test_age_is_completed_years(spark, pairs):
    leap = [(dt.date(2000, 2, 29), dt.date(2025, 2, 27 + d)) for d in (0, 1)] + [(dt.date(2000, 2, 29), dt.date(2025, 3, 1))]
    pairs = pairs + leap + [(a, a) for a, _ in pairs[:5]]
    df = spark.createDataFrame(pairs, "born date, as_of date").select("*", age_at(F.col("born"), F.col("as_of")).alias("age"))
    for row in df.collect():
        assert row.age == completed_years(row.born, row.as_of)


@pytest.mark.parametrize(
    "days, expected", [(89, False), (90, False), (91, True), (-5, False), (0, False), (None, None)]
)
def test_stale(spark, days, expected):
    as_of = dt.date(2026, 9, 26)
    last = None if days is None else as_of - dt.timedelta(days=days)
    df = spark.createDataFrame([(last, as_of)], "last date, as_of date")
    assert df.select(stale_at(F.col("last"), F.col("as_of"))).first()[0] is expected


@pytest.mark.parametrize("text", ["2026926", " 20260926", "20260926 ", "+20260926", "-20260926", "-0260926", "20260230", "2026-9-6", "２０２６０９２６", "", "202609261"])
def test_strict_date_rejects(spark, text):
    assert spark.createDataFrame([(text,)], "x string").select(strict_date(F.col("x"), "yyyyMMdd")).first()[0] is None


def test_strict_date_accepts_leap_day(spark):
    df = spark.createDataFrame([("20240229", "29022024")], "a string, b string")
    assert df.select(strict_date(F.col("a"), "yyyyMMdd"), strict_date(F.col("b"), "ddMMyyyy")).first() == (
        dt.date(2024, 2, 29),
        dt.date(2024, 2, 29),
    )
