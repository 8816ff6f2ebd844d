"""Dates against Python's ISO parser."""

import itertools
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from pressflow.functions import dates


def python_instant(value):
    try:
        parsed = datetime.fromisoformat(value.replace("Z", "+00:00"))
    except ValueError:
        return None
    if parsed.tzinfo is None:
        parsed = parsed.replace(tzinfo=timezone.utc)
    return parsed.astimezone(timezone.utc).replace(tzinfo=None)


ACCEPTED = [
    "2026-01-01", "20260101", "2026-01-01T10:00Z", "2026-01-01T10:00:00Z",
    "2026-01-01T10:00:00+00:00", "2026-01-01T10:00:00.123456+00:00", "2026-01-01T10:00:00.1",
    "2026-01-01x10:00", "2026-01-01T10", "2026-01-01T23:30:00-05:00", "2026-01-01T10:00:00+01:30",
    "20260101T101112", "20260101T101112.5+0130", "2026-01-01 10:00:00", "2026-01-01T10:00:00,25",
    "2024-02-29", "2026-01-01T10:00:00.1234567+00:00",
]
REJECTED = [
    "hello", "2026", "2026-01", "2026-02-30", "2026-1-1", " 2026-01-01", "2026-01-01 ", "T10:00",
    "2026-13-01", "2026-01-01T25:00", "2026-01-01T10:61", "0000-01-01", "", "2026-01-01T",
    "2026-01-01T10:00:00+", "01/02/2026", "2025-02-29T10:00:00+00:00",
]


def test_accepted_forms_give_pythons_instant(one):
    assert one(ACCEPTED, dates.iso_timestamp) == [python_instant(v) for v in ACCEPTED]


def test_rejected_forms(one):
    assert one(REJECTED + [None], dates.iso_timestamp) == [None] * (len(REJECTED) + 1)
    assert all(python_instant(v) is None for v in REJECTED)


def test_random_forms_agree_with_python(one):
    rng = random.Random(7)
    days = ["2026-01-01", "20240229", "2023-02-29", "1999-12-31", "2026-00-10", "2026-1-01"]
    marks = ["T", " ", "x", "é", "TT"]
    clocks = ["", "10", "10:20", "10:20:30", "1020", "102030", "10:20:30.5", "10:20:30,123456789",
              "24:00", "10:2", "102030.25", "10:20.5"]
    zones = ["", "Z", "+00:00", "-0500", "+01", "+01:3", "+0130", "-17:59"]
    values = ["".join(p) for p in itertools.product(days, marks, clocks, zones)]
    values = rng.sample(values, 800)
    got = one(values, dates.iso_timestamp)
    for value, instant in zip(values, got):
        expected = python_instant(value)
        assert instant == expected, value


def test_date_as_written_ignores_the_offset(one):
    values = ["2026-01-01T23:30:00-05:00", "20260101", "bad", None]
    assert one(values, dates.iso_date_as_written) == [date(2026, 1, 1), date(2026, 1, 1), None, None]
    assert one(values[:1], lambda c: dates.utc_day(dates.iso_timestamp(c))) == [date(2026, 1, 2)]


@pytest.mark.parametrize("published, scraped, expected", [
    ("2026-01-01T23:30:00-05:00", "2026-05-05", date(2026, 1, 1)),
    (None, "2026-05-05T00:00:00Z", date(2026, 5, 5)),
    ("", "2026-05-05T00:00:00Z", date(2026, 5, 5)),
    ("hello", "2026-05-05T00:00:00Z", date(2030, 1, 1)),
    (None, None, date(2030, 1, 1)),
])
def test_partition_date(spark, published, scraped, expected):
    df = spark.createDataFrame([(published, scraped)], "p STRING, s STRING")
    got = df.select(dates.partition_date(F.col("p"), F.col("s"), F.lit(date(2030, 1, 1)))).first()[0]
    assert got == expected


@pytest.mark.parametrize("value, expected", [
    ("Tue, 02 Jan 2024 16:43:38 +0000", "2024-01-02T16:43:38+00:00"),
    ("Tue, 2 Jan 2024 16:43:38 GMT", "2024-01-02T16:43:38+00:00"),
    ("02 Jan 2024 16:43:38 -0530", "2024-01-02T22:13:38+00:00"),
    ("Tue, 02 Jan 2024 16:43:38 +01:00", "2024-01-02T15:43:38+00:00"),
    ("Tue, 02 Jan 2024 16:43", "2024-01-02T16:43:00+00:00"),
    ("2024-01-02T16:43:38+02:00", "2024-01-02T14:43:38+00:00"),
    ("2024-01-02T16:43:38.5Z", "2024-01-02T16:43:38.500000+00:00"),
    ("Jan 2, 2024", "2024-01-02T00:00:00+00:00"),
    ("Tuesday, January 2, 2024", "2024-01-02T00:00:00+00:00"),
    ("January 2, 2024 4:43 PM", "2024-01-02T16:43:00+00:00"),
    ("2 January 2024 16:43", "2024-01-02T16:43:00+00:00"),
    ("Tue, 02 Jan 2024 16:43:38 EST", "2024-01-02T16:43:38+00:00"),
    ("2024/01/02", "2024-01-02T00:00:00+00:00"),
    ("1/2/2024", "2024-01-02T00:00:00+00:00"),
    ("2024-01-02 16:43:38 +0100", "2024-01-02T15:43:38+00:00"),
    ("3 Feb 2026 4:05 PM", "2026-02-03T16:05:00+00:00"),
    ("03-Feb-2026 10:00", "2026-02-03T10:00:00+00:00"),
    ("Feb 3 2026", "2026-02-03T00:00:00+00:00"),
    ("Tue Feb  3 10:00:00 2026", "2026-02-03T10:00:00+00:00"),
    ("Tue Feb 3 10:00:00 UTC 2026", "2026-02-03T10:00:00+00:00"),
    ("Tuesday 3 February 2026", "2026-02-03T00:00:00+00:00"),
    ("Tuesday, 3rd of February, 2026 at 12:05 a.m.", "2026-02-03T00:05:00+00:00"),
    ("3. Sept. 26 10:00 GMT+2", "2026-09-03T08:00:00+00:00"),
    ("2026-2-3 9:05:07.25 +05:30", "2026-02-03T03:35:07.250000+00:00"),
    ("20260203", "2026-02-03T00:00:00+00:00"), ("20260203 10:00", "2026-02-03T10:00:00+00:00"),
    ("13/2/2026", "2026-02-13T00:00:00+00:00"), ("2.3.26", "2026-02-03T00:00:00+00:00"),
    ("Sun, 1 Jan 95 10:00:00 GMT", "1995-01-01T10:00:00+00:00"), ("2026 Feb 3", "2026-02-03T00:00:00+00:00"),
    ("3 Feb 2026 10:00 (CET)", "2026-02-03T10:00:00+00:00"), ("Feb 3, 2026, 4 pm", "2026-02-03T16:00:00+00:00"),
    ("30 Feb 2026", None), ("Feb 2026", None), ("10:00", None), ("3 Feb 2026 25:00", None), ("13/13/2026", None),
    ("3 Feb Mar 2026", None), ("3 Feb 2026 13:00 PM", None), ("soon 3 Feb 2026", None), ("1 2 3 4", None),
    ("2026-02", None), ("31 Dec 0000", None), ("x" * 1000, None),
    ("no date", None), ("", None), (None, None),
])
def test_feed_dates(one, value, expected):
    assert one([value], dates.feed_date_iso) == [expected]


def test_literal_is_utc(spark):
    row = spark.range(1).select(
        dates.utc_literal(datetime(2026, 1, 1, 5)).alias("a"),
        dates.utc_literal(datetime.fromisoformat("2026-01-01T05:00:00+02:00")).alias("b"),
    ).selectExpr("cast(a AS STRING)", "cast(b AS STRING)").first()
    assert tuple(row) == ("2026-01-01 05:00:00", "2026-01-01 03:00:00")
