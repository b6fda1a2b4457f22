"""Hand fixtures for the column expressions."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lifetide.functions import scalars as X

AS_OF = "2024-06-01 00:00:00"


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_money_parse_null_empty_and_text(spark):
    got = one(spark, X.money("x"), [(None,), ("",), ("12.50",), (" 7 ",)], "x string")
    assert got == [Decimal("0.00"), Decimal("0.00"), Decimal("12.50"), Decimal("7.00")]


def test_money_lenient_marks_junk(spark):
    got = one(spark, X.money("x", strict=False), [("n/a",), ("3.1",)], "x string")
    assert got == [None, Decimal("3.10")]
    valid = one(spark, X.money_is_valid("x"), [("n/a",), ("",), (None,), ("1",)], "x string")
    assert valid == [False, True, True, True]


def test_iso_offsets_to_utc(spark):
    rows = [("2024-01-15T10:00:00-05:00",), ("2024-01-15T10:00:00Z",), (None,),
            ("2024-01-15T10:00:00.250+02:00",)]
    got = one(spark, X.iso_utc("x"), rows, "x string")
    assert got == [dt.datetime(2024, 1, 15, 15, 0), dt.datetime(2024, 1, 15, 10, 0), None,
                   dt.datetime(2024, 1, 15, 8, 0, 0, 250000)]


def test_iso_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, X.iso_utc("x"), [("2024-01-15T10:00:00-05:00",)], "x string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 1, 15, 15, 0)]


def test_id_text_truthiness(spark):
    got = one(spark, X.id_text("x"), [(None,), (0,), (17,)], "x long")
    assert got == [None, None, "17"]


def test_consent_and_tags(spark):
    assert one(spark, X.consent_flag("s"), [("subscribed",), ("not_subscribed",), (None,)],
               "s string") == [True, False, False]
    assert one(spark, X.tags_json("t"), [("vip, new",), (None,)], "t string") == ['"vip, new"', "[]"]


def test_minutes_boundary_vs_elapsed(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1))]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, X.minutes_between("a", "b", "boundary"), rows, schema) == [1]
    assert one(spark, X.minutes_between("a", "b", "elapsed"), rows, schema) == [0]


def test_whole_days_is_floor_of_24h(spark):
    rows = [(dt.datetime(2024, 5, 31, 23, 0),), (dt.datetime(2024, 6, 1, 1, 0),), (None,)]
    assert one(spark, X.whole_days("t", AS_OF), rows, "t timestamp_ntz") == [0, -1, None]
    assert one(spark, X.whole_days_or_zero("t", AS_OF), rows, "t timestamp_ntz") == [0, -1, 0]


def test_status_boundaries(spark):
    as_of = dt.datetime(2024, 6, 1)
    rows = [(as_of - dt.timedelta(days=89, hours=23),), (as_of - dt.timedelta(days=90, hours=23),),
            (as_of - dt.timedelta(days=91),), (None,)]
    got = one(spark, X.status("t", AS_OF, F.lit("new")), rows, "t timestamp_ntz")
    assert got == ["active", "active", "inactive", "new"]


def test_refund_rate_zero_spend(spark):
    got = one(spark, X.guarded_ratio("r", "s"), [(10.0, 0.0), (5.0, 20.0)], "r double, s double")
    assert got == [0.0, 0.25]


def test_confidence_value_set(spark):
    as_of = dt.datetime(2024, 6, 1)
    old, recent = as_of - dt.timedelta(days=181), as_of - dt.timedelta(days=180)
    rows = []
    for n in (2, 3):
        for last in (old, recent):
            rows.append((n, last, last))
        rows.append((n, None, None))
    got = one(spark, X.confidence("n", "f", "l", AS_OF), rows,
              "n int, f timestamp_ntz, l timestamp_ntz")
    # orders 2: .7*.8=.56, .7, .7*.6=.42 ; orders 3: .8, 1, .6 (a missing date is never "old")
    assert got == [0.56, 0.7, 0.42, 0.8, 1.0, 0.6]
    assert set(got) <= {1.0, 0.8, 0.7, 0.6, 0.56, 0.48, 0.42, 0.34}
