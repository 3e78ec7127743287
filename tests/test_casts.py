"""Total casts and wall-clock dates (edge values)."""

import datetime as dt
from decimal import Decimal

from tripwise.functions.casts import to_decimal, to_instant, to_local_date


def test_decimal_edges(spark):
    vals = ["4.565", "1e2", " 4.5 ", "NaN", "", "null", "abc", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(to_decimal("s", 38, 2)).collect()]
    assert got == [Decimal("4.57"), Decimal("100.00"), Decimal("4.50"), None, None, None, None, None]
    cnt = spark.createDataFrame([("4.6",), ("-3",)], "s string").select(to_decimal("s", 38, 0)).collect()
    assert [r[0] for r in cnt] == [Decimal("5"), Decimal("-3")]


def test_wall_date_ignores_offset(spark):
    df = spark.createDataFrame([("2021-06-01 23:30:00-05:00",), ("2021-06-14T22:30:00Z",),
                                ("2021-06-01 08:30:00",), ("bad",)], "s string")
    rows = df.select(to_local_date("s").alias("d"), to_instant("s").alias("t")).collect()
    assert [r.d for r in rows] == [dt.date(2021, 6, 1), dt.date(2021, 6, 14), dt.date(2021, 6, 1), None]
    assert rows[0].t == dt.datetime(2021, 6, 2, 4, 30)     # instant in UTC is on the next day


def test_digit_only_timestamps_are_format_errors(spark):
    df = spark.createDataFrame([("2021",), ("1622505600",), (" 2021 ",), ("2021-06-01",)], "s string")
    rows = df.select(to_instant("s").alias("t"), to_local_date("s").alias("d")).collect()
    assert [r.t for r in rows[:3]] == [None, None, None] and [r.d for r in rows[:3]] == [None, None, None]
    assert rows[3].d == dt.date(2021, 6, 1)
