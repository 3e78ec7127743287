import datetime as dt

from tripwise.config import DEFAULT
from tripwise.operators.calendar import dim_date, with_date_key


def test_calendar_attributes(spark):
    cal = {r.date: r for r in dim_date(spark).collect()}
    assert len(cal) == 30 and max(cal) == dt.date(2021, 6, 30)
    sat, sun, mon = cal[dt.date(2021, 6, 5)], cal[dt.date(2021, 6, 6)], cal[dt.date(2021, 6, 7)]
    assert (sat.weekend_flag, sun.weekend_flag, mon.weekend_flag) == (1, 1, 0)
    assert (sun.day_of_week_num, sun.day_name, sat.day_of_week_num) == (0, "Sun", 6)
    assert sat.month_name == "June" and sat.year_quarter == "2021-Q2" and sat.date_key == 20210605


def test_outside_calendar_gets_null_key(spark):
    df = spark.createDataFrame([(dt.date(2021, 7, 1),), (dt.date(2021, 6, 30),)], "d date")
    keys = {r.d: r.k for r in with_date_key(df, "d", "k", dim_date(spark)).collect()}
    assert keys == {dt.date(2021, 7, 1): None, dt.date(2021, 6, 30): 20210630}


def test_window_day_keys():
    assert DEFAULT.window_day_keys()[0] == 20210601 and len(DEFAULT.window_day_keys()) == 14
    assert len(DEFAULT.with_(window_end="2021-12-31").window_day_keys()) == 214
    literal = DEFAULT.with_(literal_calendar_tenure=True)
    assert len(literal.with_(window_end="2021-12-31").window_day_keys()) == 30   # has its own days only


def test_calendar_covers_window_and_valid_dates(spark):
    cfg = DEFAULT.with_(window_start="2008-05-01", window_end="2031-02-01").with_calendar()
    days = [r.date for r in dim_date(spark, cfg).collect()]
    assert (min(days), max(days)) == (dt.date(2008, 5, 1), dt.date(2031, 2, 1))
    assert len(days) == (days[-1] - days[0]).days + 1 and len(cfg.window_day_keys()) == len(days)
