import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandgrid.functions import calendar as cal
from demandgrid.operators import features as X
from tests.conftest import D


def _dates(spark, ds):
    return spark.createDataFrame([(D(d), 1) for d in ds], "shipment_date date, n_shipments long")


def _col(df, c):
    return [r[c] for r in df.orderBy("shipment_date").collect()]


@pytest.mark.parametrize("year,expected", [(2017, "2017-04-16"), (2018, "2018-04-01"),
                                           (2024, "2024-03-31"), (2025, "2025-04-20")])
def test_easter(spark, year, expected):
    assert spark.range(1).select(cal.easter(F.lit(year)).alias("e")).first().e == D(expected)


@pytest.mark.parametrize("year,expected", [(2017, "2017-11-24"), (2018, "2018-11-23"),
                                           (2019, "2019-11-29"), (2024, "2024-11-29")])
def test_black_friday(spark, year, expected):
    assert spark.range(1).select(cal.black_friday(F.lit(year)).alias("b")).first().b == D(expected)


def test_movable_holidays(spark):
    hol = {r.holiday_date for r in cal.holiday_dates(_dates(spark, ["2017-01-05", "2018-12-01"]),
                                                    "shipment_date").collect()}
    for d in ["2017-02-27", "2017-02-28", "2018-02-12", "2018-02-13", "2017-06-15", "2018-05-31",
              "2017-04-14", "2017-01-01", "2018-04-21", "2018-12-25"]:
        assert D(d) in hol
    assert D("2017-11-20") not in hol            # added from 2024 only
    assert len(hol) == 24                        # 12 per year, no overlaps in 2017/2018


def test_day_types(spark):
    ds = ["2017-11-24", "2017-11-25", "2017-11-26", "2017-12-25", "2018-02-12", "2018-04-02"]
    out = X.add_holiday_features(_dates(spark, ds))
    assert _col(out, "day_type") == ["business_day", "saturday", "sunday", "holiday", "holiday", "business_day"]
    assert _col(out, "is_operational") == [1, 1, 0, 0, 0, 1]


def test_saturday_and_sunday_holidays(spark):
    out = X.add_holiday_features(_dates(spark, ["2017-01-01", "2018-04-21"]))
    assert _col(out, "day_type") == ["holiday", "holiday"]
    assert _col(out, "is_operational") == [0, 1]       # Saturday holiday stays operational
    eda = X.add_holiday_features(_dates(spark, ["2017-01-01", "2018-04-21"]), sunday_first=True)
    assert _col(eda, "day_type") == ["sunday", "holiday"]
    assert _col(eda, "is_operational") == [0, 0]


def test_per_row_holiday_equals_table(spark):
    days = spark.range(0, 365 * 8).select(F.date_add(F.lit(D("1995-01-01")), F.col("id").cast("int")).alias("shipment_date"))
    hol = cal.holiday_dates(days, "shipment_date")
    joined = days.join(hol, days.shipment_date == hol.holiday_date, "left").select(
        "shipment_date", F.col("holiday_date").isNotNull().alias("a"), cal.is_holiday("shipment_date").alias("b"))
    assert joined.where(F.col("a") != F.col("b")).count() == 0


def test_event_window_and_nearest(spark):
    ds = [(dt.date(2017, 11, 20) + dt.timedelta(days=i)).isoformat() for i in range(11)]
    out = X.add_event_features(_dates(spark, ds))
    assert _col(out, "days_to_black_friday") == list(range(-4, 7))
    assert sum(_col(out, "is_black_friday_window")) == 11
    narrow = X.add_event_features(_dates(spark, ds), window_before=2, window_after=3)
    assert sum(_col(narrow, "is_black_friday_window")) == 6
    assert _col(out, "is_post_black_friday_peak") == [0] * 5 + [1, 1, 1] + [0] * 3
    near = X.add_event_features(_dates(spark, ["2017-12-01", "2018-11-20"]))
    assert _col(near, "days_to_black_friday") == [7, -3]


def test_event_candidates_only_years_present(spark):
    # Only 2018 present: a January date measures to Black Friday 2018.
    out = X.add_event_features(_dates(spark, ["2018-01-05"]))
    assert _col(out, "days_to_black_friday") == [(D("2018-01-05") - D("2018-11-23")).days]
    with pytest.raises(ValueError):
        X.event_step(window_before=-1)


def test_calendar_and_trend(spark):
    out = X.calendar_step(X.CALENDAR_FEATURES)(_dates(spark, ["2024-01-01", "2024-01-31", "2024-07-13", "2024-12-31"]))
    assert _col(out, "day_of_week") == [0, 2, 5, 1]
    assert _col(out, "week_of_year") == [1, 5, 28, 1]
    assert _col(out, "is_month_end") == [0, 1, 0, 1]
    tr = X.trend_step(D("2017-01-01"), X.TREND_FEATURES)(_dates(spark, ["2017-01-01", "2017-01-31", "2017-02-01", "2018-01-01", "2020-12-31"]))
    assert _col(tr, "days_since_start")[:4] == [0, 30, 31, 365]
    assert _col(tr, "month_index")[:4] == [0, 0, 1, 12]
    assert _col(tr, "year_progress")[4] == pytest.approx(1.0)   # leap-year Dec 31 reaches 1.0
    with pytest.raises(ValueError):
        X.calendar_step(["bogus"])


def test_volume_tiers(spark):
    df = spark.createDataFrame([("SP", 120), ("RJ", 25), ("AC", 0), ("XX", 3)], "entity string, n_shipments long")
    stats = spark.createDataFrame([("SP", 98.8), ("RJ", 24.2), ("AC", 0.11)], "entity string, __avg_volume double")
    out = {r.entity: (r.state_avg_volume, r.volume_tier) for r in X.add_volume_features(df, stats).collect()}
    assert out["SP"][1] == "core" and out["RJ"][1] == "core" and out["AC"][1] == "tail"
    assert out["XX"] == (0.0, "tail")                  # unknown -> fallback 0
    with pytest.raises(ValueError):
        X.add_volume_features(df, stats, thresholds=(10, 2))
