"""Arguments resolved on the caller's side."""

import datetime as dt

import pytest

from stationlake import DateParsingError, Frequency, Month, RequiredData, Year
from stationlake import values as V

D, T = dt.date, dt.datetime
END = dt.time(23, 59, 59, 999_999)


@pytest.mark.parametrize(
    "value, first, last",
    [
        (D(2023, 5, 4), D(2023, 5, 4), D(2023, 5, 4)),
        ("2023-05-04", D(2023, 5, 4), D(2023, 5, 4)),
        (Year(2024), D(2024, 1, 1), D(2024, 12, 31)),
        (Month(year=2024, month=2), D(2024, 2, 1), D(2024, 2, 29)),
        (Month(year=2023, month=2), D(2023, 2, 1), D(2023, 2, 28)),
    ],
)
def test_daily_range(value, first, last):
    assert V.date_range_of(value) == (first, last)


@pytest.mark.parametrize("value", ["2023-1x", "2023-1-5", "2023", "2023-02-30", "soon", ""])
def test_bad_dates(value):
    with pytest.raises(DateParsingError):
        V.date_range_of(value)
    with pytest.raises(DateParsingError):
        V.datetime_range_of(value)


@pytest.mark.parametrize("value", [Month(year=2023, month=13), Month(year=2023, month=0), Year(0)])
def test_bad_calendar(value):
    with pytest.raises(DateParsingError):
        V.date_range_of(value)
    with pytest.raises(DateParsingError):
        V.datetime_period_of(value)


def test_a_daily_argument_is_no_instant():
    with pytest.raises(TypeError):
        V.date_range_of(T(2023, 1, 1))


def test_daily_periods_are_months_and_years():
    assert V.date_period_of(Year(2023)) == (D(2023, 1, 1), D(2023, 12, 31))
    for value in (D(2023, 1, 1), "2023-01-01"):
        with pytest.raises(TypeError):
            V.date_period_of(value)


@pytest.mark.parametrize(
    "value, first, last",
    [
        (T(2023, 7, 15, 12, 30), T(2023, 7, 15, 12, 30), T(2023, 7, 15, 12, 30)),
        (
            T(2023, 7, 15, 12, tzinfo=dt.timezone(dt.timedelta(hours=2))),
            T(2023, 7, 15, 10),
            T(2023, 7, 15, 10),
        ),
        ("2023-07-15T12:00:00+02:00", T(2023, 7, 15, 10), T(2023, 7, 15, 10)),
        ("2023-11-05T06:30:00Z", T(2023, 11, 5, 6, 30), T(2023, 11, 5, 6, 30)),
        (
            "2023-11-05T06:30:00.25Z",
            T(2023, 11, 5, 6, 30, 0, 250_000),
            T(2023, 11, 5, 6, 30, 0, 250_000),
        ),
        ("2023-07-15 12:00:00", T(2023, 7, 15, 12), T(2023, 7, 15, 12)),
        (D(2023, 7, 15), T(2023, 7, 15), T.combine(D(2023, 7, 15), END)),
        ("2023-07-15", T(2023, 7, 15), T.combine(D(2023, 7, 15), END)),
        (Year(2023), T(2023, 1, 1), T.combine(D(2023, 12, 31), END)),
        (Month(year=2023, month=2), T(2023, 2, 1), T.combine(D(2023, 2, 28), END)),
    ],
)
def test_hourly_range(value, first, last):
    assert V.datetime_range_of(value) == (first, last)


def test_a_zoneless_t_text_is_refused():
    with pytest.raises(DateParsingError):
        V.datetime_range_of("2023-07-15T12:00:00")


def test_hourly_periods_are_days_months_and_years():
    assert V.datetime_period_of("2023-07-15")[1] == T.combine(D(2023, 7, 15), END)
    with pytest.raises(TypeError):
        V.datetime_period_of(T(2023, 7, 15))
    with pytest.raises(DateParsingError):
        V.datetime_period_of("2023-07-15 12:00:00")


def test_months_are_not_checked():
    odd = Month(year=2023, month=13)
    assert V.month_range_of(odd) == (odd, odd)
    assert V.month_period_of(Year(2023)) == (Month(2023, 1), Month(2023, 12))
    with pytest.raises(TypeError):
        V.month_period_of(Month(2023, 1))


@pytest.mark.parametrize(
    "at, hour",
    [
        (T(2023, 1, 1, 14, 29, 59, 999_999), T(2023, 1, 1, 14)),
        (T(2023, 1, 1, 14, 30), T(2023, 1, 1, 15)),
        (T(2023, 12, 31, 23, 30), T(2024, 1, 1)),
    ],
)
def test_nearest_hour(at, hour):
    assert V.nearest_hour(at) == hour


def test_end_of_requirements():
    assert RequiredData.any().end_date() is None
    assert RequiredData.specific_date(D(2020, 5, 1)).end_date() == D(2020, 5, 1)
    assert RequiredData.date_range(D(2020, 5, 1), D(2021, 5, 1)).end_date() == D(2021, 5, 1)
    assert RequiredData.full_year(2020).end_date() == D(2020, 12, 31)
    assert RequiredData.full_year(300_000).end_date() is None


def test_texts():
    assert [str(f) for f in Frequency] == ["hourly", "daily", "monthly", "normals"]
    assert (str(Year(987)), str(Month(year=2023, month=4))) == ("0987", "2023-04")
    assert Year(2024).is_leap and not Year(2023).is_leap and not Year(1900).is_leap
    assert Month(2022, 12) < Month(2023, 1)
