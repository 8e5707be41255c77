import datetime as dt

from strata.sources.calendar import CALENDAR_COLUMNS, calendar, calendar_days


def brute_week(d: dt.date) -> int:
    # Monday-start weeks, week 1 is the week holding Jan 1
    jan1 = dt.date(d.year, 1, 1)
    start = jan1 - dt.timedelta(days=jan1.weekday())
    return (d - start).days // 7 + 1


def test_calendar_full_span(spark):
    cal = calendar(spark, as_of="2024-06-15")
    assert cal.columns == CALENDAR_COLUMNS
    rows = cal.collect()
    assert len(rows) == calendar_days() == 14975
    for r in rows:
        d = r.Date
        assert r.WeekOfYear == brute_week(d)
        assert r.DayOfWeekNumber == d.isoweekday()
        assert r.DateKey == int(d.strftime("%Y%m%d"))
        assert r.DayOfYear == d.timetuple().tm_yday
        assert r.IsLeapYear == (d.year % 4 == 0 and (d.year % 100 != 0 or d.year % 400 == 0))
        assert r.IsWeekend == (d.isoweekday() >= 6) and r.IsWeekday == (d.isoweekday() < 6)
        assert r.MonthName == d.strftime("%B") and r.MonthShort == d.strftime("%b")
        assert r.DayOfWeekName == d.strftime("%A") and r.DayOfWeekShort == d.strftime("%a")
        assert r.YearMonthName == d.strftime("%Y %b")
        assert r.YearQuarterName == f"{d.year} Q{(d.month - 1) // 3 + 1}"
        assert r.YearMonth == d.year * 100 + d.month


def test_relative_flags(spark):
    cal = calendar(spark, "2024-06-14", "2024-06-16", as_of="2024-06-15").collect()
    past, today, future = cal
    assert past.IsPastDate and not past.IsFutureDate
    assert not today.IsPastDate and not today.IsFutureDate
    assert future.IsFutureDate and not future.IsPastDate
    assert all(r.IsCurrentYear and r.IsCurrentMonth and r.IsCurrentQuarter for r in cal)
