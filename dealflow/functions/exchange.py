"""P10 + P11 corrected: sessions of an exchange by its own zone, with daylight saving and holidays.

The reference takes 14:30 to 21:00 UTC all year and knows no holidays.  Here the opening and closing times are wall
clock of the exchange's zone, so the UTC times follow its daylight saving, and days on which it is shut are no
sessions.  Holidays come from rules, as a literal list of some ten dates a year; everything is a column expression.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_CLOSED_DAYS = 10                           # no exchange here is shut for so many days in a row


def _nth(year: int, month: int, weekday: int, n: int) -> dt.date:
    """The ``n``-th given weekday (Monday is 0) of a month; -1: the last."""
    if n > 0:
        first = dt.date(year, month, 1)
        return first + dt.timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(1)
    return last - dt.timedelta((last.weekday() - weekday) % 7)


def easter(year: int) -> dt.date:
    """Easter Sunday of the Gregorian calendar."""
    golden, century = year % 19, year // 100
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    moon = epact - (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    weekday = (year + year // 4 + moon + 2 - century + century // 4) % 7
    offset = moon - weekday
    month = 3 + (offset + 40) // 44
    return dt.date(year, month, offset + 28 - 31 * (month // 4))


def us_holidays(first_year: int, last_year: int) -> list[dt.date]:
    """Weekdays on which the US stock exchanges are shut by rule.  A fixed date on a Sunday is kept on Monday, on a
    Saturday on Friday, except New Year's Day, which a Saturday swallows."""
    out = []
    for y in range(first_year, last_year + 1):
        out += [_nth(y, 1, 0, 3), _nth(y, 2, 0, 3), easter(y) - dt.timedelta(2), _nth(y, 5, 0, -1), _nth(y, 9, 0, 1),
                _nth(y, 11, 3, 4)]
        for day in [dt.date(y, 1, 1), dt.date(y, 7, 4), dt.date(y, 12, 25)] + [dt.date(y, 6, 19)] * (y >= 2022):
            if day.weekday() == 6:
                out.append(day + dt.timedelta(1))
            elif day.weekday() < 5:
                out.append(day)
            elif (day.month, day.day) != (1, 1):
                out.append(day - dt.timedelta(1))
    return sorted(out)


@dataclass(frozen=True)
class Exchange:
    zone: str = "America/New_York"
    open_minute: int = 9 * 60 + 30
    close_minute: int = 16 * 60
    holidays: tuple[dt.date, ...] = tuple(us_holidays(1990, 2040))

    def local(self, utc: Column) -> Column:
        """UTC wall clock to the exchange's."""
        return F.convert_timezone(F.lit("UTC"), F.lit(self.zone), utc)

    def utc(self, day: Column, minute: int) -> Column:
        """The UTC wall clock of a local time of day on a date."""
        local = day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minute), F.lit(0))
        return F.convert_timezone(F.lit(self.zone), F.lit("UTC"), local)

    def is_session(self, day: Column) -> Column:
        shut = day.isin(*self.holidays) if self.holidays else F.lit(False)
        return (F.weekday(day) < 5) & ~shut

    def session_date(self, utc: Column) -> Column:
        """The first session that isn't over at ``utc``.  Null stays null."""
        local = self.local(utc)
        day = F.to_date(local)
        over = F.hour(local) * 60 + F.minute(local) >= self.close_minute
        start = F.when(over, F.date_add(day, 1)).otherwise(day)
        days = F.sequence(start, F.date_add(start, MAX_CLOSED_DAYS))
        return F.when(utc.isNotNull(), F.get(F.filter(days, self.is_session), F.lit(0)))

    def context(self, utc: Column) -> Column:
        """P10: weekend, holiday, pre-market, market-hours, after-hours or unknown, at the exchange."""
        local = self.local(utc)
        minute = F.hour(local) * 60 + F.minute(local)
        return (F.when(utc.isNull(), "unknown").when(F.weekday(local) >= 5, "weekend")
                .when(~self.is_session(F.to_date(local)), "holiday").when(minute < self.open_minute, "pre-market")
                .when(minute < self.close_minute, "market-hours").otherwise("after-hours"))
