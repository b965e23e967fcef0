"""Time projections: sessions, filing context, local time, feed timestamps.

All timestamps are TIMESTAMP_NTZ holding UTC wall-clock time, so results do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (reference defaults): session open 14:30 UTC, close 21:00 UTC.
SESSION_OPEN_MINUTE = 14 * 60 + 30
SESSION_CLOSE_HOUR = 21


def minute_floor(ts: Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to the minute without a zone round trip."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.minute(ts), F.lit(0))


def day_start(d: Column) -> Column:
    """Midnight of a DATE as TIMESTAMP_NTZ."""
    return d.cast("timestamp_ntz")


def session_open_ts(d: Column, open_minute: int = SESSION_OPEN_MINUTE) -> Column:
    """The fixed UTC session open on date ``d``."""
    return day_start(d) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(open_minute), F.lit(0))


def plus_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))


def next_session_date(ts: Column, close_hour: int = SESSION_CLOSE_HOUR) -> Column:
    """Filings at or after the close, or on a weekend, move to the next
    weekday; the rest keep their own date.  Null input gives null."""
    d = F.to_date(ts)
    rolled = F.when((F.hour(ts) >= close_hour) | (F.weekday(ts) >= 5), F.date_add(d, 1)).otherwise(d)
    wd = F.weekday(rolled)
    return F.when(wd == 5, F.date_add(rolled, 2)).when(wd == 6, F.date_add(rolled, 1)).otherwise(rolled)


def filing_context(ts: Column, open_minute: int = SESSION_OPEN_MINUTE,
                   close_hour: int = SESSION_CLOSE_HOUR) -> Column:
    """P10: weekend / pre-market / market-hours / after-hours / unknown.

    Seconds are ignored (``h = hour + minute/60``); weekend is tested first."""
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    return (F.when(ts.isNull(), F.lit("unknown"))
            .when(F.weekday(ts) >= 5, F.lit("weekend"))
            .when(minute_of_day < open_minute, F.lit("pre-market"))
            .when(minute_of_day < close_hour * 60, F.lit("market-hours"))
            .otherwise(F.lit("after-hours")))


# English day and month abbreviations (RFC 2822).
DAY_ABBR = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
EPOCH_NTZ = "1970-01-01 00:00:00"

# Rendering works on the NTZ value's own text (``cast(ts as string)``), so it
# never passes through the session time zone (no DST gap or overlap shifts).


def ntz_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ."""
    return F.substring(ts.cast("string"), 1, 19)


def fmt_date(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 10)


def fmt_minute(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm``."""
    return F.substring(ts.cast("string"), 1, 16)


def iso_seconds(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS`` rendering (the reference's ISO form)."""
    t = ntz_text(ts)
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 8))


def rfc2822(ts: Column) -> Column:
    """``Mon, 01 Jan 2024 10:00:00`` (no zone suffix)."""
    t = ntz_text(ts)
    days = F.array(*[F.lit(d) for d in DAY_ABBR])
    months = F.array(*[F.lit(m) for m in MONTH_ABBR])
    return F.concat(F.try_element_at(days, F.weekday(ts) + 1), F.lit(", "), F.substring(t, 9, 2), F.lit(" "),
                    F.try_element_at(months, F.month(ts)), F.lit(" "), F.substring(t, 1, 4), F.lit(" "),
                    F.substring(t, 12, 8))


def utc_instant(ntz: Column) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) to the instant (TIMESTAMP), exactly.
    Pass a column reference: the input is read once per field."""
    return F.make_timestamp(F.year(ntz), F.month(ntz), F.dayofmonth(ntz), F.hour(ntz), F.minute(ntz),
                            F.date_part(F.lit("SECOND"), ntz), F.lit("UTC"))


def to_utc_wall(ltz: Column) -> Column:
    """An instant (TIMESTAMP) to its UTC wall clock as TIMESTAMP_NTZ,
    whatever the session zone is (epoch arithmetic, no zone rules)."""
    secs = (F.unix_micros(ltz) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def parse_published(raw: Column) -> Column:
    """Feed publication time to UTC TIMESTAMP_NTZ.

    RFC 2822 (``Mon, 01 Jan 2024 10:00:00 -0500``) after stripping the day
    name, else ISO-8601 with ``Z`` or an offset, else ISO-8601 without a
    zone (read as UTC); blank or unparseable is null.
    """
    s = F.trim(raw)
    no_day = F.regexp_replace(s, r"^[A-Za-z]{3},\s*", "")
    rfc = F.try_to_timestamp(no_day, F.lit("d MMM yyyy HH:mm:ss Z"))
    iso = F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    bare = F.try_to_timestamp(F.concat(s, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    return to_utc_wall(F.coalesce(rfc, iso, bare))


def local_time_v1(ts: Column) -> Column:
    """P9 (v1 approximation): CEST for months 4-9, March from day 25 and
    October before day 25; format ``%Y-%m-%d o %H:%M:%S TZ``."""
    m, d = F.month(ts), F.dayofmonth(ts)
    summer = ((m > 3) & (m < 10)) | ((m == 3) & (d >= 25)) | ((m == 10) & (d < 25))
    off = F.when(summer, F.lit(2)).otherwise(F.lit(1))
    local = ts + F.make_dt_interval(F.lit(0), off, F.lit(0), F.lit(0))
    name = F.when(summer, F.lit("CEST")).otherwise(F.lit("CET"))
    t = ntz_text(local)
    return F.concat(F.substring(t, 1, 10), F.lit(" o "), F.substring(t, 12, 8), F.lit(" "), name)


def local_time_v2(ts: Column) -> Column:
    """P9 (v2 approximation): CEST for months 4-9 only; ``%Y-%m-%d %H:%M TZ``."""
    m = F.month(ts)
    summer = (m > 3) & (m < 10)
    off = F.when(summer, F.lit(2)).otherwise(F.lit(1))
    local = ts + F.make_dt_interval(F.lit(0), off, F.lit(0), F.lit(0))
    name = F.when(summer, F.lit("CEST")).otherwise(F.lit("CET"))
    return F.concat(fmt_minute(local), F.lit(" "), name)


def local_time_iana(ts: Column, zone: str = "Europe/Warsaw") -> Column:
    """P9 corrected: the IANA zone's real transitions (UTC wall clock in)."""
    # convert_timezone works on NTZ wall clocks and ignores the session zone
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return fmt_minute(local)
