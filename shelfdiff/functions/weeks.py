"""ISO weeks (``YYYY-Www``) as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfdiff import fixed_values as fixed

SEOUL = "Asia/Seoul"


def week_of(day: Column) -> Column:
    """Date -> ISO week; the year is the ISO year, not the calendar year."""
    day = day.cast("date")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def _monday_unchecked(week: Column) -> Column:
    year = F.substring(week, 1, 4).try_cast("int")
    number = F.substring(week, 7, 2).try_cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(F.date_trunc("WEEK", fourth).cast("date"), (number - 1) * 7)


def has_week_format(week: Column) -> Column:
    return F.coalesce(week.rlike(r"\A[0-9]{4}-W[0-9]{2}\z"), F.lit(False))


def is_valid_week(week: Column) -> Column:
    """Format, range 1..53, and the week exists in that year."""
    shaped = has_week_format(week) & (F.substring(week, 1, 4) != "0000")
    exists = week_of(_monday_unchecked(week)) == week
    return F.when(shaped, F.coalesce(exists, F.lit(False))).otherwise(F.lit(False))


def monday_of(week: Column) -> Column:
    """Week -> its Monday; null for anything that is not a week."""
    return F.when(is_valid_week(week), _monday_unchecked(week))


def shift_week(week: Column, n: int) -> Column:
    return week_of(F.date_add(monday_of(week), 7 * n))


def previous_week(week: Column) -> Column:
    return shift_week(week, -1)


def week_gap(earlier: Column, later: Column) -> Column:
    """Whole weeks from ``earlier`` to ``later``."""
    return F.floor(F.datediff(monday_of(later), monday_of(earlier)) / 7).cast("int")


def week_index(week: Column) -> Column:
    """Consecutive number of the week (Monday 1970-01-05 is 0), for range frames."""
    return F.floor(F.datediff(_monday_unchecked(week), F.lit("1970-01-05").cast("date")) / 7) \
        .cast("int")


def in_seoul(moment: Column) -> Column:
    """Wall clock in Seoul at a moment, whole seconds, independent of the session time zone."""
    local = F.convert_timezone(None, F.lit(SEOUL), moment)
    return F.date_trunc("SECOND", local).cast("timestamp_ntz")


def now_kst() -> Column:
    """Wall clock in Seoul now."""
    return in_seoul(F.current_timestamp())


def seoul_text(local: Column) -> Column:
    """Wall clock in Seoul as ISO-8601 text with its offset."""
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))


def scraped_at() -> Column:
    """Seoul time now as ISO-8601 text."""
    return seoul_text(now_kst())


def current_week() -> Column:
    return week_of(now_kst())


def format_week(week: Column) -> Column:
    """``2026-W33`` -> ``2026년 33주차``."""
    return F.concat(F.substring(week, 1, 4), F.lit(fixed.WEEK_YEAR),
                    F.substring(week, 7, 2).try_cast("int").cast("string"), F.lit(fixed.WEEK_NUMBER))
