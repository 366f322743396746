"""Date column expressions. The processing date is always a parameter, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def lit_date(value: str | dt.date) -> Column:
    return F.lit(as_date(value))


def parse_iso_date(c: Column | str) -> Column:
    """Text -> DATE, anything unparseable -> NULL (ANSI ``to_date`` would raise)."""
    c = _col(c)
    return c.cast("string").try_cast("date")


def parse_yyyymmdd(c: Column | str) -> Column:
    """Integer date code ``YYYYMMDD`` -> DATE; ``0``, ``32154``, ``20130231`` -> NULL. Codes that are
    whole numbers are taken apart as such; what is left goes through the text parser."""
    c = _col(c)
    text, n = c.cast("string"), c.try_cast("int")
    year, month, day = F.call_function("div", n, F.lit(10_000)).cast("int"), F.call_function("div", n % 10_000, F.lit(100)).cast("int"), n % 100
    # no month is out of range where the expression may be evaluated for a bad code, too
    date = F.date_add(F.make_date(year, F.least(F.greatest(month, F.lit(1)), F.lit(12)), F.lit(1)), day - 1)
    whole = n.between(10_000_101, 99_991_231) & (day > 0) & (F.month(date) == month)
    return F.when((n >= 0) & (n.cast("string") == text), F.when(whole, date)).otherwise(F.try_to_date(text, "yyyyMMdd"))


def yyyymmdd_code(d: Column | str) -> Column:
    """DATE -> integer code ``YYYYMMDD``."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def code_of_date(d: Column | str) -> Column:
    """DATE -> the one integer code that ``parse_yyyymmdd`` reads as it; NULL where no code does."""
    d = _col(d)
    year, rest = F.year(d), F.month(d) * 100 + F.dayofmonth(d)
    return F.when(year.between(1000, 9999), year * 10_000 + rest).when(year.between(-200_000, -1000), year * 10_000 - rest).cast("int")


def clamp_future(d: Column | str, processing_date: str | dt.date) -> Column:
    """Dates after the processing date become the processing date; NULL stays NULL
    (``least`` would skip the NULL and return the processing date)."""
    d = _col(d)
    p = lit_date(processing_date)
    return F.when(d > p, p).otherwise(d)


def month_name(d: Column | str) -> Column:
    """Full English month name (``F.monthname`` gives the short form)."""
    return F.date_format(_col(d), "MMMM")


def date_parts(d: Column | str) -> dict[str, Column]:
    d = _col(d)
    return {
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "month_name": month_name(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
    }
