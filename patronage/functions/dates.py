"""Date helpers; business dates are always arguments, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ..codes import DATE_NO_FILE


def as_date(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("date")


def to_py_date(v) -> dt.date:
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(v)


def file_date(etl_id: Column) -> Column:
    """Date from the -yyyymmdd suffix of a load id; without one, the epoch."""
    text = F.nullif(F.regexp_extract(etl_id, r"-(\d{8})$", 1), F.lit(""))
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), as_date(DATE_NO_FILE))


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar months with a 31-day fraction; the same arithmetic in any SQL engine."""
    return (12 * (F.year(later) - F.year(earlier)) + (F.month(later) - F.month(earlier))
            + (F.dayofmonth(later) - F.dayofmonth(earlier)) / F.lit(31.0))


def age_years(birth: Column, on) -> Column:
    return F.round(months_apart(as_date(on), birth) / 12).cast("int")


def first_wednesday(day: dt.date) -> bool:
    """Is the day the first Wednesday of its month?"""
    return day.weekday() == 2 and day.day <= 7
