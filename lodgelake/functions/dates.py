"""Calendar expressions: month bucketing, month windows and integer date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgelake.functions._col import col

DATE_ID_FORMAT = "yyyyMMdd"  # the warehouse's to_char(d, 'YYYYMMDD')


def month_start(c) -> Column:
    """``date_trunc('month', d)::date`` -- stays a DATE, no time zone involved."""
    return F.trunc(col(c).cast("date"), "MM")


def date_id(c) -> Column:
    """``to_char(d, 'YYYYMMDD')::int``."""
    return F.date_format(col(c), DATE_ID_FORMAT).cast("int")


def date_from_id(c) -> Column:
    """Inverse of ``date_id`` by arithmetic (no string parsing): 20200507 -> 2020-05-07."""
    k = col(c)
    return F.make_date((k / 10000).cast("int"), ((k / 100).cast("int") % 100), k % 100)


def calendar_date_id(c, bounds: tuple[str, str] | None) -> Column:
    """The ``date_id`` a left join to a calendar over ``bounds`` would give: null outside.

    ``bounds=None`` means the calendar was derived from (and so covers) these dates.
    """
    d = col(c).cast("date")
    if bounds is None:
        return date_id(d)
    lo, hi = bounds
    return F.when(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), date_id(d))
