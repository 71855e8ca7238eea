"""Date parsing and day counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnOrName, as_col

_US_FORMAT = "M/d/yyyy"


def us_date(c: ColumnOrName) -> Column:
    """Month/day/year; a bad or blank value stops the job, NULL stays NULL."""
    c = as_col(c)
    bad = F.raise_error(F.concat(F.lit("not a month/day/year date: "), c))
    return F.coalesce(F.try_to_date(c, _US_FORMAT), F.when(c.isNotNull(), bad.cast("date")))


def us_date_or_null(c: ColumnOrName) -> Column:
    """As ``us_date`` but blank means no date."""
    c = F.trim(as_col(c))
    return us_date(F.when(c != "", c))


def iso_date_prefix(c: ColumnOrName) -> Column:
    """Date in the first ten characters of an ISO timestamp text."""
    return F.to_date(F.left(as_col(c), F.lit(10)))


def to_day(c: ColumnOrName) -> Column:
    return as_col(c).cast("date")


def days_until(c: ColumnOrName, as_of: dt.date | str) -> Column:
    """Days from ``as_of`` to the date; the run date is always a parameter."""
    return F.datediff(as_col(c), F.lit(str(as_of)).cast("date"))
