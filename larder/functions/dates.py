"""Dates from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a year-month-day date at the start of a text, and no further digit.
DATE_SHAPE = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})(?![0-9])"


def parse_date(text: Column | str) -> Column:
    """The date that ``text`` begins with as ``yyyy-MM-dd``, or NULL for anything else.

    Months and days may have one digit, and what follows the date does not matter unless it is a digit. The
    cast alone would also take shorter dates. Unlike ``try_to_date``, it needs no
    exception inside to turn an impossible day into NULL.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.rlike(DATE_SHAPE), F.regexp_extract(column, DATE_SHAPE, 1).try_cast("date"))
