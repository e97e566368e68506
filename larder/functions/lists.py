"""Lists kept as newline-separated text or as arrays of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lines(text: Column | str) -> Column:
    """Text as an array of its lines; a trailing newline gives a last empty element."""
    return F.split(text, "\n")


def mentions(items: Column | str, term: str) -> Column:
    """1 when any element contains ``term``, ignoring case, else 0.

    The term matches inside words too. A NULL array, an empty one and NULL elements do not match.
    """
    needle = F.lower(F.lit(term))
    found = F.exists(items, lambda item: F.lower(item).contains(needle))
    return F.coalesce(found, F.lit(False)).cast("int")
