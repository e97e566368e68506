"""Durations written as ISO-8601 text (``PT1H20M``), and sums of minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a readable duration looks like. The first PT comes before the first H or M,
# and whole numbers stand between PT and H, H and M, or PT and M. The first repeat is possessive,
# because a backtracking one takes stack for every change of character width.
NUMBER = r"\s*[+-]?[0-9]+\s*"
READABLE = rf"^(?:(?!PT)[^HM])*+PT{NUMBER}(?:H(?:{NUMBER}M|[^M]*$)|M[^H]*$)"

SMALLEST_INT, LARGEST_INT = -(2**31), 2**31 - 1


def duration_minutes(duration: Column | str, strict: bool = False) -> Column:
    """Whole minutes of a ``PT..H..M`` text as an int.

    Text with neither an ``H`` nor an ``M`` counts as 0 minutes; seconds and anything after the
    last marker used are ignored. Text that cannot be read, NULL, and results beyond the int
    range give NULL, or fail the job when ``strict`` is set.
    """
    text = F.col(duration) if isinstance(duration, str) else duration
    start = F.instr(text, "PT") + 2
    hour_at = F.instr(text, "H")
    minute_at = F.instr(text, "M")

    # The number between two positions. bigint, so that only the final sum is range-checked.
    def number(begin: Column, end: Column) -> Column:
        return text.substr(begin, end - begin).try_cast("bigint")

    hours = F.when(hour_at > 0, number(start, hour_at)).otherwise(0)
    minutes = F.when(
        minute_at > 0, number(F.when(hour_at > 0, hour_at + 1).otherwise(start), minute_at)
    ).otherwise(0)
    total = F.try_add(F.try_multiply(hours, F.lit(60)), minutes).try_cast("int")

    # Matching first keeps malformed text away from the casts: a failed try_cast raises and
    # catches an exception inside, which costs far more per row than the match.
    unmarked = (hour_at == 0) & (minute_at == 0)
    result = F.when(unmarked, 0).when(text.rlike(READABLE), total)
    if strict:
        shown = F.coalesce(text, F.lit("NULL"))
        message = F.concat(F.lit("cannot read as a duration: "), shown)
        result = F.coalesce(result, F.raise_error(message).cast("int"))
    return result


def total_minutes(first: Column | str, second: Column | str) -> Column:
    """Sum of two int columns; NULL if either is NULL or the sum leaves the int range.

    Checked in bigint, because ``try_add`` too pays for an exception on every overflow.
    """
    total = F.col(first) if isinstance(first, str) else first
    other = F.col(second) if isinstance(second, str) else second
    total = total.cast("bigint") + other.cast("bigint")
    return F.when(total.between(SMALLEST_INT, LARGEST_INT), total.cast("int"))
