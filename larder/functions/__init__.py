"""Column -> Column expressions. All of them stay inside the JVM."""

from larder.functions.buckets import first_match
from larder.functions.dates import parse_date
from larder.functions.durations import duration_minutes, total_minutes
from larder.functions.lists import lines, mentions

__all__ = ["duration_minutes", "first_match", "lines", "mentions", "parse_date", "total_minutes"]
