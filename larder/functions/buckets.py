"""Labels from ordered conditions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Callable[[Column], Column]]


def first_match(value: Column | str, rules: Sequence[Rule], otherwise: str) -> Column:
    """Label of the first rule that holds for ``value``.

    NULL satisfies no comparison, so it ends up in ``otherwise``.
    """
    column = F.col(value) if isinstance(value, str) else value
    (label, holds), *rest = rules
    labelled = F.when(holds(column), label)
    for label, holds in rest:
        labelled = labelled.when(holds(column), label)
    return labelled.otherwise(otherwise)
