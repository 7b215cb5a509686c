"""Lists of labels whose conditions hold."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def labels_of(checks: list[tuple[Column, str]]) -> Column:
    """Labels of the true conditions in their order; NULL is not true.

    Spark compiles ``array_remove``; ``array_compact`` calls a function on every element,
    which takes longer than all the conditions together.
    """
    return F.array_remove(F.array(*[F.when(holds, label).otherwise("") for holds, label in checks]), "")
