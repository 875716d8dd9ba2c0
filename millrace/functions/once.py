"""Expensive expressions that later filters would otherwise repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """The same value, computed once per row.

    A filter over a projected column is moved below the projection with the whole
    expression copied into it, so parsed JSON would be parsed again for each condition. It
    is not moved below a generator. One such column per ``select``.
    """
    return F.explode(F.array(value))
