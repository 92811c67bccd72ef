"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression that is used inside a lambda is otherwise computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
