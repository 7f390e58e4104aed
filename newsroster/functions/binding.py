"""Evaluate an expression once and use it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    A column that is referenced inside a lambda would otherwise be computed for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
