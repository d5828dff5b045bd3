"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Inside array lambdas Spark repeats an expression at every mention; a
    value bound here is computed once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
