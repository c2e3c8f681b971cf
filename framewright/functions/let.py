"""Binding an expression to a name inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    Lambda bodies are evaluated per element, and nested text operators repeat their input; both would evaluate a plain
    expression again each time.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
