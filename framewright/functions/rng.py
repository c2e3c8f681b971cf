"""Reproducible draws: a function of (seed, key, operator, position), whatever the partitioning.

``uniform`` draws once per row from an md5 digest. Operators that draw per word or character take one digest per row as the
``stream`` and hash positions into it with Spark's murmur3, which costs a small part of a digest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 4294967296.0


def uniform(seed: int | str, key: Column, op: str, position: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of an md5 digest."""
    name = F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(op), position.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / SCALE


def randint(seed: int | str, key: Column, op: str, position: Column, low: Column | int, high: Column | int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return (low + F.floor(uniform(seed, key, op, position) * (high - low + 1))).cast("int")


def stream(seed: int | str, key: Column, op: str) -> Column:
    """The start of an operator's draws for a row: a whole number below 2**32. Bind it once per row."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(op))), 1, 8), 16, 10).cast("long")


def draw(start: Column, position: Column, *more: Column | int) -> Column:
    """A number in [0, 1) for a position; further whole numbers separate several draws of one position."""
    parts = [F.lit(m) if isinstance(m, int) else m.cast("int") for m in more]
    return F.hash(start, position.cast("int"), *parts) / SCALE + 0.5


def draw_int(start: Column, position: Column, low: Column | int, high: Column | int, *more: Column | int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return (low + F.floor(draw(start, position, *(more or (1,))) * (high - low + 1))).cast("int")
