"""Text normalisation and splitting, with the white space of Unicode and U+001C to U+001F."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\x{1c}-\x{1f}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{BLANK}+|{BLANK}+\z", "")


def strip_bound(text: Column) -> Column:
    """``strip`` of a bound name: the expression, which tries every position, runs for texts with white space at an end only."""
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(ends.rlike(rf"(?U){BLANK}"), strip(text)).otherwise(text)


def clean_ocr(text: Column) -> Column:
    """Lines stripped, blank lines dropped, runs of spaces and tabs made one space; null becomes empty."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n", -1)
    kept = F.filter(F.transform(lines, strip), lambda line: line != "")
    return F.array_join(F.transform(kept, lambda line: F.regexp_replace(line, "[ \t]+", " ")), "\n")


def sentences(text: Column) -> Column:
    """Pieces that end after ``.``, ``!`` or ``?``, stripped, without blank ones."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^.!?]*[.!?]|[^.!?]+\z)"), F.lit(1))
    return F.filter(F.transform(pieces, strip_bound), lambda s: s != "")


def words(text: Column) -> Column:
    """Stretches between white space; none for a blank text."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U){BLANK}+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def lines(text: Column) -> Column:
    """Lines without their ends; a final line end opens no further line."""
    inner = F.regexp_replace(text, rf"(?:{LINE_END})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(inner, LINE_END, -1))
