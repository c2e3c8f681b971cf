"""Back-references between the texts of a list: ``F:<i>`` stands for the resolved text i, and what follows is appended."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.let import let

REFERENCE = r"\AF:([0-9]+)(?!\p{N})"


def reference(text: Column) -> Column:
    """The index that a text refers to; null if it is no reference or has too many digits."""
    return F.regexp_extract(text, REFERENCE, 1).try_cast("int")


def remainder(text: Column, decode_append: bool = False) -> Column:
    """What follows the reference; with ``decode_append`` the form ``+ "..."`` is read as the text in quotes."""
    rest = F.regexp_replace(text, REFERENCE, "")
    if not decode_append:
        return rest
    inner = F.regexp_extract(rest, r'(?s)\A\s*\+\s*"(.*)"\s*\z', 1)
    plain = F.replace(F.replace(F.replace(inner, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    return F.when(rest.rlike(r'(?s)\A\s*\+\s*".*"\s*\z'), plain).otherwise(rest)


def resolve_list(texts: Column, decode_append: bool = False) -> Column:
    """Every text with its reference resolved. Only earlier texts can be referred to; other references stay as they are."""

    def step(done: Column, text: Column) -> Column:
        def one(at: Column) -> Column:
            whole = F.concat(F.coalesce(F.get(done, at), F.lit("")), remainder(text, decode_append))
            return F.when(at.isNotNull() & (at < F.size(done)), whole).otherwise(text)

        return F.concat(done, F.array(let(reference(text), one)))

    return F.aggregate(texts, F.array().cast("array<string>"), step)


def encode_refs(text: Column, previous: Column, index: Column) -> Column:
    """The inverse for neighbours: a text that is or begins with the previous one refers to it (index is the text's own)."""
    ref = F.concat(F.lit("F:"), (index - 1).cast("string"))
    rest = F.substr(text, F.char_length(previous) + 1)
    safe = ~rest.rlike(r"\A\p{N}")
    return F.when(previous.isNotNull() & text.startswith(previous) & safe, F.concat(ref, rest)).otherwise(text)
