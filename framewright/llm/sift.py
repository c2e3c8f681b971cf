"""Dropping rows of a wide table by a narrow list of decisions, without shuffling the wide rows.

Every row has an identity, and a narrow table says for each of them whether its row stays or goes. Two bit maps of a fixed
size, both made of hashes of identities and joined by broadcast (one row per word of 64 bits, ``WORDS`` at most), answer nearly all
rows where they lie: the first has the identities that go, the second those that stay although the first seems to have
them. What the first lacks stays; what the first has and the second lacks goes. Both answers are exact, as all identities
are known. Only what both have, a small share of the rows until millions of identities go, is left to an exact join.
All of it runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.store import compact

WORDS = 1 << 18
"""Words of a map: 16.8 million bits, 4 MB to broadcast."""


def whole(docs: DataFrame) -> Column:
    """All columns as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def _word(key: Column, salt: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(WORDS))


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(key, F.lit(64)).cast("int"))


def bit_map(keys: DataFrame, salt: str) -> DataFrame:
    """(``salt``_word, ``salt``_bits) of a column ``key`` of hashes: at most ``WORDS`` rows."""
    made = keys.groupBy(_word(F.col("key"), salt).alias(f"{salt}_word")).agg(F.bit_or(_bit(F.col("key"))).alias(f"{salt}_bits"))
    return compact(made)


def has(rows: DataFrame, bits: DataFrame, salt: str) -> DataFrame:
    """``rows`` (with a column ``key``) and ``in_<salt>``: whether the map has the key."""
    joined = rows.withColumn(f"{salt}_at", _word(F.col("key"), salt)).join(F.broadcast(bits), F.col(f"{salt}_at") == F.col(f"{salt}_word"), "left")  # at most WORDS rows
    hit = F.coalesce(F.col(f"{salt}_bits").bitwiseAND(_bit(F.col("key"))) != 0, F.lit(False))
    return joined.withColumn(f"in_{salt}", hit).drop(f"{salt}_at", f"{salt}_word", f"{salt}_bits")


def maps(goes: DataFrame, stays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two maps for tables (key) of the hashes of identities that go and that stay. An identity may be in both."""
    first = bit_map(goes, "goes")
    return first, bit_map(has(stays.select("key"), first, "goes").filter("in_goes").select("key"), "stays")


def tested(rows: DataFrame, both: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``rows`` (with a column ``key``) with in_goes and in_stays."""
    return has(has(rows, both[0], "goes"), both[1], "stays")


def sift(docs: DataFrame, key: Column, both: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows to decide exactly), both as (row: struct of all columns, key); ``key`` hashes a row's identity."""
    marked = tested(docs.select(whole(docs).alias("row"), key.alias("key")), both)
    return marked.filter("not in_goes").select("row", "key"), marked.filter("in_goes and in_stays").select("row", "key")


def unwrapped(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``row`` again."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names])
