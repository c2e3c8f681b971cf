"""Exact deduplication by a tree merge of sorted digest runs.

Texts are equal when identical after lower-casing A-Z. Each partition of the input makes a run: its distinct
digests, sorted, each with its best identifier and its number of rows. Runs are merged in binomial rounds: in a round
the runs of 2**``fan_bits`` neighbours meet, cut by hash of the digest into slices so that no task holds a whole run; the pieces of a
slice are put in order and merged in one pass, and equal digests become one entry that keeps the best identifier.
The winner goes back down the same tree, so a digest that a third of all rows share meets at most
2**``fan_bits`` entries in any merge, never its rows.

An entry's key is the whole SHA-256 with the text's length; both are compared at every level.

Nulls: a null text counts as empty, and all empty texts are equal. A null doc_id loses against any other; a
group of only null ids keeps one row. If several rows have the winning doc_id and equal text, one of them stays.
An empty table gives an empty result. Columns other than doc_id and text are ignored by ``dedup`` and kept by ``keep_one``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.sift import maps, sift, tested, unwrapped
from framewright.llm.store import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FAN_BITS = 4
SLICES = 1024
"""Slices of a run: many more than tasks, so that these get equal shares."""


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty. Texts of one byte per character need no character map."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def runs_of(docs: DataFrame) -> DataFrame:
    """The narrow table of all rows: doc_id, row, run, digest, bytes. Settled: the runs stay what they are."""
    text = normalised(F.col("text"))
    return settle(
        docs.select("doc_id", text.alias("t")).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("run"),
            F.unhex(F.sha2("t", 256)).alias("digest"),
            F.octet_length("t").alias("bytes"),
        )
    )


def _merged(runs: DataFrame) -> DataFrame:
    """One entry for equal digests of a run; the largest (doc_id, row) wins, null ids last."""
    return runs.groupBy("run", "slice", "digest", "bytes").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def dedup(docs: DataFrame, fan_bits: int = FAN_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = runs_of(docs)
    n_runs = int(rows.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]) + 1
    best = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row")
    cut = F.pmod(F.xxhash64("digest"), F.lit(SLICES)).cast("int")
    key = ["run", "slice", "digest", "bytes"]
    levels = [settle(_merged(rows.select("run", cut.alias("slice"), "digest", "bytes", best.alias("best"), F.lit(1).cast("bigint").alias("n"))))]
    while n_runs > 1:
        met = levels[-1].withColumn("run", F.shiftright("run", fan_bits)).repartition("run", "slice").sortWithinPartitions(*key)
        levels.append(settle(_merged(met)))
        n_runs = ((n_runs - 1) >> fan_bits) + 1
    won = levels.pop().drop("slice")
    while levels:
        below = levels.pop().select("run", "digest", "bytes")
        above = won.select(F.col("run").alias("up"), "digest", "bytes", "best", "n")
        won = below.withColumn("up", F.shiftright("run", fan_bits)).join(above, ["up", "digest", "bytes"]).drop("up")
    return rows.join(won, ["run", "digest", "bytes"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one row of each group of equal texts; all columns stay.

    Rows are decided by doc_id where they lie. Left to an exact join on doc_id and digest are rows of a doc_id of
    which some rows stay and others go, and the few that the bit maps can't tell; of rows that have both in common, one stays.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    made = settle(dedup(docs).select(F.xxhash64(name).alias("key"), name.alias("id"), F.unhex("text_sha256").alias("digest"), "kept"))
    both = maps(made.filter("not kept"), made.filter("kept"))
    stays, unsure = sift(docs, F.xxhash64(name), both)
    won = tested(made.filter("kept"), both).filter("in_goes").select("id", "digest")
    asked = unsure.select("row", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")).alias("id"), digest_of(F.col("row.text")).alias("digest"))
    one = asked.join(won, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"])
    return unwrapped(stays.select("row").unionByName(one.select("row")), docs.columns)
