"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cut per source.

A text's size is its number of words. Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and
share all sizes; a source's target stops at ``max_epochs`` times its size and the excess goes to the others by weight.
A source is read whole for as many epochs as fit its target; the rest is cut from its documents in the order
of md5(doc_id): the document on the cut gives exactly the words that are missing.

A source's documents are dealt to ``buckets`` ranges of that key, so that no task holds a whole source: sums per range and a running sum
over the ranges give the range of the cut, and a running sum inside that range the document on the cut. Equal documents
(key, doc_id, size) are summed before. Every other document is decided where it lies, by its place before or after the cut.

Nulls: a null text has size 0, a null source is a source of its own, a null doc_id sorts by the key of ''.
Empty texts are never taken. Repeated rows are separate documents: among equal keys the order of
(doc_id, size) decides, and equal rows are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.sift import unwrapped, whole
from framewright.llm.store import compact, rows_in, settle

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
SOURCES = 1 << 16
"""Up to so many sources have their cuts broadcast, 200 bytes each; those of more are joined."""
PARTS = 1024


def key_of(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` with weight: 1, 2, 3, 1, ... in the order of the names. Names are dealt to ranges and counted per range."""
    dealt = settle(sizes.repartitionByRange("snull", "skey").withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))  # one row per range
    inside = F.row_number().over(Window.partitionBy("range").orderBy("snull", "skey"))
    return dealt.withColumn("inside", inside).join(F.broadcast(ahead), "range").select(*sizes.columns, (F.pmod(F.col("ahead") + F.col("inside") - 1, F.lit(3)) + 1).cast("bigint").alias("weight"))


def targets(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """(skey, snull, source_size) -> the same with target: weights 1, 2, 3, ... filled up to the caps.

    The level, words per unit of weight, starts as all words over all weights. Sources whose cap lies below their share get
    their cap and leave the rest to the others, which only raises the level; this ends when no further source is
    capped. Each step is a sum over all sources; the driver sees three numbers of it.
    """
    cap = F.col("source_size") * max_epochs
    rows = settle(ranked(sizes).withColumn("cap", cap.cast("bigint")))
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped_rows = 0.0, -1
    while True:
        below = F.lit(level) * F.col("weight") > F.col("cap")
        capped, open_weight, n = rows.agg(
            F.coalesce(F.sum(F.when(below, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~below, F.col("weight"))), F.lit(0)), F.count_if(below)
        ).first()
        if n == capped_rows or not open_weight:
            break
        level, capped_rows = (total - capped) / open_weight, n
    return rows.select("skey", "snull", "source_size", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def narrow(docs: DataFrame, buckets: int) -> DataFrame:
    """One settled row per document: doc_id, skey, snull, size, key, bucket, id."""
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce("source", F.lit("")).alias("skey"),
        F.col("source").isNull().alias("snull"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        key_of(F.col("doc_id")).alias("key"),
    )
    bucket = F.floor(F.conv(F.substring("key", 1, 6), 16, 10).cast("long") * buckets / (1 << 24)).cast("int")
    return settle(rows.withColumns({"bucket": bucket, "id": F.monotonically_increasing_id()}))


def cuts(rows: DataFrame, max_epochs: int) -> DataFrame:
    """One settled row per source: skey, snull, source_size, target, epochs and the cut, null if the epochs fill the target:
    last (key, doc_id, size of the documents on it), alike (their number) and words (that they give together)."""
    name = ["skey", "snull"]
    ranges = rows.groupBy(*name, "bucket").agg(F.sum("size").alias("words"))
    source = targets(ranges.groupBy(*name).agg(F.sum("words").alias("source_size")), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    source = settle(source.withColumn("epochs", epochs).withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size")))

    def reached(sums: DataFrame, *order: str) -> DataFrame:
        """The row of each source in which the running sum of words reaches ``rest``, less what comes before."""
        ahead = F.coalesce(F.sum("words").over(Window.partitionBy(*name).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found = sums.withColumn("rest", F.col("rest") - ahead)
        return found.filter((F.col("rest") > 0) & (F.col("rest") <= F.col("words")))

    at = reached(ranges.join(source.filter("rest > 0").select(*name, "rest"), name), "bucket").select(*name, "bucket", "rest")
    near = rows.filter("size > 0").join(_small(at), [*name, "bucket"])
    equal = near.groupBy(*name, "key", "doc_id", "size", "rest").agg(F.count(F.lit(1)).alias("alike"))
    last = reached(equal.withColumn("words", F.col("alike") * F.col("size")), "key", "doc_id", "size")
    cut = last.select(*name, F.struct("key", "doc_id", "size").alias("last"), "alike", F.col("rest").alias("words"))
    return settle(source.drop("rest").join(cut, name, "left"))


def _small(by_source: DataFrame) -> DataFrame:
    """A table of at most a row per source, broadcast as far as its size is known to be small."""
    settled = compact(by_source)
    return F.broadcast(settled) if rows_in(settled) <= SOURCES else settled


def with_cut(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` (skey, snull, key, id, size_of ...) with the columns of their source's cut, each named cut_..."""
    named = _small(cut.toDF(*[f"cut_{c}" for c in cut.columns]))
    return rows.join(named, (F.col("skey") == F.col("cut_skey")) & (F.col("snull") == F.col("cut_snull")))


def place(doc_id: Column, size: Column) -> Column:
    """-1, 0, 1: before its source's cut, on it, after it. The size counts only among equal ids, so it is seldom needed."""
    here, there = F.struct(F.col("key"), doc_id.alias("doc_id")), F.struct(F.col("cut_last.key"), F.col("cut_last.doc_id"))
    return F.when(F.col("cut_last").isNull() | (here > there), 1).when(here < there, -1).otherwise(F.signum(size - F.col("cut_last.size")).cast("int"))


def numbered(alike: DataFrame) -> DataFrame:
    """``alike`` (skey, snull, id, ...: settled) with nth, from 0 in each source: counts of ``PARTS`` parts, a running sum over them, numbers inside."""
    of_part = ["skey", "snull", "part"]
    rows = alike.withColumn("part", F.pmod("id", F.lit(PARTS)))
    before = Window.partitionBy("skey", "snull").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*of_part).agg(F.count(F.lit(1)).alias("n"))
    ahead = counts.select(*of_part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy(*of_part).orderBy("id")) - 1
    return rows.withColumn("inside", inside).join(ahead, of_part).withColumn("nth", F.col("ahead") + F.col("inside")).drop("part", "inside", "ahead")


def mix(docs: DataFrame, max_epochs: int = 3, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, cut_words, taken."""
    rows = narrow(docs, buckets)
    cut = cuts(rows, max_epochs)
    met = with_cut(rows, cut).withColumn("place", F.when(F.col("size") == 0, 1).otherwise(place(F.col("doc_id"), F.col("size"))))
    split = (F.col("place") == 0) & (F.col("cut_alike") > 1)
    words = F.when(F.col("place") < 0, F.col("size")).when(F.col("place") == 0, F.col("cut_words")).otherwise(0)
    found = met.withColumn("of_cut", words.cast("bigint"))
    if not cut.filter("alike > 1").isEmpty():
        some = numbered(settle(met.filter(split)))
        share = F.greatest(F.lit(0), F.least(F.col("size"), F.col("cut_words") - F.col("nth") * F.col("size")))
        found = found.filter(~split).unionByName(some.withColumn("of_cut", share.cast("bigint")).drop("nth"))
    return found.select(
        "doc_id",
        F.when(~F.col("snull"), F.col("skey")).alias("source"),
        "size",
        F.col("cut_source_size").alias("source_size"),
        F.col("cut_target").alias("target"),
        F.col("cut_epochs").cast("int").alias("epochs"),
        F.col("of_cut").alias("cut_words"),
        (F.col("cut_epochs") * F.col("size") + F.col("of_cut")).alias("taken"),
    )


def apply_mix(docs: DataFrame, max_epochs: int = 3, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; all columns stay.

    The document on a source's cut stays whole if the mix takes at least half of it. Rows are decided where they lie. Only where
    several are alike on the cut (a repeated doc_id of one size) and some of them go, those rows are written and numbered.
    """
    cut = cuts(narrow(docs, buckets), max_epochs)
    size = F.col("last.size")
    more = F.floor(F.col("words") / size) + F.when((F.col("words") % size > 0) & (F.col("words") % size * 2 >= size), 1).otherwise(0)
    cut = settle(cut.withColumn("more", more))
    source, doc_id, text = (F.col(f"row.{c}") for c in ("source", "doc_id", "text"))
    keyed = docs.select(whole(docs).alias("row")).select("row", F.coalesce(source, F.lit("")).alias("skey"), source.isNull().alias("snull"), key_of(doc_id).alias("key"))
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    has_words = F.coalesce(text.rlike(WORD), F.lit(False))
    met = with_cut(keyed, cut).withColumn("place", place(doc_id, words))
    extra = F.when((F.col("place") < 0) & has_words, 1).when((F.col("place") == 0) & (F.col("cut_more") > 0), 1).otherwise(0)
    found = met.withColumn("copies", F.col("cut_epochs").cast("int") + extra)
    if not cut.filter("more > 0 and more < alike").isEmpty():
        split = (F.col("place") == 0) & (F.col("cut_more") > 0) & (F.col("cut_more") < F.col("cut_alike"))
        some = numbered(settle(met.filter(split).withColumn("id", F.monotonically_increasing_id())).select("skey", "snull", "id", "row", "cut_epochs", "cut_more"))
        nth = F.when(F.col("nth") < F.col("cut_more"), 1).otherwise(0)
        found = found.filter(~split).select("row", "copies").unionByName(some.select("row", (F.col("cut_epochs").cast("int") + nth).alias("copies")))
    taken = found.filter("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row"))
    return unwrapped(taken, docs.columns)
