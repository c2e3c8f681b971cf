"""Sharding by fixed virtual slots.

A document hashes by its doc_id into one of ``SLOTS`` virtual slots, for good. Bytes are summed per slot, and
a versioned map says which shard holds each slot: the heaviest slots go first, each to the lightest shard.
A ``MapStore`` keeps the versions in a folder. With one, documents stay where its latest version has them, whatever came since;
growing edits the map: the next version moves slots to the new shard only until that holds its share. Without one the map is made for the table at hand.
Only the map (one row per slot, a fixed number) is ever joined to the documents, by broadcast.

Rows that share a doc_id (or have none) hash by doc_id and their number among those, so that no id fills a slot; the first keeps the slot
of its doc_id. Numbers are counted in parts of rows, not in one task. Equal texts are no unit: a group of copies of any size spreads over the shards.

``slot`` numbers the rows of a shard from 0 without gaps: virtual slots of a shard lie one after the other,
and a row's place inside its virtual slot is added to the rows of the slots before it. No task holds a shard.

Nulls: a null text has size 1 (0 bytes plus 1) and the crc32 of no bytes, 0; a null doc_id hashes like any value.
Rows that repeat stay separate rows. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.store import compact, settle, table

SLOTS = 8192
"""Virtual slots; fixed for the life of a corpus, far more than the shards."""


PARTS = 1024


def virtual_slot(doc_id: Column, nth: Column, slots: int = SLOTS) -> Column:
    """The slot of the ``nth`` row (from 0) of a doc_id."""
    own = F.xxhash64(doc_id, F.lit("slot"))
    return F.pmod(F.when(nth == 0, own).otherwise(F.xxhash64(own, nth)), F.lit(slots)).cast("int")


def measure(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The narrow, settled table of all rows: doc_id, size, text_crc32, vslot. The only pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    rows = settle(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    repeated = compact(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("id")))
    if repeated.isEmpty():
        return rows.withColumn("vslot", virtual_slot(F.col("doc_id"), F.lit(0), slots)).drop("row")
    again = rows.join(repeated, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").withColumn("part", F.pmod("row", F.lit(PARTS)))
    of_part = ["doc_id", "part"]
    before = Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most PARTS rows of an id
    counts = again.groupBy(*of_part).agg(F.count(F.lit(1)).alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*of_part).orderBy("row")) - 1
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.part") == F.col("b.part"))
    numbered = again.withColumn("inside", inside).alias("a").join(counts.alias("b"), same).select(F.col("a.row").alias("of"), (F.col("inside") + F.col("ahead")).alias("nth"))
    nth = F.coalesce("nth", F.lit(0))
    return rows.join(numbered, F.col("row") == F.col("of"), "left").withColumn("vslot", virtual_slot(F.col("doc_id"), nth, slots)).drop("row", "of", "nth")


def slot_weights(rows: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot; at most one row per slot."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def new_map(weights: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """Version 1 of the map: vslot, bytes, n, shard, version. Heaviest slot first, to the lightest shard."""
    spark_row = f"""
      aggregate(
        array_sort(collect_list(struct(-bytes AS k, vslot, n))),
        struct(transform(sequence(0, {shards} - 1), i -> struct(0L AS held, i AS shard)) AS loads, array_repeat(0, 0) AS picks),
        (a, s) -> named_struct(
          'loads', transform(a.loads, x -> IF(x.shard = array_min(a.loads).shard, struct(x.held - s.k AS held, x.shard AS shard), x)),
          'picks', concat(a.picks, array(array_min(a.loads).shard))),
        a -> a.picks)"""
    folded = weights.agg(
        F.expr("array_sort(collect_list(struct(-bytes AS k, vslot, n)))").alias("slots"), F.expr(spark_row).alias("picks")
    )
    return folded.select(F.explode(F.arrays_zip("slots", "picks")).alias("z")).select(
        F.col("z.slots.vslot").alias("vslot"),
        (-F.col("z.slots.k")).alias("bytes"),
        F.col("z.slots.n").alias("n"),
        F.col("z.picks").cast("int").alias("shard"),
        F.lit(version).alias("version"),
    )


def grow_map(current: DataFrame, shards: int, version: int) -> DataFrame:
    """The next version of the map for one shard more: every old shard gives slots until the new one has its share.

    Each shard gives its slots in the order of their hash until it has given 1/(shards + 1) of its bytes; no slot
    moves between old shards.
    """
    order = Window.partitionBy("shard").orderBy(F.xxhash64("vslot", F.lit("grow")), "vslot")
    given = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("bytes").over(Window.partitionBy("shard"))
    moved = given * (shards + 1) <= total
    return current.withColumn("moved", moved).select(
        "vslot", "bytes", "n", F.when(F.col("moved"), F.lit(shards)).otherwise(F.col("shard")).alias("shard"), F.lit(version).alias("version")
    )


MAP = "vslot int, bytes long, n long, shard int, version int"


class MapStore:
    """Versions of a map in a folder that all executors share, each a table of its own that is never changed."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(conf)
        found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(p.getName().split("=")[1]) for p in found if p.getName().startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def load(self, version: int | None = None) -> DataFrame | None:
        """A version, the latest unless named; None if there is none."""
        known = self.versions()
        if not known or version is not None and version not in known:
            return None
        return self.spark.read.schema(MAP).parquet(f"{self.path}/version={version or known[-1]}")

    def save(self, slot_map: DataFrame) -> DataFrame:
        """Store a map as the version that its rows say. A version that is there is never overwritten."""
        version = slot_map.agg(F.max("version")).first()[0]
        slot_map.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in MAP.split(", ")]).coalesce(1).write.parquet(f"{self.path}/version={version}")
        return self.load(version)

    def grow(self, shards: int) -> DataFrame:
        """One shard more than the ``shards`` there are: the next version, stored."""
        now = self.load()
        return self.save(grow_map(now, shards, now.agg(F.max("version")).first()[0] + 1))


def every_slot(weights: DataFrame, slots: int) -> DataFrame:
    """``weights`` with the slots that hold nothing yet, so that rows that come later have a shard."""
    return weights.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot")).join(weights, "vslot", "left").fillna(0)


def shard(docs: DataFrame, shards: int = 16, slots: int = SLOTS, store: MapStore | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    With a ``store`` its latest version places the documents; version 1 is made of these documents if there is none.
    """
    rows = measure(docs, slots)
    weights = compact(slot_weights(rows))
    slot_map = store.load() if store else None
    if slot_map is None:
        slot_map = new_map(every_slot(weights, slots), shards)
        slot_map = store.save(slot_map) if store else table(slot_map.coalesce(1), "slot-map")
    now = slot_map.select("vslot", "shard", "version").join(weights, "vslot")  # rows as they are today
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    places = now.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).select("vslot", "shard", "version", "ahead")
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(places), "vslot")  # at most `slots` rows of 28 bytes
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("ahead") + F.col("place")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            F.col("vslot").alias("virtual_slot"),
            F.col("version").alias("map_version"),
        )
    )
