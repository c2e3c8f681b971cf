"""A polling daemon: every micro-batch is a pass over all directories that the ledger does not list as done.

The stream only says that it is time. What a pass works on is the listing less the ledger, so a directory that
failed is tried again in every pass, and a restart repeats nothing that was recorded.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framewright.operators.ledger import pass_counters, pending, slice_pending, status_class
from framewright.sources.sinks import append_ledger

LEDGER = "stage string, rel_path string, status string, n_items long, cost_usd double, ts timestamp"
Work = Callable[[DataFrame], DataFrame]
"""(rel_path) -> (rel_path, status, n_items, cost_usd)."""


def exists(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def done(spark: SparkSession, ledger: str, stage: str) -> DataFrame:
    """Directories that a stage has finished."""
    if not exists(spark, ledger):
        return spark.createDataFrame([], "rel_path string")
    rows = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("stage") == stage)
    return rows.filter(status_class(F.col("status")) == "success").select("rel_path").distinct()


def run_pass(dirs: DataFrame, ledger: str, stage: str, work: Work, start: int | None = None, end: int | None = None, clamp: bool = True, dry_run: bool = False) -> DataFrame:
    """One pass: work on what is pending and record every outcome. A dry run returns the plan and records nothing."""
    spark = dirs.sparkSession
    todo = slice_pending(pending(dirs, done(spark, ledger, stage)), "rel_path", start, end, clamp)
    if dry_run:
        return todo.select("rel_path", F.lit("Success (dry run)").alias("status"), F.lit(0).cast("long").alias("n_items"), F.lit(0.0).alias("cost_usd"))
    outcome = work(todo).select(F.lit(stage).alias("stage"), "rel_path", "status", F.col("n_items").cast("long"), F.col("cost_usd").cast("double"), F.current_timestamp().alias("ts"))
    append_ledger(outcome, ledger)
    return spark.read.schema(LEDGER).parquet(ledger).filter(F.col("stage") == stage)


def ticks(spark: SparkSession) -> DataFrame:
    """A stream that has something new at every trigger, so that passes are made whether or not files arrived."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def watch(
    arrivals: DataFrame,
    listing: Callable[[], DataFrame],
    ledger: str,
    checkpoint: str,
    stage: str,
    work: Work,
    interval: str | None = None,
    start: int | None = None,
    end: int | None = None,
    clamp: bool = True,
    dry_run: bool = False,
) -> StreamingQuery:
    """Start the daemon: a pass per micro-batch, every ``interval`` or, without one, once for all there is.

    With a stream of ``ticks`` a pass is made at every interval; with one of file arrivals only when something came. Only the first pass of this
    call honours ``start`` and ``end``, also after a restart with a kept checkpoint. A dry run records nothing.
    """
    passes = iter([(start, end, clamp)])

    def one(batch: DataFrame, batch_id: int) -> None:
        first, last, cut = next(passes, (None, None, True))
        planned = run_pass(listing(), ledger, stage, work, first, last, cut, dry_run)
        if dry_run:
            planned.show(truncate=False)

    writer = arrivals.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one)
    return writer.trigger(processingTime=interval).start() if interval else writer.trigger(availableNow=True).start()


def summary(spark: SparkSession, ledger: str, stage: str, since: datetime) -> DataFrame:
    """Counters over all that a stage has recorded since a time: attempted, successful, no_frames, failed, frames, cost_usd."""
    rows = spark.read.schema(LEDGER).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], LEDGER)
    own = rows.filter((F.col("stage") == stage) & (F.col("ts") >= F.lit(since)))
    return pass_counters(own).crossJoin(own.agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("cost_usd")))  # one row each


def stop(query: StreamingQuery) -> None:
    """Stop the daemon between two passes: one that runs may end first."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(0.05)
    query.stop()


def until_stopped(query: StreamingQuery, spark: SparkSession, ledger: str, stage: str, since: datetime) -> DataFrame:
    """Wait for the daemon; on an interrupt stop it after the pass that runs. Either way the summary is shown and returned."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        stop(query)
    told = summary(spark, ledger, stage, since)
    told.show(truncate=False)
    return told
