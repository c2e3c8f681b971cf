"""Shared scratch space: every intermediate goes to the folder named by ``spark.checkpoint.dir``.

Executors may be lost at any time, so an intermediate is either an ordinary Spark checkpoint or a
Parquet table in that folder; both can be read again by any executor.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from framewright.session import scratch, ship


def scratch_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder of our own only in local mode where none is set (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None or spark.conf.get("spark.checkpoint.dir", None):
        folder = scratch(spark)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder
    return sc.getCheckpointDir().rstrip("/")


def writers(spark: SparkSession) -> int:
    """Tasks that write a narrow table: one per core, and more where a table has very many partitions.

    Narrow tables of many partitions are small files, each of which costs the file system (a local one starts a process per
    file) far more than its bytes.
    """
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table: its rows and their partitions no longer change."""
    scratch_dir(df.sparkSession)
    return df.coalesce(writers(df.sparkSession)).checkpoint()


def rows_in(settled: DataFrame) -> int:
    """Number of rows of a settled table, counted partition by partition without an exchange."""
    return settled._jdf.queryExecution().toRdd().count()


def compact(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A settled table read as one partition per ``rows`` rows, so that a small one doesn't make a file per partition in each later exchange."""
    settled = settle(df)
    return settled.coalesce(max(1, -(-rows_in(settled) // rows)))


def table(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table of the scratch folder and read it back with the same schema."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of the scratch folder that no later step reads, and let Spark drop the exchanges of steps that ended."""
    for df in tables:
        for name in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Before an operator runs Python: send the modules, and bound the rows of an Arrow batch, as whole texts make wide rows."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
