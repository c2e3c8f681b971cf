"""Sessions with the settings that the operators expect."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "framewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; engine calls must not run twice, so speculation stays off."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.speculation": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per application, so that Python workers can import them anywhere."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="framewright-")) / "framewright.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"{root.name}/{path.relative_to(root)}")
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share: that of ``spark.checkpoint.dir``, or in local mode, where none is set, one of our own."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="framewright-")
        atexit.register(shutil.rmtree, _own[sc.applicationId], ignore_errors=True)
    return _own[sc.applicationId]


def pinned(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read from there, so that engines behind it are called once whatever is derived from it."""
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows go to Python at a time while a job with wide rows runs."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bound_arrow(spark: SparkSession, rows: int) -> None:
    """From now on at most ``rows`` rows go to Python at a time, for plans that run later; a lower bound stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work that costs far more than a shuffle of its input.

    Only a table that was read as fewer partitions than that (a few small files) is dealt out; a large one stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
