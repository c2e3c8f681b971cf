"""Tables of many small items that are replaced by key: every write adds a folder of a few files, the newest write of a key counts.

A folder or a file per item would cost a rename on the driver and an open file each; here both grow with the number of tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "written="


def unescaped(text: Column) -> Column:
    """Characters written as ``%XX`` put back; a plus sign is one."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def file_path() -> Column:
    """The path of the file that a row was read from, its characters as they are on disk."""
    return unescaped(F.col("_metadata.file_path"))


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in ``root``; none if it isn't there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []


def add(rows: DataFrame, root: str, kind: str) -> None:
    """Write ``rows`` as a new version. It is named when it is complete, so that readers see all of it or nothing."""
    spark = rows.sparkSession
    aside = f"{root}/_writing-{uuid.uuid4().hex}"
    rows.write.format(kind).save(aside)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    last = max((int(n.removeprefix(FOLDER).split("-")[0]) for n in folders(spark, root) if n.startswith(FOLDER)), default=0)
    to = path(f"{root}/{FOLDER}{last + 1:09d}-{uuid.uuid4().hex[:8]}")
    if not path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(path(aside), to):
        raise OSError(f"can't rename {aside} to {to}")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` just read, with ``path``, and of versions ``place``, the table's folder, and ``version``; '' where there is none."""
    found = rows.select("*", file_path().alias("path"))
    part = lambda k: F.regexp_extract("path", rf"\A(.*)/({FOLDER}[^/]+)/[^/]*\z", k)
    return found.select("*", part(1).alias("place"), part(2).alias("version"))


def several(rows: DataFrame) -> bool:
    """Whether a table below what ``rows`` reads was written more than once, by the names of its files."""
    versions = {f.rsplit("/", 1)[0] for f in rows.inputFiles()}
    return len(versions) > len({v.rsplit("/", 1)[0] for v in versions})


def newest(rows: DataFrame, *keys: str) -> DataFrame:
    """Of the rows of one place and key those of the newest version; the keys alone are read first to find it."""
    last = rows.groupBy("place", *keys).agg(F.max("version").alias("version"))
    return rows.join(last, ["place", *keys, "version"], "left_semi")
