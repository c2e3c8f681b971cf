"""What is done, what is stale, what is next; counters and totals of a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The statuses' beginnings.
SUCCESS, NO_FRAMES = "Success", "No frame_*.png"
LONGEST_ENTRY = 1024


def parse_checkpoint(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Distinct entries (rel_path). ``strict`` drops lines that hold a written-out line end or a return, or are too long."""
    entry = F.regexp_replace(F.col(column), r"(?U)\A[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+\z", "").alias("rel_path")
    found = lines.select(entry).filter("rel_path <> ''")
    if strict:
        bad = F.col("rel_path").contains("\\n") | F.col("rel_path").contains("\r") | (F.char_length("rel_path") > LONGEST_ENTRY)
        found = found.filter(~bad)
    return found.distinct()


def malformed_entries(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many non-blank lines the strict reading drops."""
    text = F.regexp_replace(F.col(column), r"(?U)\A[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+\z", "")
    bad = text.contains("\\n") | text.contains("\r") | (F.char_length(text) > LONGEST_ENTRY)
    return lines.agg(F.count_if((text != "") & bad).alias("n_malformed"))


def pending(dirs: DataFrame, done: DataFrame, key: str = "rel_path") -> DataFrame:
    return dirs.join(done.select(key), key, "left_anti")


def skipped(dirs: DataFrame, done: DataFrame, key: str = "rel_path") -> DataFrame:
    return dirs.join(done.select(key).distinct(), key, "left_semi")


def stale(done: DataFrame, dirs: DataFrame, key: str = "rel_path") -> DataFrame:
    """Entries without a directory."""
    return done.join(dirs.select(key), key, "left_anti")


def listing(rows: DataFrame, key: str, shown: int = 10) -> DataFrame:
    """The first ``shown`` keys in order, each with how many more there are: a report, not an input of other steps."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return rows.select(key).orderBy(key).limit(shown).crossJoin(F.broadcast(total)).select(key, F.greatest(F.col("total") - shown, F.lit(0)).alias("n_more"))


def slice_pending(rows: DataFrame, key: str, start: int | None = None, end: int | None = None, clamp: bool = True) -> DataFrame:
    """Rows ``start`` to ``end`` (excluded) in the order of ``key``.

    Out of range, ``clamp`` cuts the range to the rows there are; otherwise nothing is taken.
    """
    if start is None and end is None:
        return rows.orderBy(key)
    first = start or 0
    if not clamp:
        total = rows.count()
        last = total if end is None else end
        if first < 0 or first >= total or last <= first or last > total:
            return rows.limit(0)
    first = max(0, first)
    out = rows.orderBy(key).offset(first)
    return out if end is None else out.limit(max(0, end - first))


def requested(videos: DataFrame, wanted: list[str] | None, key: str = "video_id") -> DataFrame:
    """The wanted ids that exist, in the order asked for and as often; all videos if none is asked for or none exists."""
    if not wanted:
        return videos.select(key)
    spark = videos.sparkSession
    asked = spark.createDataFrame([(k, v) for k, v in enumerate(wanted)], f"pos int, {key} string")
    found = asked.join(videos.select(key).distinct(), key).orderBy("pos").select(key)
    return found if not found.isEmpty() else videos.select(key)


def omitted(videos: DataFrame, wanted: DataFrame, key: str = "video_id") -> DataFrame:
    """Wanted ids that do not exist."""
    return wanted.select(key).subtract(videos.select(key))


def status_class(status):
    return F.when(status.startswith(SUCCESS), "success").when(status.startswith(NO_FRAMES), "no_frames").otherwise("failed")


def pass_counters(ledger: DataFrame, status: str = "status", items: str = "n_items") -> DataFrame:
    """Attempted, successful, failed and empty directories and the frames of the successful ones."""
    kind = status_class(F.col(status))
    return ledger.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(kind == "success").alias("successful"),
        F.count_if(kind == "no_frames").alias("no_frames"),
        F.count_if(kind == "failed").alias("failed"),
        F.coalesce(F.sum(F.when(kind == "success", F.col(items))), F.lit(0)).alias("frames"),
    )


def directory_totals(batches: DataFrame, key: str = "video_id", ok: str = "ok", cost: str = "cost_usd", frames: str = "num_frames") -> DataFrame:
    """Per directory: batches in all and successful, frames and cost of the successful, and whether all were."""
    good = F.col(ok)
    return batches.groupBy(key).agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(good).alias("batches_ok"),
        F.coalesce(F.sum(F.when(good, F.col(frames))), F.lit(0)).alias("frames_ok"),
        F.coalesce(F.sum(F.when(good, F.col(cost))), F.lit(0.0)).alias("cost_ok"),
        F.bool_and(good).alias("success"),
    )


def overall_totals(passes: DataFrame) -> DataFrame:
    """Sums of the counters of several passes."""
    return passes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in passes.columns])
