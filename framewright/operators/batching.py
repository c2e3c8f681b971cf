"""Fixed-size batches of a video's frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions.text import strip

BATCH_SIZE = 60


def with_batches(frames: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """``batch``: 0-based number of the frame's batch; batches are runs of ``size`` frames in frame order."""
    order = Window.partitionBy("video_id").orderBy("frame_idx", "frame_name")
    return frames.withColumn("batch", F.floor((F.row_number().over(order) - 1) / size).cast("int"))


def batch_text(items: Column) -> Column:
    """Frames (array of struct<frame_idx, raw_text>, sorted) as one text for a model."""
    blocks = F.transform(items, lambda f: F.concat(F.lit("--- Frame "), f["frame_idx"].cast("string"), F.lit(" ---\n"), F.coalesce(f["raw_text"], F.lit(""))))
    return strip(F.array_join(blocks, "\n\n"))


def batch_file(first: Column, last: Column) -> Column:
    return F.format_string("batch_%06d_%06d.json", first.cast("int"), last.cast("int"))


def image_batch_file(batch: Column) -> Column:
    return F.format_string("llm_output_batch_%04d.json", batch.cast("int"))


def image_batches(frames: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """One row per batch of image files (video_id, frame_idx, frame_name): their names in order and the file name; contents are not touched."""
    items = F.array_sort(F.collect_list(F.struct("frame_idx", "frame_name")))
    grouped = with_batches(frames, size).groupBy("video_id", "batch").agg(items.alias("items"))
    return grouped.select("video_id", "batch", F.size("items").alias("num_frames"), F.transform("items", lambda f: f["frame_name"]).alias("frame_names"), image_batch_file(F.col("batch")).alias("file_name"))


def batches(frames: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """One row per batch: its frames in order, their numbers, their texts, the joined text and the file name."""
    items = F.array_sort(F.collect_list(F.struct("frame_idx", "frame_name", "raw_text")))
    grouped = with_batches(frames, size).groupBy("video_id", "batch").agg(items.alias("items"))
    first, last = F.col("items")[0]["frame_idx"], F.element_at("items", -1)["frame_idx"]
    return grouped.select(
        "video_id",
        "batch",
        first.alias("start_frame_index"),
        last.alias("end_frame_index"),
        F.size("items").alias("num_frames"),
        F.transform("items", lambda f: f["frame_idx"]).alias("frame_indexes"),
        F.transform("items", lambda f: F.coalesce(f["raw_text"], F.lit(""))).alias("task1_raw_ocr_text"),
        batch_text(F.col("items")).alias("batch_text"),
        batch_file(first, last).alias("file_name"),
    )
