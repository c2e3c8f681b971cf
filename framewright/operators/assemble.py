"""Assembly: frames, model batches, OCR texts and side files become samples.

Batches are validated, those that pass are concatenated in file order, and the k-th frame of a video (by name)
meets the k-th concatenated row. References are resolved over the surviving rows of a video. Everything is dealt by
video_id, so the joins and windows share one partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions.augment import profile_choice
from framewright.functions.frames import is_image
from framewright.functions.refs import resolve_list
from framewright.functions.text import clean_ocr

LISTS = ("task1_raw_ocr", "task2_augmented", "task2_augmented_imperfections", "task3_cleaned", "task4_markdown")
BATCH_SCHEMA = ", ".join(f"{c} array<string>" for c in LISTS) + ", task5_summary string"
#: The extensions tried when a frame's text is looked up by its stem.
LOOKUP_EXTENSIONS = (".png", ".jpg", ".jpeg")


def image_frames(files: DataFrame) -> DataFrame:
    """Frames of all image extensions, numbered by name: adds pos, frame_stem."""
    order = Window.partitionBy("video_id").orderBy("frame_name")
    kept = files.filter(is_image(F.col("frame_name")))
    return kept.withColumns({"pos": F.row_number().over(order) - 1, "frame_stem": F.regexp_replace("frame_name", r"\.[^.]*\z", "")})


def png_else_jpg(files: DataFrame) -> DataFrame:
    """``frame_*.png`` of each video, or its ``frame_*.jpg`` if it has no png, numbered by name."""
    png, jpg = F.col("frame_name").rlike(r"\Aframe_.*\.png\z"), F.col("frame_name").rlike(r"\Aframe_.*\.jpg\z")
    video = Window.partitionBy("video_id")
    marked = files.filter(png | jpg).withColumn("__png", png).withColumn("__any", F.max("__png").over(video))
    order = video.orderBy("frame_name")
    return marked.filter(F.col("__png") | ~F.col("__any")).withColumn("pos", F.row_number().over(order) - 1).drop("__png", "__any")


def task2(primary: Column, other: Column) -> Column:
    """The primary list if it is not empty, else the other."""
    return F.when(F.size(primary) > 0, primary).otherwise(F.coalesce(other, primary))


def task2_text(primary: Column, other: Column) -> Column:
    """The primary text if not empty, else the other's, else what there is."""
    return F.coalesce(F.nullif(primary, F.lit("")), F.nullif(other, F.lit("")), primary, other, F.lit(""))


def is_valid(has_summary: Column | None = None) -> Column:
    """All lists of a batch as long as its first, which is not empty, and a summary there."""
    n = F.size("task1_raw_ocr")
    second = task2(F.col("task2_augmented"), F.col("task2_augmented_imperfections"))
    summary = has_summary if has_summary is not None else F.col("task5_summary").isNotNull()
    checks = (n > 0) & summary & (F.size(second) == n) & (F.size("task3_cleaned") == n) & (F.size("task4_markdown") == n)
    return F.coalesce(checks, F.lit(False))


def parse_batches(files: DataFrame) -> DataFrame:
    """(video_id, batch_file, value: JSON text) -> the lists of the batch; a list of another type or no JSON is null.

    A summary that is null but present is allowed, so the presence of its key is read from the document itself.
    """
    doc = F.from_json("value", BATCH_SCHEMA)
    return files.withColumn("doc", doc).select(
        "video_id", "batch_file", "doc.*", F.coalesce(F.array_contains(F.json_object_keys("value"), "task5_summary"), F.lit(False)).alias("has_summary")
    )


def batch_rows(batches: DataFrame, align: str = "position", size: int = 60) -> DataFrame:
    """Valid batches as rows: video_id, pos, the task texts, summary.

    ``pos`` counts over the valid batches of the video in file order, so frames after a batch that is left out move up; with
    ``align="batch_offset"`` it starts at the batch's number times ``size`` instead, and they stay where they are.
    """
    n = F.size("task1_raw_ocr")
    before = Window.partitionBy("video_id").orderBy("batch_file").rowsBetween(Window.unboundedPreceding, -1)
    valid = batches.filter(is_valid(F.col("has_summary") if "has_summary" in batches.columns else None))
    if align == "batch_offset":
        number = F.regexp_extract("batch_file", r"(\d+)\.json\z", 1).try_cast("int")
        placed = valid.withColumn("offset", number * size).filter("offset is not null")
    elif align == "position":
        placed = valid.withColumn("offset", F.coalesce(F.sum(n).over(before), F.lit(0)))
    else:
        raise ValueError(f"unknown alignment: {align}")
    second = task2(F.col("task2_augmented"), F.col("task2_augmented_imperfections"))
    zipped = F.arrays_zip(F.col("task1_raw_ocr").alias("t1"), second.alias("t2"), F.col("task3_cleaned").alias("t3"), F.col("task4_markdown").alias("t4"))
    return placed.select("video_id", "batch_file", "offset", "task5_summary", F.posexplode(zipped).alias("k", "z")).select(
        "video_id", "batch_file", (F.col("offset") + F.col("k")).cast("int").alias("pos"), "z.t1", "z.t2", "z.t3", "z.t4", F.col("task5_summary").alias("t5")
    )


def ocr_lookup(texts: Column, name: Column, stem: Column) -> Column:
    """A frame's text in the video's map: by its name, else by its stem with each extension; the first that is not null."""
    keys = [name, *[F.concat(stem, F.lit(e)) for e in LOOKUP_EXTENSIONS]]
    return F.coalesce(*[F.try_element_at(texts, k) for k in keys])


def ocr_read(texts: Column, stem: Column) -> Column:
    """The text a sample shows: by stem with each extension, the first that is not empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(texts, F.concat(stem, F.lit(e))), F.lit("")) for e in LOOKUP_EXTENSIONS], F.lit(""))


def ocr_maps(ocr: DataFrame) -> DataFrame:
    """(video_id, frame_name, raw_text) -> one map of frame name to text per video."""
    entries = F.collect_list(F.struct("frame_name", "raw_text"))
    return ocr.filter("raw_text is not null").dropDuplicates(["video_id", "frame_name"]).groupBy("video_id").agg(F.map_from_entries(entries).alias("texts"))


def aux_paths(files: DataFrame) -> DataFrame:
    """(video_id, path) -> the first ``.info.json`` and all subtitles, sorted."""
    path = F.col("path")
    subtitle = path.endswith(".srt") | path.endswith(".vtt")
    return files.groupBy("video_id").agg(
        F.min(F.when(path.endswith(".info.json"), path)).alias("metadata_filepath"),
        F.sort_array(F.collect_list(F.when(subtitle, path))).alias("subtitle_filepaths"),
    )


def rows_in_order(frames: DataFrame, llm: DataFrame, maps: DataFrame) -> DataFrame:
    """Frames that have a model row and an OCR text, renumbered per video: adds idx, t1..t5, texts."""
    matched = frames.join(llm.drop("batch_file"), ["video_id", "pos"]).join(maps, "video_id")
    found = matched.filter(ocr_lookup(F.col("texts"), F.col("frame_name"), F.col("frame_stem")).isNotNull())
    order = Window.partitionBy("video_id").orderBy("pos")
    return found.withColumn("idx", F.row_number().over(order) - 1)


def resolve_rows(rows: DataFrame, columns: Sequence[str], key: str = "video_id", order: str = "idx", decode_append: bool = False) -> DataFrame:
    """References of each column resolved among the rows of a key: one list per key, folded in order."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order), F.struct(*[c for c in rows.columns if c not in (key, order)]).alias("row"))))
    grouped = rows.groupBy(key).agg(items.alias("items"))
    values = lambda c: F.transform("items", lambda x: x["row"][c])
    solved = [resolve_list(values(c), decode_append).alias(f"__{c}") for c in columns]
    listed = grouped.select(key, "items", *solved)
    zipped = F.arrays_zip("items", *[f"__{c}" for c in columns])
    flat = listed.select(key, F.explode(zipped).alias("z"))
    out = [F.col(key), F.col(f"z.items.{order}").alias(order)]
    out += [(F.col(f"z.__{c}") if c in columns else F.col(f"z.items.row.{c}")).alias(c) for c in rows.columns if c not in (key, order)]
    return flat.select(*out)


def samples(frames: DataFrame, batches: DataFrame, ocr: DataFrame, aux: DataFrame | None = None, seed: int = 0, profiles: Sequence[str] | None = None, decode_append: bool = False, ref_scope: str = "video", align: str = "position", batch_size: int = 60) -> DataFrame:
    """The samples of all videos that have frames, valid batches and OCR texts.

    ``ref_scope`` says within what a reference counts rows: the video's surviving rows, or the batch's. ``align``: see ``batch_rows``.
    """
    llm = batch_rows(batches, align, batch_size)
    if ref_scope == "batch":
        keyed = llm.withColumns({"batch_key": F.concat_ws("/", "video_id", "batch_file"), "place": F.col("pos")})
        llm = resolve_rows(keyed, ["t3", "t4"], "batch_key", "place", decode_append).drop("batch_key", "place")
    rows = rows_in_order(image_frames(frames), llm, ocr_maps(ocr))
    shown = rows.withColumn("ocr", clean_ocr(ocr_read(F.col("texts"), F.col("frame_stem")))).drop("texts", "t1", "t2")
    solved = resolve_rows(shown, ["t3", "t4"], "video_id", "idx", decode_append) if ref_scope == "video" else shown
    clean = F.coalesce(F.col("t3"), F.lit(""))
    noisy = profile_choice(clean, F.concat_ws("/", "video_id", "frame_name"), seed, profiles) if profiles is None or profiles else F.lit("")
    out = solved.select(
        F.col("frame_path"),
        "video_id",
        "frame_stem",
        F.col("ocr").alias("tesseract_ocr"),
        clean.alias("llm_clean_ocr"),
        noisy.alias("augmented_llm_clean_ocr"),
        F.coalesce("t4", F.lit("")).alias("markdown"),
        F.coalesce("t5", F.lit("")).alias("summary"),
    )
    if aux is None:
        return out.withColumns({"metadata_filepath": F.lit(None).cast("string"), "subtitle_filepaths": F.array().cast("array<string>")})
    side = aux_paths(aux)
    return out.join(side, "video_id", "left").withColumn("subtitle_filepaths", F.coalesce("subtitle_filepaths", F.array().cast("array<string>")))


EXPORT = ("frame_path", "tesseract_ocr", "llm_clean_ocr", "augmented_llm_clean_ocr", "markdown", "summary")


def export(rows: DataFrame, mode: str = "standard") -> DataFrame:
    """The columns of an export mode; an unknown mode is an error before anything is written."""
    if mode == "standard":
        return rows.select(*EXPORT)
    if mode == "cleaning_pairs":
        return rows.select("frame_path", F.col("tesseract_ocr").alias("raw_ocr"), F.col("llm_clean_ocr").alias("clean_ocr"))
    raise ValueError(f"unknown export mode: {mode}")


def first_present(*columns: Column) -> Column:
    """The first column that is there (not null); empty texts count as there."""
    return F.coalesce(*columns, F.lit(""))


