"""Scans of directory trees: files, frames, OCR maps, model batches, checkpoints and side files.

Files are listed and read by Spark's readers alone, so a tree can lie in any store that Spark reaches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from framewright.functions.frames import VIDEO_EXTENSIONS, media_type
from framewright.operators.assemble import parse_batches
from framewright.sources import versions
from framewright.sources.versions import file_path, unescaped

#: A row of the table of documents.
DOCUMENT = "video_id string, file_name string, value string"

def subdirectories(spark: SparkSession, root: str) -> DataFrame:
    """(rel_path) of the direct sub-directories, empty ones too: the file system is asked, no file is opened.

    Of a table of documents that ``sinks.write_documents`` made, the videos.
    """
    plain = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = versions.folders(spark, root)
    names = {plain(n.removeprefix("video_id=")) if n.startswith("video_id=") else n for n in found if not n.startswith((versions.FOLDER, "_writing-"))}
    listed = spark.createDataFrame([(n,) for n in sorted(names)], "rel_path string")
    if not any(n.startswith(versions.FOLDER) for n in found):
        return listed
    tabled = spark.read.schema(DOCUMENT).option("recursiveFileLookup", True).orc(f"{root}/{versions.FOLDER}*").select(F.col("video_id").alias("rel_path"))
    return tabled.unionByName(listed).distinct()


def video_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1)


def name_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\z", 1)


def files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(video_id, path, name, size) of the files one level down; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{root}/*")
    return found.select(video_of(F.col("path")).alias("video_id"), "path", name_of(F.col("path")).alias("name"), F.col("length").alias("size"))


def contents(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(video_id, frame_name, content) of the files one level down."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{root}/*")
    return found.select(video_of(F.col("path")).alias("video_id"), name_of(F.col("path")).alias("frame_name"), "content")


def written_frames(spark: SparkSession, root: str) -> DataFrame:
    """(video_id, frame_name, content) of the table that ``sinks.write_frames`` makes; one with a folder per video is read too."""
    read = spark.read.schema("frame_name string, content binary, video_id string").option("recursiveFileLookup", True).parquet(root)
    foldered = any(n.startswith("video_id=") for n in versions.folders(spark, root))
    if not foldered and not versions.several(read):
        return read.select("video_id", "frame_name", "content")
    found = versions.placed(read)
    in_folder = F.regexp_extract("path", r"\A(.*)/video_id=([^/]+)/[^/]*\z", 2)
    video = F.coalesce("video_id", unescaped(in_folder))
    place = F.when(F.col("place") == "", F.regexp_extract("path", r"\A(.*)/video_id=([^/]+)/[^/]*\z", 1)).otherwise(F.col("place"))
    return versions.newest(found.withColumns({"video_id": video, "place": place}), "video_id").select("video_id", "frame_name", "content")


def extension_rank(name: Column) -> Column:
    """Place of a video's extension in the order of preference; null for other files. Case matters."""
    out = F.lit(None).cast("int")
    for k, ext in enumerate(VIDEO_EXTENSIONS):
        out = F.when(name.endswith(ext), F.lit(k)).otherwise(out)
    return out


def pick_video(listed: DataFrame, key: str = "video_id", name: str = "name") -> DataFrame:
    """One video file per directory: the best extension, then the first name; ``n_candidates`` of that extension."""
    rank = extension_rank(F.col(name))
    ranked = listed.select(key, name, rank.alias("rank")).filter("rank is not null")
    best = ranked.groupBy(key, "rank").agg(F.min(name).alias("video_file"), F.count(F.lit(1)).alias("n_candidates"))
    return best.groupBy(key).agg(F.min_by("video_file", "rank").alias("video_file"), F.min_by("n_candidates", "rank").alias("n_candidates"))


def pick_metadata(listed: DataFrame, key: str = "video_id", name: str = "name") -> DataFrame:
    return listed.filter(F.col(name).endswith(".info.json")).groupBy(key).agg(F.min(name).alias("metadata_file"))


def list_subtitles(listed: DataFrame, key: str = "video_id", name: str = "name") -> DataFrame:
    """All subtitle files of every directory, sorted; an empty list where there is none."""
    subtitle = F.col(name).endswith(".srt") | F.col(name).endswith(".vtt")
    return listed.groupBy(key).agg(F.sort_array(F.collect_list(F.when(subtitle, F.col(name)))).alias("subtitle_files"))


def frame_files(spark: SparkSession, root: str) -> DataFrame:
    """(video_id, frame_name, frame_path, mime) of all files one level down."""
    found = files(spark, root)
    return found.select("video_id", F.col("name").alias("frame_name"), F.col("path").alias("frame_path"), media_type(F.col("name")).alias("mime"))


def _documents(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(video_id, file_name, value, path) of the documents below ``root``: files of which ``glob`` matches the name, and tables."""

    def read(names: str) -> DataFrameReader:
        return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names)

    columns = ["video_id", "file_name", "value", "path", "place", "version"]
    rows = read("part-*.orc").schema(DOCUMENT).orc(root)
    repeated = versions.several(rows)
    tables = {f.rsplit("/", 2)[0] for f in rows.inputFiles()}
    repeated = repeated or any(n.startswith("video_id=") for t in tables for n in versions.folders(spark, t))
    tabled = versions.placed(rows).withColumn("path", F.concat_ws("/", "place", "video_id", "file_name")).select(columns)
    # as files, or with a folder per document, as earlier versions of this package wrote them
    folder = r"\A(.*)/video_id=([^/]+)/file_name=([^/]+)/part-[^/]*\z"
    path = read(f"{{{glob},part-*.txt}}").text(root, wholetext=True).select(file_path().alias("path"), "value").filter(~F.col("path").contains(f"/{versions.FOLDER}"))
    foldered = F.col("path").rlike(folder)
    part = lambda k: F.regexp_extract("path", folder, k)
    filed = path.select(
        F.when(foldered, unescaped(part(2))).otherwise(video_of(F.col("path"))).alias("video_id"),
        F.when(foldered, unescaped(part(3))).otherwise(name_of(F.col("path"))).alias("file_name"),
        F.when(foldered, F.regexp_replace("value", r"\n\z", "")).otherwise(F.col("value")).alias("value"),
        "path",
        F.when(foldered, part(1)).otherwise(F.col("path")).alias("place"),
        F.lit("").alias("version"),
    )
    found = tabled.unionByName(filed)
    return versions.newest(found, "video_id", "file_name") if repeated else found


def documents(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(video_id, file_name, value) of the whole documents below ``root`` whose name matches ``glob``.

    Both a tree with a file per document and the table that ``sinks.write_documents`` makes are read.
    """
    named = F.col("file_name").rlike(r"\A" + glob.replace(".", r"\.").replace("*", ".*") + r"\z")
    return _documents(spark, root, glob).filter(named).select("video_id", "file_name", "value")


def ocr_texts(spark: SparkSession, root: str, file_name: str = "tesseract_ocr.json") -> DataFrame:
    """(video_id, frame_name, raw_text) of every video's OCR file; a file that is no JSON object leaves no row."""
    named = documents(spark, root, file_name).select("video_id", F.from_json("value", "map<string,string>").alias("texts"))
    return named.filter("texts is not null").select("video_id", F.explode("texts").alias("frame_name", "raw_text"))


def frame_texts(spark: SparkSession, root: str) -> DataFrame:
    """(video_id, frame_name, raw_text) of one ``.txt`` file per frame; the frame is named like the file, as a png."""
    whole = spark.read.option("pathGlobFilter", "*.txt").text(f"{root}/*", wholetext=True)
    name = F.regexp_replace(name_of(file_path()), r"\.txt\z", ".png")
    return whole.select(video_of(file_path()).alias("video_id"), name.alias("frame_name"), F.col("value").alias("raw_text"))


def batch_files(spark: SparkSession, root: str) -> DataFrame:
    """The image-model batches under ``root``, parsed."""
    found = documents(spark, root, "llm_output_batch_*.json")
    return parse_batches(found.withColumnRenamed("file_name", "batch_file"))


def text_batches(spark: SparkSession, root: str) -> DataFrame:
    """The text-model batches under ``root`` in the form of image-model batches, so that they can be assembled."""
    schema = (
        "task1_raw_ocr_text array<string>, llm_output struct<task3_cleaned_text array<string>, task4_markdown_text array<string>, task5_summary string>"
    )
    found = documents(spark, root, "batch_*.json")
    doc = found.select("video_id", F.col("file_name").alias("batch_file"), F.from_json("value", schema).alias("d"))
    return doc.select(
        "video_id",
        "batch_file",
        F.col("d.task1_raw_ocr_text").alias("task1_raw_ocr"),
        F.col("d.task1_raw_ocr_text").alias("task2_augmented"),
        F.lit(None).cast("array<string>").alias("task2_augmented_imperfections"),
        F.col("d.llm_output.task3_cleaned_text").alias("task3_cleaned"),
        F.col("d.llm_output.task4_markdown_text").alias("task4_markdown"),
        F.col("d.llm_output.task5_summary").alias("task5_summary"),
        F.col("d.llm_output.task5_summary").isNotNull().alias("has_summary"),
    )


def json_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, value) of every ``*.json`` below ``root``, at any depth; one in a table is at FOLDER/VIDEO/NAME."""
    return _documents(spark, root, "*.json").filter(F.col("file_name").endswith(".json")).select("path", "value")


def prompt(spark: SparkSession, path: str) -> str:
    """A prompt file's text; a missing file is an error."""
    return spark.read.text(path, wholetext=True).first()[0]


def aux_files(spark: SparkSession, root: str) -> DataFrame:
    """(video_id, path) of the metadata and subtitle files; their contents are not read."""
    return files(spark, root, "*.{json,srt,vtt}").select("video_id", "path")
