"""How the test tables stand for videos, frames, batches and ledgers; the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.plans.catalogue import table

#: Common table expressions for oracle SQL.
FRAMES_SQL = """
frames AS (SELECT CAST(conv_id AS VARCHAR) AS video_id, turn AS frame_idx, printf('frame_%06d.png', turn) AS frame_name, text AS raw_text, role FROM conversations)"""
NOISY_SQL = """
noisy AS (SELECT doc_id, '  ' || replace(replace(replace(text, ' ', '  '), '. ', chr(9) || '. '), chr(10), chr(13) || chr(10) || ' ' || chr(10)) || chr(13) AS t FROM documents)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as frames: a conversation is a video, a turn a frame."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.col("turn").alias("frame_idx"),
        F.format_string("frame_%06d.png", "turn").alias("frame_name"),
        F.col("text").alias("raw_text"),
        "role",
    )


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with doubled spaces, tabs, returns and blank lines put in."""
    t = F.replace(F.replace(F.replace(F.col("text"), F.lit(" "), F.lit("  ")), F.lit(". "), F.lit("\t. ")), F.lit("\n"), F.lit("\r\n \n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("  "), t, F.lit("\r")).alias("t"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files of directories: ten files each, names by doc_id."""
    kinds = F.array(*map(F.lit, NAMES))
    return table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 10).cast("long").alias("dir_id"),
        "doc_id",
        F.concat(F.lit("f"), (F.col("doc_id") * 7 % 10).cast("string"), F.element_at(kinds, (F.col("doc_id") * 13 % len(NAMES)).cast("int") + 1)).alias("name"),
    )


#: Endings of the files that stand for a directory's content.
NAMES = (".webm", ".info.json", "_en.srt", ".mp4", ".MP4", "_fr.vtt", ".mov", ".txt", ".avi", ".mkv", ".json")
NAMES_SQL = f"""
files AS (SELECT CAST(doc_id // 10 AS BIGINT) AS dir_id, doc_id, 'f' || CAST(doc_id * 7 % 10 AS VARCHAR) || list_extract([{", ".join(f"'{n}'" for n in NAMES)}], CAST(doc_id * 13 % {len(NAMES)} AS INT) + 1) AS name FROM documents)"""


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as image files: some videos have png only, some jpg only, some both, and some odd names."""
    name = (
        F.when(F.col("conv_id") % 5 == 4, F.format_string("FRAME_%d.PNG", "turn"))
        .when((F.col("conv_id") % 3 == 0) & (F.col("turn") % 2 == 0), F.format_string("frame_%06d.png", "turn"))
        .when(F.col("conv_id") % 3 == 2, F.format_string("frame_%06d.jpeg", "turn"))
        .otherwise(F.format_string("frame_%06d.jpg", "turn"))
    )
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("video_id"), name.alias("frame_name"))


IMAGES_SQL = """
images AS (SELECT CAST(conv_id AS VARCHAR) AS video_id,
  CASE WHEN conv_id % 5 = 4 THEN printf('FRAME_%d.PNG', turn)
       WHEN conv_id % 3 = 0 AND turn % 2 = 0 THEN printf('frame_%06d.png', turn)
       WHEN conv_id % 3 = 2 THEN printf('frame_%06d.jpeg', turn)
       ELSE printf('frame_%06d.jpg', turn) END AS frame_name FROM conversations)"""


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as lists of texts with references: two of three turns refer to another one, some to none that is earlier."""
    text = (
        F.when(F.col("turn") % 3 == 0, F.col("text"))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("F:"), (F.col("turn") - 1).cast("string")))
        .otherwise(F.concat(F.lit("F:"), (F.col("turn") - 1 + F.col("conv_id") % 4).cast("string"), F.lit(" +"), F.substring("text", 1, 5)))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("raw"))


REFS_SQL = """
refs AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text
    WHEN turn % 3 = 1 THEN 'F:' || CAST(turn - 1 AS VARCHAR)
    ELSE 'F:' || CAST(turn - 1 + conv_id % 4 AS VARCHAR) || ' +' || substr(text, 1, 5) END AS raw FROM conversations),
parsed AS (SELECT conv_id, turn, raw, try_cast(nullif(regexp_extract(raw, '^F:([0-9]+)', 1), '') AS BIGINT) AS ref, regexp_replace(raw, '^F:[0-9]+', '') AS rest FROM refs)"""
RESOLVE_SQL = """
walk AS (
  SELECT conv_id, turn, raw AS now, '' AS tail, turn AS at FROM parsed
  UNION ALL
  SELECT w.conv_id, w.turn, q.raw, p.rest || w.tail, q.turn
  FROM walk w JOIN parsed p ON p.conv_id = w.conv_id AND p.turn = w.at AND p.ref < p.turn
  JOIN parsed q ON q.conv_id = w.conv_id AND q.turn = p.ref),
resolved AS (SELECT w.conv_id, w.turn, w.now || w.tail AS text FROM walk w JOIN parsed p ON p.conv_id = w.conv_id AND p.turn = w.at AND (p.ref IS NULL OR p.ref >= p.turn))"""


def llm_batches(spark: SparkSession, sf_dir: str, size: int = 3) -> DataFrame:
    """conversations as model batches of three frames; one video in seven per way in which its second batch can be invalid."""
    conv = table(spark, sf_dir, "conversations")
    grouped = conv.groupBy("conv_id", F.floor(F.col("turn") / size).cast("int").alias("b")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("texts"), F.min("turn").alias("start")
    )
    bad = (F.col("b") == 1) & (F.col("conv_id") % 2 == 0)
    broken = lambda k: bad & (F.col("conv_id") % 7 == k)
    refd = F.transform("texts", lambda t, i: F.when((i == 1) & (F.col("b") == 0), F.lit("F:0 again")).otherwise(t))
    short = F.slice(refd, 1, F.size(refd) - 1)
    none = F.array().cast("array<string>")
    return grouped.select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.format_string("llm_output_batch_%04d.json", "b").alias("batch_file"),
        F.when(broken(1), none).otherwise(refd).alias("task1_raw_ocr"),
        F.when(broken(2) | (F.col("conv_id") % 7 == 3), F.lit(None)).otherwise(refd).alias("task2_augmented"),
        F.when(F.col("conv_id") % 7 == 3, refd).alias("task2_augmented_imperfections"),
        F.when(broken(4), short).otherwise(refd).alias("task3_cleaned"),
        F.when(broken(5), F.lit(None)).otherwise(F.transform(refd, lambda t: F.when(t.startswith("F:"), t).otherwise(F.concat(F.lit("# "), t)))).alias("task4_markdown"),
        F.when(broken(6), F.lit(None)).otherwise(F.concat(F.lit("sum "), F.col("conv_id").cast("string"), F.lit("/"), F.col("b").cast("string"))).alias("task5_summary"),
    )


#: The same batches, one row per frame of a valid batch with its place over all valid batches of the video.
BATCH_ROWS_SQL = """
raw AS (SELECT conv_id, turn, turn // 3 AS b, turn % 3 AS k, CASE WHEN turn = 1 THEN 'F:0 again' ELSE text END AS t FROM conversations),
sizes AS (SELECT conv_id, b, count(*) AS n FROM raw GROUP BY ALL),
marked AS (SELECT *, NOT (b = 1 AND conv_id % 2 = 0 AND conv_id % 7 IN (1, 2, 4, 5, 6)) AS valid FROM sizes),
placed AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM marked WHERE valid),
rows_ AS (SELECT r.conv_id, r.b, CAST(p.start + r.k AS INT) AS pos, r.t, 'sum ' || CAST(r.conv_id AS VARCHAR) || '/' || CAST(r.b AS VARCHAR) AS summary FROM raw r JOIN placed p ON r.conv_id = p.conv_id AND r.b = p.b)"""


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a ledger of model calls."""
    models = F.array(*map(F.lit, MODELS))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.element_at(models, (F.col("l_orderkey") % len(MODELS)).cast("int") + 1).alias("model"),
        (F.col("l_extendedprice") * 4).cast("long").alias("input_tokens"),
        F.when(F.col("l_linenumber") < 7, (F.col("l_quantity") * 100).cast("long")).alias("output_tokens"),
    )


#: Models of the ledger: listed ones, and names that fall back or are unknown.
MODELS = (
    "gemini-2.5-pro-preview-05-06", "gemini-1.5-pro-latest", "gemini-1.5-flash-latest", "gemini-1.5-flash-8b-latest", "gemini-2.0-flash-latest",
    "gemini-2.5-flash-preview-05-07", "gemini-9-pro", "gemini-2.5-pro-exp", "gemini-2.5-flash-x", "gemini-2.0-flash-001", "other-model",
)
USAGE_SQL = f"""
usage AS (SELECT l_orderkey, l_linenumber, list_extract([{", ".join(f"'{m}'" for m in MODELS)}], CAST(l_orderkey % {len(MODELS)} AS INT) + 1) AS model,
  CAST(trunc(l_extendedprice * 4) AS BIGINT) AS input_tokens, CASE WHEN l_linenumber < 7 THEN CAST(trunc(l_quantity * 100) AS BIGINT) END AS output_tokens FROM lineitem),
priced AS (SELECT *, CASE
    WHEN model IN ('gemini-2.5-pro-preview-05-06', 'gemini-1.5-pro-latest', 'gemini-1.5-flash-latest', 'gemini-1.5-flash-8b-latest', 'gemini-2.0-flash-latest', 'gemini-2.5-flash-preview-05-07') THEN model
    WHEN contains(model, '-pro') THEN CASE WHEN contains(model, '2.5') THEN 'gemini-2.5-pro-preview-05-06' ELSE 'gemini-1.5-pro-latest' END
    WHEN contains(model, '-flash') THEN CASE WHEN contains(model, '2.0') THEN 'gemini-2.0-flash-latest' ELSE 'gemini-1.5-flash-latest' END END AS base FROM usage),
prices(m, k, li, lo, hi, ho) AS (VALUES ('gemini-2.5-pro-preview-05-06', 200, 1.25, 10.0, 2.5, 15.0), ('gemini-1.5-pro-latest', 128, 1.25, 5.0, 2.5, 10.0),
    ('gemini-1.5-flash-latest', 128, 0.075, 0.3, 0.15, 0.6), ('gemini-1.5-flash-8b-latest', 128, 0.0375, 0.15, 0.075, 0.3),
    ('gemini-2.0-flash-latest', NULL, 0.1, 0.4, NULL, NULL), ('gemini-2.5-flash-preview-05-07', NULL, 0.15, 0.6, NULL, NULL)),
costs AS (SELECT u.*, round(coalesce(input_tokens / 1e6 * CAST(CASE WHEN input_tokens > k * 1000 THEN hi ELSE li END AS DOUBLE)
    + output_tokens / 1e6 * CAST(CASE WHEN input_tokens > k * 1000 THEN ho ELSE lo END AS DOUBLE), 0.0), 10) AS cost_usd FROM priced u LEFT JOIN prices ON m = base)"""
