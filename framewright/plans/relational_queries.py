"""Queries of frames, ledgers, batches, joins, costs, assembly, exports, engines and the daemon."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright import cli
from framewright.functions import cost, frames, parse, text
from framewright.operators import assemble, batching, engines, ledger
from framewright.plans import inputs, noise_sql, standins
from framewright.plans.catalogue import query, table
from framewright.plans.text_queries import clean_sql
from framewright.session import pinned, scratch, spread
from framewright.sources import sinks, trees
from framewright.streaming import daemon

# frames


@query("frame_number_extract", "SELECT doc_id, CAST(regexp_extract(name, 'frame_(\\d+)\\.', 1) AS INT) AS number FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN printf('frame_%06d.jpg', doc_id) WHEN 1 THEN 'x_frame_' || doc_id || '.png' WHEN 2 THEN 'frame_' || doc_id WHEN 3 THEN 'frm_1.png' ELSE 'frame_1_frame_' || doc_id || '.jpg' END AS name FROM documents) WHERE regexp_extract(name, 'frame_(\\d+)\\.', 1) <> ''")
def frame_number_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    name = (
        F.when(F.col("doc_id") % 5 == 0, F.format_string("frame_%06d.jpg", "doc_id"))
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit("x_frame_"), i, F.lit(".png")))
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit("frame_"), i))
        .when(F.col("doc_id") % 5 == 3, F.lit("frm_1.png"))
        .otherwise(F.concat(F.lit("frame_1_frame_"), i, F.lit(".jpg")))
    )
    return table(spark, sf_dir, "documents").select("doc_id", frames.frame_number(name).alias("number")).filter("number is not null")


@query("frame_name_format", "SELECT doc_id, printf('frame_%06d.jpg', CAST(doc_id AS INT)) AS name, printf('llm_output_batch_%04d.json', CAST(doc_id AS INT)) AS batch_name FROM documents")
def frame_name_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", frames.frame_name(F.col("doc_id")).alias("name"), batching.image_batch_file(F.col("doc_id")).alias("batch_name"))


#: Frame rates by event, native and target.
RATES = ((30.0, 1.0), (25.0, 10.0), (15.0, 10.0), (5.0, 5.0), (30.0, 0.0), (0.0, 1.0), (29.97, 2.0), (60.0, 7.0))
RATES_SQL = "rated AS (SELECT event_id, user_id, list_extract([" + ", ".join(str(a) for a, _ in RATES) + f"]::DOUBLE[], CAST(event_id % {len(RATES)} AS INT) + 1) AS native, list_extract([" + ", ".join(str(b) for _, b in RATES) + f"]::DOUBLE[], CAST(event_id % {len(RATES)} AS INT) + 1) AS target FROM events),\nfixed AS (SELECT *, CASE WHEN native <= 0 THEN 30.0::DOUBLE ELSE native END AS fps FROM rated)"


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = (F.col("event_id") % len(RATES)).cast("int") + 1
    native, target = (F.element_at(F.array(*[F.lit(r[k]) for r in RATES]), at) for k in (0, 1))
    return table(spark, sf_dir, "events").select("event_id", "user_id", native.alias("native"), target.alias("target"))


@query("frame_fps_thinning", f"WITH {RATES_SQL}, i AS (SELECT *, CASE WHEN target > 0 AND target < fps THEN CAST(round_even(fps / target, 0) AS INT) ELSE 1 END AS step FROM fixed) SELECT event_id, step FROM i WHERE event_id % step = 0")
def frame_fps_thinning(spark: SparkSession, sf_dir: str) -> DataFrame:
    native = F.when(F.col("native") <= 0, F.lit(30.0)).otherwise(F.col("native"))
    step = _rated(spark, sf_dir).select("event_id", frames.fps_interval(native, F.col("target")).alias("step"))
    return step.filter(F.pmod("event_id", "step") == 0)


@query("frame_second_label", f"WITH {RATES_SQL} SELECT event_id, CAST(round_even(event_id / fps, 0) AS INT) AS second, printf('frame_%06d.jpg', CAST(round_even(event_id / fps, 0) AS INT)) AS name FROM fixed")
def frame_second_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = frames.second_label(F.col("event_id"), F.col("native"))
    return _rated(spark, sf_dir).select("event_id", second.alias("second"), frames.frame_name(second).alias("name"))


@query("frame_resize_geometry", "WITH g AS (SELECT p_partkey, CAST(p_size * 60 AS INT) AS w, CAST(p_partkey % 1500 + 1 AS INT) AS h, CAST(CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1024 ELSE 640 END AS INT) AS m FROM part), s AS (SELECT *, m > 0 AND greatest(w, h) > m AS shrink, m / greatest(w, h) AS f FROM g) SELECT p_partkey, CASE WHEN shrink THEN CAST(floor(w * f) AS INT) ELSE w END AS width, CASE WHEN shrink THEN CAST(floor(h * f) AS INT) ELSE h END AS height FROM s")
def frame_resize_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = (F.col("p_size") * 60).cast("int"), (F.col("p_partkey") % 1500 + 1).cast("int")
    most = F.when(F.col("p_partkey") % 3 == 0, 0).when(F.col("p_partkey") % 3 == 1, 1024).otherwise(640)
    width, height = frames.resized(w, h, most)
    return table(spark, sf_dir, "part").select("p_partkey", width.alias("width"), height.alias("height"))


@query("frame_sample_k", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('7|' || user_id || '|sample|' || event_id), event_id) AS r FROM events) WHERE r <= 5")
def frame_sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engines.sample_frames(table(spark, sf_dir, "events").select("user_id", "event_id"), 5, 7, "user_id", "event_id")


@query("human_readable_size", "WITH b AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN doc_id * doc_id * 977 WHEN 1 THEN n_chars WHEN 2 THEN doc_id - 2 ELSE n_chars * 1048583 END AS b FROM documents), p AS (SELECT *, CASE WHEN b >= 1099511627776 THEN 4 WHEN b >= 1073741824 THEN 3 WHEN b >= 1048576 THEN 2 WHEN b >= 1024 THEN 1 ELSE 0 END AS p FROM b) SELECT doc_id, CASE WHEN b = 0 THEN '0B' ELSE CAST(CAST(round_even(b / pow(1024.0, p), 2) AS DOUBLE) AS VARCHAR) || ' ' || list_extract(['B', 'KB', 'MB', 'GB', 'TB'], p + 1) END AS size FROM p")
def human_readable_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, n = F.col("doc_id"), F.col("n_chars")
    size = F.when(i % 4 == 0, i * i * 977).when(i % 4 == 1, n).when(i % 4 == 2, i - 2).otherwise(n * 1048583)
    return table(spark, sf_dir, "documents").select("doc_id", frames.readable_size(size).alias("size"))


@query("mime_type", f"WITH {inputs.IMAGES_SQL} SELECT video_id, frame_name, CASE WHEN lower(frame_name) LIKE '%.png' THEN 'image/png' WHEN lower(frame_name) LIKE '%.jp%g' THEN 'image/jpeg' END AS mime FROM images")
def mime_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.images(spark, sf_dir).select("video_id", "frame_name", frames.media_type(F.col("frame_name")).alias("mime"))


# files


@query("pick_video_file", f"WITH {inputs.NAMES_SQL}, r AS (SELECT dir_id, name, list_position(['mp4', 'webm', 'mkv', 'avi', 'mov'], regexp_extract(name, '\\.([^.]*)$', 1)) AS k FROM files), b AS (SELECT *, row_number() OVER (PARTITION BY dir_id ORDER BY k, name) AS n, count(*) OVER (PARTITION BY dir_id, k) AS c FROM r WHERE k IS NOT NULL AND k > 0) SELECT dir_id, name AS video_file, c AS n_candidates FROM b WHERE n = 1")
def pick_video_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.pick_video(inputs.names(spark, sf_dir), "dir_id")


@query("pick_metadata_file", f"WITH {inputs.NAMES_SQL} SELECT dir_id, min(name) AS metadata_file FROM files WHERE name LIKE '%.info.json' GROUP BY dir_id")
def pick_metadata_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.pick_metadata(inputs.names(spark, sf_dir), "dir_id")


@query("list_subtitles", f"WITH {inputs.NAMES_SQL} SELECT dir_id, coalesce(string_agg(name, '|' ORDER BY name) FILTER (name LIKE '%.srt' OR name LIKE '%.vtt'), '') AS subtitles FROM files GROUP BY dir_id")
def list_subtitles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.list_subtitles(inputs.names(spark, sf_dir), "dir_id").select("dir_id", F.array_join("subtitle_files", "|").alias("subtitles"))


@query("png_else_jpg", f"WITH {inputs.IMAGES_SQL}, k AS (SELECT *, frame_name LIKE 'frame\\_%.png' ESCAPE '\\' AS png, frame_name LIKE 'frame\\_%.jpg' ESCAPE '\\' AS jpg FROM images), a AS (SELECT *, bool_or(png) OVER (PARTITION BY video_id) AS has FROM k WHERE png OR jpg) SELECT video_id, frame_name, CAST(row_number() OVER (PARTITION BY video_id ORDER BY frame_name) - 1 AS INT) AS pos FROM a WHERE png OR NOT has")
def png_else_jpg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.png_else_jpg(inputs.images(spark, sf_dir))


@query("image_suffix_filter", f"WITH {inputs.IMAGES_SQL} SELECT video_id, frame_name, CAST(row_number() OVER (PARTITION BY video_id ORDER BY frame_name) - 1 AS INT) AS pos, regexp_replace(frame_name, '\\.[^.]*$', '') AS frame_stem FROM images WHERE regexp_matches(lower(frame_name), '\\.(png|jpg|jpeg)$')")
def image_suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.image_frames(inputs.images(spark, sf_dir))


# ledger


def _dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("rel_path"))


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished directories: every labelled id, and some whose directory is gone."""
    i = F.col("doc_id")
    return table(spark, sf_dir, "labels").select(F.when(i % 10 == 3, -i).otherwise(i).alias("rel_path")).distinct()


DONE_SQL = "done AS (SELECT DISTINCT CASE WHEN doc_id % 10 = 3 THEN -doc_id ELSE doc_id END AS rel_path FROM labels), dirs AS (SELECT doc_id AS rel_path FROM documents), todo AS (SELECT rel_path FROM dirs WHERE rel_path NOT IN (SELECT rel_path FROM done))"


@query("checkpoint_anti_join", f"WITH {DONE_SQL} SELECT rel_path FROM todo")
def checkpoint_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pending(_dirs(spark, sf_dir), _done(spark, sf_dir))


@query("checkpoint_stale", f"WITH {DONE_SQL} SELECT rel_path FROM done WHERE rel_path NOT IN (SELECT rel_path FROM dirs)")
def checkpoint_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.stale(_done(spark, sf_dir), _dirs(spark, sf_dir))


@query("checkpoint_skipped_top10", f"WITH {DONE_SQL}, s AS (SELECT rel_path FROM dirs WHERE rel_path IN (SELECT rel_path FROM done)) SELECT rel_path, greatest((SELECT count(*) FROM s) - 10, 0) AS n_more FROM s ORDER BY rel_path LIMIT 10")
def checkpoint_skipped_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.listing(ledger.skipped(_dirs(spark, sf_dir), _done(spark, sf_dir)), "rel_path")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as lines of a checkpoint file: good ones, blank ones, ones with a written-out line end, long ones."""
    i = F.col("doc_id")
    value = (
        F.when(i % 5 == 0, F.concat(F.lit("  dir"), (i % 100).cast("string"), F.lit(" ")))
        .when(i % 5 == 1, F.lit("   "))
        .when(i % 5 == 2, F.concat(F.lit("a\\nb"), i.cast("string")))
        .when(i % 5 == 3, F.repeat(F.lit("x"), (1020 + i % 10).cast("int")))
        .otherwise(F.concat(F.lit("c\rd"), i.cast("string")))
    )
    return table(spark, sf_dir, "documents").select(value.alias("value"))


LINES_SQL = "lines AS (SELECT trim(CASE doc_id % 5 WHEN 0 THEN '  dir' || (doc_id % 100) || ' ' WHEN 1 THEN '   ' WHEN 2 THEN 'a' || chr(92) || 'nb' || doc_id WHEN 3 THEN repeat('x', 1020 + doc_id % 10) ELSE 'c' || chr(13) || 'd' || doc_id END) AS v FROM documents)"


@query("checkpoint_parse", f"WITH {LINES_SQL} SELECT DISTINCT v AS rel_path FROM lines WHERE v <> '' AND NOT contains(v, chr(92) || 'n') AND NOT contains(v, chr(13)) AND length(v) <= 1024")
def checkpoint_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.parse_checkpoint(_lines(spark, sf_dir))


@query("checkpoint_parse_lenient", f"WITH {LINES_SQL} SELECT DISTINCT v AS rel_path FROM lines WHERE v <> ''")
def checkpoint_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.parse_checkpoint(_lines(spark, sf_dir), strict=False)


@query("checkpoint_malformed", f"WITH {LINES_SQL} SELECT count(*) AS n_malformed FROM lines WHERE v <> '' AND (contains(v, chr(92) || 'n') OR contains(v, chr(13)) OR length(v) > 1024)")
def checkpoint_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.malformed_entries(_lines(spark, sf_dir))


@query("pending_slice_clamped", f"WITH {DONE_SQL} SELECT rel_path FROM todo ORDER BY rel_path LIMIT 999990 OFFSET 10")
def pending_slice_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.slice_pending(checkpoint_anti_join(spark, sf_dir), "rel_path", 10, 1_000_000)


@query("pending_slice_strict", f"WITH {DONE_SQL} SELECT rel_path FROM todo ORDER BY rel_path LIMIT 30 OFFSET 20")
def pending_slice_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = checkpoint_anti_join(spark, sf_dir)
    return ledger.slice_pending(todo, "rel_path", 20, 50, clamp=False).unionByName(ledger.slice_pending(todo, "rel_path", 0, 1_000_000, clamp=False))


#: Ids asked for, in this order: there, there twice, not there.
WANTED = ("7", "3", "zz", "7", "50")


@query("video_id_subset", "SELECT w AS video_id FROM (VALUES ('7'), ('3'), ('zz'), ('7'), ('50')) t(w) WHERE w IN (SELECT CAST(conv_id AS VARCHAR) FROM conversations)")
def video_id_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.requested(inputs.frames(spark, sf_dir).select("video_id").distinct(), list(WANTED))


@query("video_id_omitted", "SELECT DISTINCT w AS video_id FROM (VALUES ('7'), ('3'), ('zz'), ('7'), ('50')) t(w) WHERE w NOT IN (SELECT CAST(conv_id AS VARCHAR) FROM conversations)")
def video_id_omitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.omitted(inputs.frames(spark, sf_dir), spark.createDataFrame([(w,) for w in WANTED], "video_id string"))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as outcomes of directories: user as directory, type as status."""
    kind = F.col("event_type")
    status = F.when(kind == "error", F.lit("Failed: x")).when(F.col("event_id") % 7 == 0, F.lit("No frame_*.png or frame_*.jpg")).otherwise(F.lit("Success (1)"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), status.alias("status"), (F.col("event_id") % 50).alias("n_items"))


OUTCOMES_SQL = "outcomes AS (SELECT user_id AS video_id, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 7 = 0 THEN 'no_frames' ELSE 'success' END AS s, event_id % 50 AS n FROM events)"


@query("pass_counters", f"WITH {OUTCOMES_SQL} SELECT count(*) AS attempted, count(*) FILTER (s = 'success') AS successful, count(*) FILTER (s = 'no_frames') AS no_frames, count(*) FILTER (s = 'failed') AS failed, CAST(sum(n) FILTER (s = 'success') AS BIGINT) AS frames FROM outcomes")
def pass_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pass_counters(_outcomes(spark, sf_dir))


@query("overall_totals", f"WITH {OUTCOMES_SQL} SELECT count(*) AS attempted, count(*) FILTER (s = 'success') AS successful, count(*) FILTER (s = 'no_frames') AS no_frames, count(*) FILTER (s = 'failed') AS failed, CAST(sum(n) FILTER (s = 'success') AS BIGINT) AS frames FROM outcomes")
def overall_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _outcomes(spark, sf_dir)
    passes = [ledger.pass_counters(outcomes.filter(F.col("video_id") % 2 == k)) for k in (0, 1)]
    return ledger.overall_totals(passes[0].unionByName(passes[1]))


@query("directory_success", f"WITH {OUTCOMES_SQL} SELECT video_id, count(*) AS batches, count(*) FILTER (s <> 'failed') AS batches_ok, bool_and(s <> 'failed') AS success FROM outcomes GROUP BY video_id")
def directory_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _outcomes(spark, sf_dir).select("video_id", (ledger.status_class(F.col("status")) != "failed").alias("ok"), F.col("n_items").alias("num_frames"), F.lit(0.0).alias("cost_usd"))
    return ledger.directory_totals(rows).select("video_id", "batches", "batches_ok", "success")


# batches

BATCHES_SQL = f"""{inputs.FRAMES_SQL},
numbered AS (SELECT *, CAST((row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) - 1) // 3 AS INT) AS batch FROM frames),
grouped AS (SELECT video_id, batch, min(frame_idx) AS a, max(frame_idx) AS b, count(*) AS n, string_agg(raw_text, '|' ORDER BY frame_idx) AS texts,
  trim(string_agg('--- Frame ' || frame_idx || ' ---' || chr(10) || raw_text, chr(10) || chr(10) ORDER BY frame_idx), ' ' || chr(10)) AS batch_text FROM numbered GROUP BY ALL)"""


@query("batch_frames", f"WITH {BATCHES_SQL} SELECT video_id, batch, a AS start_frame_index, b AS end_frame_index, CAST(n AS INT) AS num_frames FROM grouped")
def batch_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batches(inputs.frames(spark, sf_dir), 3).select("video_id", "batch", "start_frame_index", "end_frame_index", "num_frames")


@query("batch_concat_text", f"WITH {BATCHES_SQL} SELECT video_id, batch, batch_text FROM grouped")
def batch_concat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batches(inputs.frames(spark, sf_dir), 3).select("video_id", "batch", "batch_text")


@query("batch_raw_texts", f"WITH {BATCHES_SQL} SELECT video_id, batch, texts FROM grouped")
def batch_raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batches(inputs.frames(spark, sf_dir), 3).select("video_id", "batch", F.array_join("task1_raw_ocr_text", "|").alias("texts"))


@query("batch_file_names", f"WITH {BATCHES_SQL} SELECT video_id, batch, printf('batch_%06d_%06d.json', CAST(a AS INT), CAST(b AS INT)) AS file_name FROM grouped")
def batch_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batches(inputs.frames(spark, sf_dir), 3).select("video_id", "batch", "file_name")


@query("batch_validate", f"WITH {inputs.BATCH_ROWS_SQL} SELECT CAST(conv_id AS VARCHAR) AS video_id, printf('llm_output_batch_%04d.json', b) AS batch_file, valid FROM marked")
def batch_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.llm_batches(spark, sf_dir).select("video_id", "batch_file", assemble.is_valid().alias("valid"))


@query("batch_concat_offsets", f"WITH {inputs.BATCH_ROWS_SQL} SELECT CAST(conv_id AS VARCHAR) AS video_id, pos, t AS t3 FROM rows_")
def batch_concat_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.batch_rows(inputs.llm_batches(spark, sf_dir)).select("video_id", "pos", "t3")


@query("summary_broadcast", f"WITH {inputs.BATCH_ROWS_SQL} SELECT CAST(conv_id AS VARCHAR) AS video_id, pos, summary FROM rows_")
def summary_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.batch_rows(inputs.llm_batches(spark, sf_dir)).select("video_id", "pos", F.col("t5").alias("summary"))


# joins


def _frame_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = inputs.frames(spark, sf_dir).select("video_id", "frame_name")
    return base.withColumn("frame_path", F.concat(F.lit("/frames/"), "video_id", F.lit("/"), "frame_name"))


def _ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR texts of which some have the other extension, some are missing and some are empty."""
    i, base = F.col("frame_idx"), inputs.frames(spark, sf_dir)
    name = F.when(i % 5 == 2, F.replace(F.col("frame_name"), F.lit(".png"), F.lit(".jpg"))).otherwise(F.col("frame_name"))
    body = F.when(i % 7 == 5, F.lit("")).otherwise(F.col("raw_text"))
    return base.filter(i % 5 != 4).select("video_id", name.alias("frame_name"), body.alias("raw_text"))


OCR_SQL = f"""{inputs.FRAMES_SQL},
ocr AS (SELECT video_id, frame_idx, frame_name, CASE WHEN frame_idx % 7 = 5 THEN '' ELSE raw_text END AS ocr_text FROM frames WHERE frame_idx % 5 <> 4)"""


@query("positional_join", f"WITH {inputs.BATCH_ROWS_SQL} SELECT CAST(c.conv_id AS VARCHAR) AS video_id, printf('frame_%06d.png', c.turn) AS frame_name, r.t AS t3 FROM conversations c JOIN rows_ r ON r.conv_id = c.conv_id AND r.pos = c.turn")
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble.batch_rows(inputs.llm_batches(spark, sf_dir)).drop("batch_file")
    return assemble.image_frames(_frame_files(spark, sf_dir)).join(rows, ["video_id", "pos"]).select("video_id", "frame_name", "t3")


@query("ocr_name_fallback_join", f"WITH {OCR_SQL} SELECT video_id, frame_name, ocr_text FROM ocr")
def ocr_name_fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assemble.image_frames(_frame_files(spark, sf_dir)).join(assemble.ocr_maps(_ocr(spark, sf_dir)), "video_id")
    looked = found.select("video_id", "frame_name", assemble.ocr_lookup(F.col("texts"), F.col("frame_name"), F.col("frame_stem")).alias("ocr_text"))
    return looked.filter("ocr_text is not null")


@query("ocr_reader_fallback", f"WITH {OCR_SQL} SELECT f.video_id, f.frame_name, coalesce(o.ocr_text, '') AS ocr_text FROM frames f LEFT JOIN ocr o USING (video_id, frame_idx)")
def ocr_reader_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assemble.image_frames(_frame_files(spark, sf_dir)).join(assemble.ocr_maps(_ocr(spark, sf_dir)), "video_id")
    return found.select("video_id", "frame_name", assemble.ocr_read(F.col("texts"), F.col("frame_stem")).alias("ocr_text"))


def _aux(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.names(spark, sf_dir).select(F.col("dir_id").cast("string").alias("video_id"), F.concat(F.lit("/aux/"), "dir_id", F.lit("/"), "name").alias("path"))


@query("aux_left_join", f"WITH {inputs.FRAMES_SQL}, {inputs.NAMES_SQL}, a AS (SELECT CAST(dir_id AS VARCHAR) AS video_id, min('/aux/' || dir_id || '/' || name) FILTER (name LIKE '%.info.json') AS metadata_filepath, string_agg('/aux/' || dir_id || '/' || name, '|' ORDER BY name) FILTER (name LIKE '%.srt' OR name LIKE '%.vtt') AS subtitles FROM files GROUP BY dir_id) SELECT video_id, frame_name, metadata_filepath, coalesce(subtitles, '') AS subtitles FROM frames LEFT JOIN a USING (video_id)")
def aux_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = inputs.frames(spark, sf_dir).select("video_id", "frame_name").join(assemble.aux_paths(_aux(spark, sf_dir)), "video_id", "left")
    return joined.select("video_id", "frame_name", "metadata_filepath", F.coalesce(F.array_join("subtitle_filepaths", "|"), F.lit("")).alias("subtitles"))


@query("filtered_reindex", "SELECT CAST(conv_id AS VARCHAR) AS video_id, printf('frame_%06d.png', turn) AS frame_name, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS idx FROM conversations WHERE turn % 5 <> 4")
def filtered_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ocr_name_fallback_join(spark, sf_dir)
    return found.select("video_id", "frame_name", (F.row_number().over(Window.partitionBy("video_id").orderBy("frame_name")) - 1).alias("idx"))


@query("key_fallback", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'a' WHEN doc_id % 4 = 1 THEN 'b' || lang WHEN doc_id % 4 = 2 THEN '' ELSE '' END AS clean FROM documents")
def key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id") % 4
    first, second, third = F.when(i == 0, F.lit("a")), F.when(i == 1, F.concat(F.lit("b"), "lang")), F.when(i == 2, F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", assemble.first_present(first, second, third).alias("clean"))


@query("task2_choice", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'p' || source WHEN 1 THEN 'o' || source WHEN 2 THEN 'o' || source ELSE '' END AS task2 FROM documents")
def task2_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, s = F.col("doc_id") % 5, F.col("source")
    primary = F.when(i == 0, F.concat(F.lit("p"), s)).when((i == 1) | (i == 3), F.lit(""))
    other = F.when((i == 1) | (i == 2) | (i == 0), F.concat(F.lit("o"), s)).when(i == 3, F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", assemble.task2_text(primary, other).alias("task2"))


# cost


@query("token_cost", f"WITH {inputs.USAGE_SQL} SELECT l_orderkey, l_linenumber, cost_usd FROM costs")
def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _costs(spark, sf_dir).select("l_orderkey", "l_linenumber", "cost_usd")


def _costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost.with_cost(inputs.usage(spark, sf_dir)).withColumn("cost_usd", F.round("cost_usd", 10))


@query("token_cost_fallback", f"WITH {inputs.USAGE_SQL} SELECT DISTINCT model, base FROM costs")
def token_cost_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.usage(spark, sf_dir).select("model").distinct().select("model", cost.priced_model(F.col("model")).alias("base"))


@query("cost_stats", f"WITH {inputs.USAGE_SQL} SELECT count(*) AS n, round(sum(cost_usd), 4) AS total, round(avg(cost_usd), 6) AS mean, round(stddev_pop(cost_usd), 6) AS std, min(cost_usd) AS least, max(cost_usd) AS most FROM costs")
def cost_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cost.cost_stats(_costs(spark, sf_dir))
    return stats.withColumns({"total": F.round("total", 4), "mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("cost_stats_report", f"WITH {inputs.USAGE_SQL}, s AS (SELECT count(*) AS n, sum(cost_usd) AS t, avg(cost_usd) AS m, stddev_pop(cost_usd) AS d, min(cost_usd) AS a, max(cost_usd) AS b FROM costs) SELECT unnest(list_concat(['files with a cost: ' || n], list_transform([['total', format('{{:,.4f}}', t)], ['mean', format('{{:,.4f}}', m)], ['std', format('{{:,.4f}}', d)], ['least', format('{{:,.4f}}', a)], ['most', format('{{:,.4f}}', b)]], lambda x: x[1] || ': ' || x[2]))) AS line FROM s")
def cost_stats_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.stats_report(cost.cost_stats(_costs(spark, sf_dir)))


@query("cost_documents", "SELECT l_orderkey, CAST(CASE l_linenumber % 4 WHEN 0 THEN l_quantity WHEN 1 THEN l_tax END AS DOUBLE) AS cost_usd FROM lineitem")
def cost_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost at a document's top level, or among its statistics; a text or a missing cost counts as none."""
    n = F.col("l_linenumber") % 4
    top = F.to_json(F.struct(F.col("l_quantity").alias("estimated_cost_usd"), F.struct(F.col("l_tax").alias("estimated_cost_usd")).alias("processing_stats")))
    nested = F.to_json(F.struct(F.struct(F.col("l_tax").alias("estimated_cost_usd")).alias("processing_stats")))
    doc = F.when(n == 0, top).when(n == 1, nested).when(n == 2, F.lit('{"estimated_cost_usd": "free"}')).otherwise(F.lit("{broken"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", cost.document_cost(doc).alias("cost_usd"))


@query("cost_by_video", f"WITH {inputs.USAGE_SQL} SELECT l_orderkey AS video_id, count(*) AS batches, count(output_tokens) AS batches_ok, round(coalesce(sum(cost_usd) FILTER (output_tokens IS NOT NULL), 0.0), 10) AS cost_ok, bool_and(output_tokens IS NOT NULL) AS success FROM costs GROUP BY l_orderkey")
def cost_by_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _costs(spark, sf_dir).select(F.col("l_orderkey").alias("video_id"), F.col("output_tokens").isNotNull().alias("ok"), "cost_usd", F.lit(60).alias("num_frames"))
    totals = ledger.directory_totals(rows)
    return totals.select("video_id", "batches", "batches_ok", F.round("cost_ok", 10).alias("cost_ok"), "success")


# assembly and exports


def _samples(spark: SparkSession, sf_dir: str, profiles: list[str] | None = []) -> DataFrame:  # noqa: B006  it stays empty
    """Samples without noise, unless ``profiles`` is None: then with all profiles."""
    return assemble.samples(_frame_files(spark, sf_dir), inputs.llm_batches(spark, sf_dir), _ocr(spark, sf_dir), _aux(spark, sf_dir), noise_sql.SEED, profiles)


#: Samples in SQL: frames with a model row and an OCR text, renumbered, references to row 0 resolved.
SAMPLES_SQL = f"""{inputs.BATCH_ROWS_SQL}, {OCR_SQL},
matched AS (SELECT f.video_id, f.frame_name, f.frame_idx, r.t, r.summary, o.ocr_text FROM frames f JOIN rows_ r ON CAST(r.conv_id AS VARCHAR) = f.video_id AND r.pos = f.frame_idx JOIN ocr o USING (video_id, frame_idx)),
firsts AS (SELECT video_id, t AS first_text FROM matched WHERE frame_idx = 0),
sampled AS (SELECT m.*, CASE WHEN starts_with(t, 'F:0') THEN first_text || ' again' ELSE t END AS clean, CASE WHEN starts_with(t, 'F:0') THEN '# ' || first_text || ' again' ELSE '# ' || t END AS markdown FROM matched m JOIN firsts USING (video_id))"""


@query("sample_assembly", f"WITH {SAMPLES_SQL} SELECT '/frames/' || video_id || '/' || frame_name AS frame_path, video_id, regexp_replace(frame_name, '\\.[^.]*$', '') AS frame_stem, {clean_sql('ocr_text')} AS tesseract_ocr, clean AS llm_clean_ocr, markdown, summary FROM sampled")
def sample_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _samples(spark, sf_dir).select("frame_path", "video_id", "frame_stem", "tesseract_ocr", "llm_clean_ocr", "markdown", "summary")


_CHOICE, _CHOSEN = noise_sql.choice("keyed")


@query("export_standard", f"WITH {SAMPLES_SQL}, keyed AS (SELECT video_id || '/' || frame_name AS doc_id, clean AS text FROM sampled), {', '.join(_CHOICE)} SELECT '/frames/' || video_id || '/' || frame_name AS frame_path, {clean_sql('ocr_text')} AS tesseract_ocr, clean AS llm_clean_ocr, c.text AS augmented_llm_clean_ocr, markdown, summary FROM sampled JOIN {_CHOSEN} c ON c.doc_id = video_id || '/' || frame_name")
def export_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: samples with a noisy text, of a profile drawn per frame."""
    return assemble.export(_samples(spark, sf_dir, None), "standard")


@query("export_cleaning_pairs", f"WITH {SAMPLES_SQL} SELECT '/frames/' || video_id || '/' || frame_name AS frame_path, {clean_sql('ocr_text')} AS raw_ocr, clean AS clean_ocr FROM sampled")
def export_cleaning_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.export(_samples(spark, sf_dir), "cleaning_pairs")


@query("export_jsonl_text", f"WITH {SAMPLES_SQL} SELECT CAST(to_json({{'frame_path': '/frames/' || video_id || '/' || frame_name, 'raw_ocr': {clean_sql('ocr_text')}, 'clean_ocr': clean}}) AS VARCHAR) AS line FROM sampled")
def export_jsonl_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = export_cleaning_pairs(spark, sf_dir)
    return pairs.select(F.to_json(F.struct("frame_path", "raw_ocr", "clean_ocr")).alias("line"))


@query("ocr_document", "SELECT CAST(conv_id AS VARCHAR) AS video_id, '{' || string_agg(CAST(to_json(printf('frame_%06d.png', turn)) AS VARCHAR) || ':' || CAST(to_json(text) AS VARCHAR), ',' ORDER BY turn) || '}' AS value FROM conversations GROUP BY conv_id")
def ocr_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.ocr_document(inputs.frames(spark, sf_dir))


@query("ocr_document_scan", "SELECT CAST(conv_id AS VARCHAR) AS video_id, printf('frame_%06d.png', turn) AS frame_name, text AS raw_text FROM conversations WHERE conv_id % 9 <> 4")
def ocr_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR documents read back; a broken one leaves no row."""
    whole = F.when(F.col("video_id").cast("long") % 9 == 4, F.lit('{"frame')).otherwise(F.col("value"))
    read = ocr_document(spark, sf_dir).select("video_id", F.from_json(whole, "map<string,string>").alias("m")).filter("m is not null")
    return read.select("video_id", F.explode("m").alias("frame_name", "raw_text")).filter("frame_name is not null")


@query("ocr_failed_sentinel", f"SELECT CAST(doc_id AS VARCHAR) AS video_id, CASE doc_id % 3 WHEN 0 THEN '{engines.OCR_EMPTY}' WHEN 1 THEN '<<< OCR_EXCEPTION: page ' || doc_id || ' >>>' ELSE trim(text, ' ' || chr(10)) END AS raw_text, doc_id % 3 <> 2 AS ocr_failed FROM documents")
def ocr_failed_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of which one in three has no text and one in three makes the engine raise."""
    kind = F.col("doc_id") % 3
    content = F.when(kind == 0, F.lit("")).when(kind == 1, F.concat(F.lit("!page "), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("="), "text"))
    images = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"), F.lit("frame_000000.png").alias("frame_name"), content.cast("binary").alias("content"))
    return engines.ocr(images, standins.marked_ocr).drop("frame_name")


# engines


def _stripped(c: str) -> str:
    return f"trim({c}, ' ' || chr(10))"


@query("llm_text_stage_fake", f"WITH {inputs.FRAMES_SQL} SELECT video_id, frame_idx, {clean_sql('raw_text')} AS clean FROM frames")
def llm_text_stage_fake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames cleaned, batched, sent to an echoing model, parsed and joined back to their frames: the flagship chain."""
    cleaned = inputs.frames(spark, sf_dir).withColumn("raw_text", text.clean_ocr(F.col("raw_text")))
    made = batching.batches(cleaned, 3)
    called = pinned(engines.call_model(made, "Clean these frames.", engines.echo_model), "answers")
    parsed = called.select("video_id", "batch", parse.text_response(F.col("response")).alias("p"))
    answers = parsed.select("video_id", "batch", F.posexplode("p.task3_cleaned_text").alias("k", "clean"))
    asked = made.select("video_id", "batch", F.posexplode("frame_indexes").alias("k", "frame_idx"))
    return asked.join(answers, ["video_id", "batch", "k"]).select("video_id", "frame_idx", "clean")


@query("llm_text_batch_document", f"WITH {BATCHES_SQL} SELECT video_id, printf('batch_%06d_%06d.json', CAST(a AS INT), CAST(b AS INT)) AS file_name, a AS first, CAST(n AS BIGINT) AS n FROM grouped")
def llm_text_batch_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested documents of a text-model run, read back from their JSON."""
    made = batching.batches(inputs.frames(spark, sf_dir), 3)
    called = engines.call_model(made, "Clean these frames.", engines.echo_model)
    rows = made.join(called, ["video_id", "batch"]).withColumns({"parsed": parse.text_response(F.col("response")), "ts": F.lit("2024-01-01 00:00:00").cast("timestamp"), "seconds": F.lit(0.5), "cost_usd": F.lit(0.0)})
    docs = sinks.text_batch_document(rows)
    return docs.select("video_id", "file_name", F.get_json_object("value", "$.batch_info.start_frame_index").cast("long").alias("first"), F.get_json_object("value", "$.batch_info.num_frames_in_batch").cast("long").alias("n"))


@query("llm_image_stage_fake", f"WITH {inputs.FRAMES_SQL} SELECT video_id, frame_idx, {_stripped('raw_text')} AS text FROM frames")
def llm_image_stage_fake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose response has the five-block layout, parsed by position."""
    made = batching.batches(inputs.frames(spark, sf_dir), 60)
    called = engines.call_model(made, "Read these frames.", _image_echo)
    parsed = called.select("video_id", "batch", parse.image_response(F.col("response"), "v5").alias("p"))
    return parsed.select("video_id", F.posexplode("p.task1_raw_ocr").alias("k", "text")).select("video_id", F.col("k").cast("long").alias("frame_idx"), "text")


def _image_echo() -> engines.ModelEngine:
    echo = engines.echo_model()

    def answer(prompt: str, batch: str) -> tuple[str, int, int]:
        response, n_in, n_out = echo(prompt, batch)
        block = response.split(parse.TASK4)[0].removeprefix(parse.TASK3 + "\n")
        return "".join(f"==== TASK {k}: X ====\n{block}\n" for k in range(1, 5)) + "==== TASK 5: X ====\nsummary", n_in, n_out

    return answer


@query("ocr_stage_fake", f"WITH {inputs.FRAMES_SQL} SELECT video_id, frame_name, CASE frame_idx % 4 WHEN 1 THEN '{engines.OCR_EMPTY}' WHEN 2 THEN '<<< OCR_EXCEPTION: bad >>>' ELSE {_stripped('raw_text')} END AS raw_text, frame_idx % 4 IN (1, 2) AS ocr_failed FROM frames")
def ocr_stage_fake(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("frame_idx") % 4
    content = F.when(i == 1, F.lit("")).when(i == 2, F.lit("!bad")).otherwise(F.col("raw_text")).cast("binary")
    return engines.ocr(inputs.frames(spark, sf_dir).withColumn("content", content), engines.byte_ocr)


@query("decode_stage_fake", "SELECT CAST(conv_id AS VARCHAR) AS video_id, turn AS frame_count, CAST(round_even(turn / 2.0, 0) AS INT) AS second FROM conversations WHERE turn % 2 = 0")
def decode_stage_fake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of two frames a second, thinned to one."""
    item = F.struct("frame_idx", F.concat(F.lit("f"), F.col("frame_idx").cast("string")).alias("f"))
    videos = inputs.frames(spark, sf_dir).groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["f"]), "\n").alias("body"))
    rated = videos.select("video_id", F.concat(F.lit("2\n"), "body").cast("binary").alias("content"))
    return engines.decode(rated, engines.line_decoder, 1.0).select("video_id", "frame_count", "second")


# daemon


def _scratch(spark: SparkSession) -> str:
    return f"{scratch(spark)}/daemon-{uuid.uuid4().hex}"


def _two_passes(spark: SparkSession, sf_dir: str, failing: Column) -> str:
    """Two passes over the users of events; in the first, ``failing`` directories fail. Returns the ledger's path."""
    path = _scratch(spark)
    dirs = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("rel_path")).distinct()
    outcome = lambda bad: lambda todo: todo.select("rel_path", F.when(bad, F.lit("Failed: x")).otherwise(F.lit("Success")).alias("status"), F.lit(1).alias("n_items"), F.lit(0.0).alias("cost_usd"))
    daemon.run_pass(dirs, path, "ocr", outcome(failing))
    daemon.run_pass(dirs, path, "ocr", outcome(F.lit(False)))
    return path


@query("daemon_two_pass", "SELECT CAST(user_id AS VARCHAR) AS rel_path, CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END AS attempts FROM events GROUP BY user_id")
def daemon_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _two_passes(spark, sf_dir, F.col("rel_path").cast("long") % 3 == 0)
    return spark.read.schema(daemon.LEDGER).parquet(path).groupBy("rel_path").agg(F.count(F.lit(1)).cast("int").alias("attempts"))


@query("daemon_retry_failed", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS rel_path FROM events")
def daemon_retry_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daemon.done(spark, _two_passes(spark, sf_dir, F.col("rel_path").cast("long") % 2 == 0), "ocr")


@query("daemon_stream", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS rel_path FROM events")
def daemon_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daemon as a stream that works off all arrivals and stops."""
    path = _scratch(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    arrivals = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    dirs = lambda: events.select(F.col("user_id").cast("string").alias("rel_path")).distinct()
    work = lambda todo: todo.select("rel_path", F.lit("Success").alias("status"), F.lit(1).alias("n_items"), F.lit(0.0).alias("cost_usd"))
    daemon.watch(arrivals, dirs, f"{path}/ledger", f"{path}/state", "frames", work).awaitTermination()
    return daemon.done(spark, f"{path}/ledger", "frames")


@query("daemon_dry_run", f"WITH {DONE_SQL} SELECT CAST(rel_path AS VARCHAR) AS rel_path, 'Success (dry run)' AS status FROM dirs")
def daemon_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirs = _dirs(spark, sf_dir).select(F.col("rel_path").cast("string").alias("rel_path"))
    return daemon.run_pass(dirs, _scratch(spark), "frames", lambda todo: todo, dry_run=True).select("rel_path", "status")


# stages of the command line, on files in the scratch folder


def _file(spark: SparkSession, path: str, content: str) -> str:
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(path)
    return path


@query("stage_chain_ocr_to_text", f"WITH {inputs.FRAMES_SQL} SELECT video_id, frame_idx, {_stripped('raw_text')} AS clean FROM frames WHERE CAST(video_id AS BIGINT) % 5 <> 2 OR frame_idx % 2 = 0")
def stage_chain_ocr_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of frames through the OCR stage, its documents through the model stage, and that stage's documents read back."""
    root = _scratch(spark)
    images = inputs.frames(spark, sf_dir).filter("cast(video_id as bigint) % 5 <> 2 or frame_idx % 2 = 0")
    sinks.write_frames(images.select("video_id", "frame_name", F.col("raw_text").cast("binary").alias("content")), f"{root}/frames")
    cli.main(["ocr", "--frames-table", "--input", f"{root}/frames", "--out", f"{root}/ocr", "--ledger", f"{root}/ledger"], spark)
    prompt = _file(spark, f"{root}/prompt", "Clean these frames.")
    cli.main(["text-model", "--input", f"{root}/ocr/documents", "--out", f"{root}/text", "--ledger", f"{root}/ledger", "--prompt", prompt, "--batch-size", "3"], spark)
    made = trees.text_batches(spark, f"{root}/text/documents").select("video_id", F.regexp_extract("batch_file", r"batch_(\d+)", 1).cast("long").alias("first"), F.posexplode("task3_cleaned").alias("k", "clean"))
    step = F.when(F.col("video_id").cast("long") % 5 == 2, 2).otherwise(1)
    return made.select("video_id", (F.col("first") + F.col("k") * step).alias("frame_idx"), "clean")


@query("stage_retry", f"WITH {inputs.FRAMES_SQL}, v AS (SELECT video_id, count(*) AS n, CAST(video_id AS BIGINT) % 4 = 1 AS failed FROM frames GROUP BY video_id) SELECT video_id AS rel_path, CASE WHEN failed THEN 2 ELSE 1 END AS attempts, 'Success (' || n || ')' AS status, n AS n_items, NOT failed AS paid_once FROM v")
def stage_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model stage over OCR documents; in the first of three passes the model is busy for one batch of every fourth video."""
    root = _scratch(spark)
    busy = (F.col("video_id").cast("long") % 4 == 1) & (F.col("frame_idx") == 0)
    frames_ = inputs.frames(spark, sf_dir).withColumn("raw_text", F.when(busy, F.concat("raw_text", F.lit(f" {standins.BUSY}"))).otherwise(F.col("raw_text")))
    sinks.write_documents(sinks.ocr_document(frames_).withColumn("file_name", F.lit("tesseract_ocr.json")), f"{root}/in")
    for prompt in ("Clean.", "Clean again.", "Clean again."):
        told = _file(spark, f"{root}/prompt-{uuid.uuid4().hex}", prompt)
        done = cli.main(["text-model", "--input", f"{root}/in", "--out", f"{root}/out", "--ledger", f"{root}/ledger", "--prompt", told, "--batch-size", "3", "--engine", "framewright.plans.standins:moody_model"], spark)
    last = done.groupBy("rel_path").agg(F.count(F.lit(1)).cast("int").alias("attempts"), F.max_by("status", "ts").alias("status"), F.max_by("n_items", "ts").alias("n_items"), F.count_if(F.col("status").startswith("Failed")).alias("failures"))
    return last.select("rel_path", "attempts", "status", "n_items", (F.col("failures") == 0).alias("paid_once"))


def _documents(spark: SparkSession, sf_dir: str) -> str:
    """OCR documents of all videos in the scratch folder, every ninth of them cut short. Returns the folder."""
    root = f"{_scratch(spark)}/documents"
    whole = F.when(F.col("video_id").cast("long") % 9 == 4, F.lit('{"frame')).otherwise(F.col("value"))
    sinks.write_documents(ocr_document(spark, sf_dir).select("video_id", F.lit("tesseract_ocr.json").alias("file_name"), whole.alias("value")), root)
    return root


@query("scan_subdirectories", "SELECT DISTINCT CAST(conv_id AS VARCHAR) AS rel_path FROM conversations")
def scan_subdirectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.subdirectories(spark, _documents(spark, sf_dir))


@query("scan_json_documents", "SELECT CAST(conv_id AS VARCHAR) AS video_id, 'tesseract_ocr.json' AS file_name, CASE WHEN conv_id % 9 = 4 THEN '{\"frame' ELSE '{' || string_agg(CAST(to_json(printf('frame_%06d.png', turn)) AS VARCHAR) || ':' || CAST(to_json(text) AS VARCHAR), ',' ORDER BY turn) || '}' END AS value FROM conversations GROUP BY conv_id")
def scan_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All JSON documents below a folder, at any depth."""
    path = F.col("path")
    return trees.json_documents(spark, _documents(spark, sf_dir)).select(trees.video_of(path).alias("video_id"), trees.name_of(path).alias("file_name"), "value")


@query("scan_ocr_files", "SELECT CAST(conv_id AS VARCHAR) AS video_id, printf('frame_%06d.png', turn) AS frame_name, text AS raw_text FROM conversations WHERE conv_id % 9 <> 4")
def scan_ocr_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR documents read from files; a broken one leaves no row."""
    return trees.ocr_texts(spark, _documents(spark, sf_dir)).filter("frame_name is not null")


@query("scan_prompt", "SELECT 'First line.' || chr(10) || 'Second line.' || chr(10) AS prompt")
def scan_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _file(spark, f"{_scratch(spark)}/prompt", "First line.\nSecond line.")
    return spark.createDataFrame([(trees.prompt(spark, path),)], "prompt string")


@query("scan_image_batches", f"WITH {inputs.FRAMES_SQL} SELECT video_id, printf('llm_output_batch_%04d.json', CAST(frame_idx // 3 AS INT)) AS batch_file, CAST(frame_idx % 3 AS INT) AS k, raw_text AS t1, '# ' || raw_text AS t4, 'summary of ' || video_id AS t5 FROM frames")
def scan_image_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat documents of an image model, written and read back."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("frame_idx", "raw_text"))), lambda x: x["raw_text"])
    grouped = inputs.frames(spark, sf_dir).groupBy("video_id", F.floor(F.col("frame_idx") / 3).cast("int").alias("batch")).agg(texts.alias("t"))
    parsed = F.struct(*[F.col("t").alias(k) for k in parse.LAYOUTS["v5"][:3]], F.transform("t", lambda x: F.concat(F.lit("# "), x)).alias("task4_markdown"), F.concat(F.lit("summary of "), "video_id").alias("task5_summary"))
    root = f"{_scratch(spark)}/batches"
    sinks.write_documents(sinks.image_batch_document(grouped.select("video_id", "batch", parsed.alias("parsed"))), root)
    read = trees.batch_files(spark, root)
    zipped = F.posexplode(F.arrays_zip(F.col("task1_raw_ocr").alias("t1"), F.col("task4_markdown").alias("t4"))).alias("k", "z")
    return read.select("video_id", "batch_file", zipped, F.col("task5_summary").alias("t5")).select("video_id", "batch_file", "k", "z.t1", "z.t4", "t5")


@query("frames_written", "WITH f AS (SELECT conv_id, turn, CAST(round_even(turn / 2.0, 0) AS INT) AS second FROM conversations WHERE turn % 3 <> 1), l AS (SELECT conv_id, second, max(turn) AS turn FROM f GROUP BY ALL) SELECT CAST(conv_id AS VARCHAR) AS video_id, printf('frame_%06d.jpg', second) AS frame_name, 'f' || turn AS content FROM l")
def frames_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of two frames a second, of which some are empty: frames named by second, the last of each second written and read back."""
    item = F.struct("frame_idx", F.when(F.col("frame_idx") % 3 == 1, F.lit("")).otherwise(F.concat(F.lit("f"), F.col("frame_idx").cast("string"))).alias("f"))
    videos = inputs.frames(spark, sf_dir).groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["f"]), "\n").alias("body"))
    rated = videos.select("video_id", F.concat(F.lit("2\n"), "body").cast("binary").alias("content"))
    root = f"{_scratch(spark)}/frames"
    sinks.write_frames(engines.last_of_names(engines.decode(rated, engines.line_decoder, 0.0)), root)
    return trees.written_frames(spark, root).withColumn("content", F.col("content").cast("string"))


@query("frames_resized", "SELECT CAST(p_partkey AS VARCHAR) AS video_id, CASE WHEN greatest(p_size * 37, p_size * 23 + 400) <= 700 THEN p_size * 37 || 'x' || (p_size * 23 + 400) ELSE CAST(trunc(p_size * 37 * (700.0::DOUBLE / greatest(p_size * 37, p_size * 23 + 400))) AS INT) || 'x' || CAST(trunc((p_size * 23 + 400) * (700.0::DOUBLE / greatest(p_size * 37, p_size * 23 + 400))) AS INT) END || '|x' AS content FROM part")
def frames_resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of one frame, scaled down so that no side is over 700."""
    size = F.concat((F.col("p_size") * 37).cast("string"), F.lit("x"), (F.col("p_size") * 23 + 400).cast("string"))
    videos = spread(table(spark, sf_dir, "part")).select(F.col("p_partkey").cast("string").alias("video_id"), F.concat(F.lit("25\n"), size, F.lit("|x")).cast("binary").alias("content"))
    return engines.decode(videos, engines.line_decoder, 1.0, 700).select("video_id", F.col("content").cast("string").alias("content"))


@query("blank_text_not_sent", "SELECT doc_id, doc_id % 3 = 0 AS skipped, CASE WHEN doc_id % 3 = 0 THEN 0 END AS tokens FROM documents")
def blank_text_not_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model is not asked about blank texts: the answer is empty and costs nothing."""
    blank = F.when(F.col("doc_id") % 3 == 0, F.lit(" \n ")).otherwise(F.lit("--- Frame 0 ---\ntext"))
    asked = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"), F.lit(0).alias("batch"), blank.alias("batch_text"))
    got = engines.call_model(asked, "p", engines.echo_model)
    skipped = F.col("response") == ""
    return got.select(F.col("video_id").cast("long").alias("doc_id"), skipped.alias("skipped"), F.when(skipped, (F.col("input_tokens") + F.col("output_tokens")).cast("int")).alias("tokens"))


@query("image_batches_sent", f"WITH {inputs.FRAMES_SQL}, f AS (SELECT video_id, CAST(frame_idx // 3 AS INT) AS batch, frame_idx, CAST(video_id AS BIGINT) % 5 = 1 AND frame_idx = 1 AS gone, frame_idx % 4 = 3 AS other FROM frames), b AS (SELECT video_id, batch, min(frame_idx) FILTER (gone) AS missing, count(*) FILTER (NOT other) AS images FROM f GROUP BY ALL) SELECT video_id, batch, CASE WHEN missing IS NULL AND images > 0 THEN images || ' images' END AS summary, CASE WHEN missing IS NOT NULL THEN 'no file ' || printf('frame_%06d.png', missing) WHEN images = 0 THEN 'no images' END AS error FROM b")
def image_batches_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of image files sent in order as bytes: a missing file fails its batch, files that are no images are left out."""
    extension = F.when(F.col("frame_idx") % 4 == 3, F.lit(".txt")).otherwise(F.lit(".png"))
    files = inputs.frames(spark, sf_dir).withColumn("frame_name", F.concat(F.format_string("frame_%06d", "frame_idx"), extension))
    there = files.filter("not (cast(video_id as bigint) % 5 = 1 and frame_idx = 1)").select("video_id", "frame_name", F.col("raw_text").cast("binary").alias("content"))
    called = engines.call_image_model(engines.with_images(batching.image_batches(files, 3), there), "Look.", engines.caption_model)
    return called.select("video_id", "batch", parse.image_response(F.col("response"))["task5_summary"].alias("summary"), "error")


@query("frame_numbers_bounded", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a frame number is ' || (100000 + doc_id * 1000) END AS error, doc_id % 2 = 0 AS failed FROM documents")
def frame_numbers_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of which every second names a frame that no batch has: they fail, and no list of that length is made."""
    number = F.when(F.col("doc_id") % 2 == 0, 100_000 + F.col("doc_id") * 1000).otherwise(F.col("doc_id") % 50)
    response = F.concat(F.lit("==== TASK 1: X ====\n-- Frame "), number.cast("string"), F.lit(" --\ntext"))
    return table(spark, sf_dir, "documents").select("doc_id", parse.too_many_frames(response).alias("error"), parse.image_response(response).isNull().alias("failed"))
