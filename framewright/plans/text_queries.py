"""Queries of the text layer: cleaning, splitting, noise, parsing, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions import augment, parse, refs, text
from framewright.operators.assemble import resolve_rows
from framewright.plans import inputs, noise_sql
from framewright.plans.catalogue import query, table

SEED = noise_sql.SEED


def clean_sql(t: str) -> str:
    """Cleaning in SQL."""
    lines = f"string_split(regexp_replace(coalesce({t}, ''), '\\r\\n?', chr(10), 'g'), chr(10))"
    kept = f"list_filter(list_transform({lines}, lambda s: trim(s, ' ' || chr(9) || chr(11) || chr(12) || chr(13))), lambda s: s <> '')"
    return f"array_to_string(list_transform({kept}, lambda s: regexp_replace(s, '[ \\t]+', ' ', 'g')), chr(10))"


@query("clean_ocr_text", f"SELECT doc_id, {clean_sql('text')} AS clean FROM documents")
def clean_ocr_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_ocr(F.col("text")).alias("clean"))


@query("clean_ocr_text_noisy", f"WITH {inputs.NOISY_SQL} SELECT doc_id, {clean_sql('t')} AS clean FROM noisy")
def clean_ocr_text_noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.noisy(spark, sf_dir).select("doc_id", text.clean_ocr(F.col("t")).alias("clean"))


@query("sentence_split", f"SELECT doc_id, len(s) AS n, array_to_string(s, '|') AS sentences FROM (SELECT doc_id, {noise_sql.SENTENCES} AS s FROM documents)")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return split.select("doc_id", F.size("s").cast("long").alias("n"), F.array_join("s", "|").alias("sentences"))


@query("word_split", f"SELECT doc_id, len(w) AS n, array_to_string(w, '|') AS words FROM (SELECT doc_id, {noise_sql.WORDS.format(t='text')} AS w FROM documents)")
def word_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = table(spark, sf_dir, "documents").select("doc_id", text.words(F.col("text")).alias("w"))
    return split.select("doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", "|").alias("words"))


def noise() -> augment.Noise:
    return augment.Noise(SEED, F.col("doc_id"))


def noised(spark: SparkSession, sf_dir: str, f) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", f(noise(), F.col("text")).alias("text"))


@query("aug_delete_sentences", noise_sql.step("ds", (0.3,), "ds", "documents"))
def aug_delete_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.delete_sentences(t, 0.3))


@query("aug_delete_words", noise_sql.step("dw", (0.15,), "dw", "documents"))
def aug_delete_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.delete_words(t, 0.15))


@query("aug_duplicate_lines", noise_sql.step("dl", (0.3, 3), "dl", "documents"))
def aug_duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.duplicate_lines(t, 0.3, 3))


@query("aug_merge_lines", noise_sql.step("ml", (0.3,), "ml", "documents"))
def aug_merge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.merge_lines(t, 0.3))


@query("aug_split_lines", noise_sql.step("sl", (0.4,), "sl", "documents"))
def aug_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.split_lines(t, 0.4))


@query("aug_char_noise", noise_sql.step("ch", (0.1,), "ch", "documents"))
def aug_char_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.character_noise(t, 0.1))


@query("aug_whitespace_noise", noise_sql.step("ws", (0.1, 0.2), "ws", "(SELECT doc_id, replace(text, '. ', '.  ') AS text FROM documents)"))
def aug_whitespace_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.whitespace_noise(F.replace(t, F.lit(". "), F.lit(".  ")), 0.1, 0.2))


@query("aug_partial_lines_start", noise_sql.step("ps", (0.5, 2, 3, 1), "dp", "documents"))
def aug_partial_lines_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.partial_lines(t, 0.5, "words_start", 2, 3))


@query("aug_partial_lines_end", noise_sql.step("pe", (0.5, 2, 3, 2), "dp", "documents"))
def aug_partial_lines_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.partial_lines(t, 0.5, "words_end", 2, 3, 2))


@query("aug_partial_lines_ratio", noise_sql.step("pr", (0.5, 0.2, 0.6, 2), "dp", "documents"))
def aug_partial_lines_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noised(spark, sf_dir, lambda n, t: n.partial_lines(t, 0.5, "random_ratio", 0.2, 0.6, 2))


def _profile_query(k: int, name: str) -> None:
    @query(f"profile_{k:02d}_{name}", noise_sql.profile(name))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "documents").select("doc_id", augment.profile(F.col("text"), F.col("doc_id"), name, SEED).alias("text"))


for _k, _name in enumerate(augment.PROFILES, 1):
    _profile_query(_k, _name)


_CHOICE, _CHOSEN = noise_sql.choice("keyed")


@query("profile_choice", f"WITH {inputs.FRAMES_SQL}, keyed AS (SELECT video_id || '/' || frame_name AS doc_id, raw_text AS text FROM frames), {', '.join(_CHOICE)} SELECT split_part(doc_id, '/', 1) AS video_id, split_part(doc_id, '/', 2) AS frame_name, text FROM {_CHOSEN}")
def profile_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = inputs.frames(spark, sf_dir)
    key = F.concat_ws("/", "video_id", "frame_name")
    return conv.select("video_id", "frame_name", augment.profile_choice(F.col("raw_text"), key, SEED).alias("text"))


@query("profile_chosen", f"WITH {inputs.FRAMES_SQL} SELECT video_id, frame_name, {noise_sql.chosen('key')} AS profile FROM (SELECT *, video_id || '/' || frame_name AS key FROM frames)")
def profile_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = inputs.frames(spark, sf_dir)
    return conv.select("video_id", "frame_name", augment.chosen_profile(F.concat_ws("/", "video_id", "frame_name"), SEED, 10).alias("profile"))


def _blocks(df: DataFrame) -> DataFrame:
    """A video's frames as the frame blocks of a response."""
    item = F.struct("frame_idx", F.concat(F.lit("-- Frame "), F.col("frame_idx").cast("string"), F.lit(" --\n"), F.col("raw_text")).alias("block"))
    return df.groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["block"]), "\n").alias("b"))


@query(
    "parse_text_response",
    f"WITH {inputs.FRAMES_SQL} SELECT video_id, string_agg(trim(raw_text, ' ' || chr(10)), '|' ORDER BY frame_idx) AS task3, string_agg(trim(raw_text, ' ' || chr(10)), '|' ORDER BY frame_idx) AS task4, 'about ' || video_id AS summary FROM frames GROUP BY video_id",
)
def parse_text_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.concat(F.lit(parse.TASK3 + "\n"), "b", F.lit("\n" + parse.TASK4 + "\n"), "b", F.lit("\n" + parse.TASK5 + "\n"), F.lit("about "), "video_id")
    parsed = _blocks(inputs.frames(spark, sf_dir)).select("video_id", parse.text_response(whole).alias("p"))
    return parsed.select("video_id", F.array_join("p.task3_cleaned_text", "|").alias("task3"), F.array_join("p.task4_markdown_text", "|").alias("task4"), F.col("p.task5_summary").alias("summary"))


@query(
    "parse_text_response_missing_headers",
    f"""WITH {inputs.FRAMES_SQL}, f AS (SELECT video_id, string_agg(trim(raw_text, ' ' || chr(10)), '|' ORDER BY frame_idx) AS t FROM frames GROUP BY video_id)
    SELECT video_id, CASE WHEN CAST(video_id AS BIGINT) % 3 = 0 THEN t WHEN CAST(video_id AS BIGINT) % 3 = 1 THEN '' END AS task3,
      CASE WHEN CAST(video_id AS BIGINT) % 3 = 0 THEN '' WHEN CAST(video_id AS BIGINT) % 3 = 1 THEN t END AS task4, CAST(video_id AS BIGINT) % 3 = 2 AS nothing FROM f""",
)
def parse_text_response_missing_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("video_id").cast("long") % 3
    header = F.when(kind == 0, parse.TASK3 + "\n").when(kind == 1, parse.TASK4 + "\n").otherwise("no header\n")
    parsed = _blocks(inputs.frames(spark, sf_dir)).select("video_id", parse.text_response(F.concat(header, "b")).alias("p"))
    return parsed.select("video_id", F.array_join("p.task3_cleaned_text", "|").alias("task3"), F.array_join("p.task4_markdown_text", "|").alias("task4"), F.col("p").isNull().alias("nothing"))


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of which every fourth is missing and every third repeats the one before."""
    df = inputs.frames(spark, sf_dir).filter("frame_idx % 4 <> 3")
    return df.withColumn("raw_text", F.when(F.col("frame_idx") % 3 == 2, F.lit(parse.SAME)).otherwise(F.col("raw_text")))


#: The same frames in SQL, gaps filled with '', marks with the last frame that is no mark.
GAPPY_SQL = f"""{inputs.FRAMES_SQL},
top AS (SELECT video_id, max(frame_idx) AS m FROM frames WHERE frame_idx % 4 <> 3 GROUP BY video_id),
dense AS (SELECT f.video_id, f.frame_idx, CASE WHEN f.frame_idx % 4 = 3 THEN '' WHEN f.frame_idx % 3 = 2 THEN NULL ELSE trim(raw_text, ' ' || chr(10)) END AS c
  FROM frames f JOIN top USING (video_id) WHERE f.frame_idx <= m),
filled AS (SELECT video_id, frame_idx, coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY frame_idx), '') AS c FROM dense)"""


@query("parse_image_response_v5", f"WITH {GAPPY_SQL}, l AS (SELECT video_id, string_agg(c, '|' ORDER BY frame_idx) AS t FROM filled GROUP BY video_id) SELECT video_id, t AS task1, '' AS task2, t AS task3, t AS task4, 'about ' || video_id AS summary FROM l")
def parse_image_response_v5(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = [F.lit(f"\n==== Task {k}: X ====\n") for k in (1, 2, 3, 4, 5)]
    whole = F.concat(headers[0], "b", headers[1], F.lit("no frames"), headers[2], "b", headers[3], "b", headers[4], F.lit("about "), "video_id")
    parsed = _blocks(_gappy(spark, sf_dir)).select("video_id", parse.image_response(whole, "v5").alias("p"))
    lists = {f"task{k}": F.array_join(f"p.{key}", "|") for k, key in enumerate(parse.LAYOUTS["v5"][:-1], 1)}
    return parsed.select("video_id", *[c.alias(n) for n, c in lists.items()], F.col("p.task5_summary").alias("summary"))


@query("parse_image_response_v3", f"WITH {GAPPY_SQL}, l AS (SELECT video_id, string_agg(c, '|' ORDER BY frame_idx) AS t FROM filled GROUP BY video_id) SELECT video_id, t AS cleaned, t AS markdown, 'about ' || video_id AS summary FROM l")
def parse_image_response_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = [F.lit(f"\n==== TASK {k}: X ====\n") for k in (1, 2, 3)]
    whole = F.concat(headers[0], "b", headers[1], "b", headers[2], F.lit("about "), "video_id")
    parsed = _blocks(_gappy(spark, sf_dir)).select("video_id", parse.image_response(whole, "v3").alias("p"))
    first, second, third = (F.col(f"p.{k}") for k in parse.LAYOUTS["v3"])
    return parsed.select("video_id", F.array_join(first, "|").alias("cleaned"), F.array_join(second, "|").alias("markdown"), third.alias("summary"))


@query("same_as_previous_fill", f"WITH {GAPPY_SQL} SELECT video_id, frame_idx, c AS text FROM filled")
def same_as_previous_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filling over rows instead of lists: gaps by a join with all numbers, marks by the last frame that is no mark."""
    df = _gappy(spark, sf_dir)
    return densified(df).withColumn(
        "text", F.coalesce(F.last(F.nullif("c", F.lit(parse.SAME)), ignorenulls=True).over(Window.partitionBy("video_id").orderBy("frame_idx")), F.lit(""))
    ).select("video_id", "frame_idx", "text")


def densified(df: DataFrame) -> DataFrame:
    """All numbers from 0 to a video's largest, '' where a frame is missing."""
    every = df.groupBy("video_id").agg(F.max("frame_idx").alias("m")).select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), "m")).alias("frame_idx"))
    return every.join(df.select("video_id", "frame_idx", text.strip(F.col("raw_text")).alias("c")), ["video_id", "frame_idx"], "left").withColumn("c", F.coalesce("c", F.lit("")))


@query("densify_frames", f"WITH {GAPPY_SQL} SELECT video_id, frame_idx, coalesce(c, '{parse.SAME}') AS c FROM dense")
def densify_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densified(_gappy(spark, sf_dir)).select("video_id", "frame_idx", "c")


RESOLVED_SQL = f"WITH RECURSIVE {inputs.REFS_SQL}, {inputs.RESOLVE_SQL}"


@query("ref_resolve", f"{RESOLVED_SQL} SELECT conv_id, turn, text FROM resolved")
def ref_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_rows(inputs.refs(spark, sf_dir), ["raw"], "conv_id", "turn").select("conv_id", "turn", F.col("raw").alias("text"))


@query("ref_invalid_forward", f"WITH {inputs.REFS_SQL} SELECT conv_id, turn, raw AS text FROM parsed WHERE ref >= turn")
def ref_invalid_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to the text itself or a later one stay as they are."""
    solved = ref_resolve(spark, sf_dir).join(inputs.refs(spark, sf_dir), ["conv_id", "turn"])
    return solved.filter(refs.reference(F.col("raw")) >= F.col("turn")).select("conv_id", "turn", "text")


@query("ref_resolve_chain", "SELECT c.conv_id, c.turn, f.text || coalesce(array_to_string(list_transform(range(1, c.turn + 1), lambda k: ' ' || CAST(k AS VARCHAR) || '.'), ''), '') AS text FROM conversations c JOIN conversations f ON f.conv_id = c.conv_id AND f.turn = 0")
def ref_resolve_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text refers to the one before."""
    raw = F.when(F.col("turn") == 0, F.col("text")).otherwise(F.concat(F.lit("F:"), (F.col("turn") - 1).cast("string"), F.lit(" "), F.col("turn").cast("string"), F.lit(".")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("text"))
    return resolve_rows(rows, ["text"], "conv_id", "turn").select("conv_id", "turn", "text")


def _growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of which every second one begins with the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    conv = table(spark, sf_dir, "conversations")
    grown = F.when(F.col("turn") % 2 == 1, F.concat(F.lag("text").over(order), F.lit("\n"), F.col("text"))).otherwise(F.col("text"))
    return conv.select("conv_id", "turn", grown.alias("text")).withColumn("before", F.lag("text").over(order))


@query("ref_encode", "SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN 'F:' || CAST(turn - 1 AS VARCHAR) || chr(10) || text ELSE text END AS code FROM conversations")
def ref_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growing(spark, sf_dir).select("conv_id", "turn", refs.encode_refs(F.col("text"), F.col("before"), F.col("turn")).alias("code"))


@query("ref_roundtrip", "SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN lag(text) OVER (PARTITION BY conv_id ORDER BY turn) || chr(10) || text ELSE text END AS text FROM conversations")
def ref_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ref_encode(spark, sf_dir)
    return resolve_rows(coded, ["code"], "conv_id", "turn").select("conv_id", "turn", F.col("code").alias("text"))
