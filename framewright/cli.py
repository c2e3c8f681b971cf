"""Command line: one sub-command per stage, each calling the operators of this package.

    python -m framewright.cli export --frames DIR --batches DIR --ocr DIR --out DIR [--aux DIR] [--mode cleaning_pairs] ...
"""

from __future__ import annotations

import argparse
import importlib
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import cost, parse
from framewright.functions.frames import frame_number
from framewright.operators import assemble, batching, engines, ledger
from framewright.operators.engines import Sampling
from framewright.session import arrow_rows, session
from framewright.sources import sinks, trees
from framewright.streaming import daemon


def engine(name: str) -> Callable:
    """An engine factory by ``module:attribute``; those of this package have short names."""
    known = {
        "echo": engines.echo_model,
        "captions": engines.caption_model,
        "bytes": engines.byte_ocr,
        "lines": engines.line_decoder,
        "tesseract": engines.tesseract,
        "genai-text": engines.genai_text,
        "genai-images": engines.genai_images,
    }
    if name in known:
        return known[name]
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="framewright")
    commands = top.add_subparsers(dest="command", required=True)

    def stage(name: str, help_: str, default_engine: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=help_)
        p.add_argument("--input", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--ledger", required=True)
        p.add_argument("--engine", default=default_engine)
        p.add_argument("--start", type=int)
        p.add_argument("--end", type=int)
        p.add_argument("--dry-run", action="store_true")
        p.add_argument("--watch", metavar="INTERVAL", help="poll, e.g. '300 seconds'; without it one pass is made")
        return p

    frames = stage("frames", "videos to frames", "lines")
    frames.add_argument("--fps", type=float, default=1.0)
    frames.add_argument("--max-dimension", type=int, default=1024)
    frames.add_argument("--max-frames", type=int)
    frames.add_argument("--seed", type=int, default=0)
    ocr = stage("ocr", "frames to texts", "bytes")
    ocr.add_argument("--frames-table", action="store_true", help="--input is the table of frames that the frames stage writes")
    ocr.add_argument("--language", default="eng")
    for name, help_, default in (("text-model", "texts to cleaned texts, markdown and summary", "echo"), ("image-model", "frames to the same", "captions")):
        p = stage(name, help_, default)
        p.add_argument("--temperature", type=float, default=Sampling.temperature)
        p.add_argument("--top-p", type=float, default=Sampling.top_p)
        p.add_argument("--max-output-tokens", type=int, default=Sampling.max_output_tokens if name == "text-model" else 65_535)
        p.add_argument("--frame-texts", action="store_true", help="--input has a .txt file per frame instead of a JSON document per video")
        p.add_argument("--prompt", required=True)
        p.add_argument("--model", default="gemini-2.5-pro-preview-05-06")
        p.add_argument("--batch-size", type=int, default=batching.BATCH_SIZE)
        p.add_argument("--layout", choices=sorted(parse.LAYOUTS), default="v5")
    export = commands.add_parser("export", help="samples as JSON Lines")
    for name in ("frames", "batches", "ocr", "out"):
        export.add_argument(f"--{name}", required=True)
    export.add_argument("--text-batches", action="store_true", help="--batches has what text-model writes")
    export.add_argument("--aux")
    export.add_argument("--mode", choices=("standard", "cleaning_pairs"), default="standard")
    export.add_argument("--video-ids", help="separated by commas")
    export.add_argument("--seed", type=int, default=0)
    stats = commands.add_parser("cost-stats", help="statistics of the costs in all JSON documents below a directory")
    stats.add_argument("--input", required=True)
    return top


def _work(spark: SparkSession, a: argparse.Namespace) -> daemon.Work:
    """What a stage does with pending directories: write this pass's results and return an outcome per directory.

    A pass writes its results under a name of its own, and what it reports is read from there alone: no engine is called twice,
    and a directory that failed before is judged by what it does now. Documents and frames replace those of the same name.
    """
    model_of = Sampling(a.model, a.temperature, a.top_p, a.max_output_tokens) if a.command.endswith("-model") else None

    def outcome(todo: DataFrame, totals: DataFrame, note: Column | None = None) -> DataFrame:
        """``totals``: of ``ledger.directory_totals``. A directory without any result had nothing to work on."""
        items = F.coalesce("frames_ok", F.lit(0))
        success = F.concat(F.lit("Success ("), items.cast("string"), F.lit(")"), F.lit("") if note is None else note)
        failed = F.concat(F.lit("Failed ("), F.col("batches_ok").cast("string"), F.lit(" of "), F.col("batches").cast("string"), F.lit(")"))
        status = F.when(F.col("batches").isNull(), F.lit("No frame_*.png or frame_*.jpg")).when(F.col("success"), success).otherwise(failed)
        done = totals.withColumnRenamed("video_id", "rel_path")
        return todo.join(done, "rel_path", "left").select("rel_path", status.alias("status"), items.alias("n_items"), F.coalesce("cost_ok", F.lit(0.0)).alias("cost_usd"))

    def written(df: DataFrame) -> DataFrame:
        path = f"{a.out}/results/pass-{uuid.uuid4().hex}"
        with arrow_rows(spark, 256):
            df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def pick(df: DataFrame, todo: DataFrame) -> DataFrame:
        return df.join(todo.select(F.col("rel_path").alias("video_id")), "video_id", "left_semi")

    def counted(rows: DataFrame) -> DataFrame:
        """Totals of results with a row per frame: all of a directory's frames are one success."""
        frames = rows.groupBy("video_id").agg(F.count(F.lit(1)).alias("num_frames"))
        return ledger.directory_totals(frames.withColumns({"ok": F.lit(True), "cost_usd": F.lit(0.0)}))

    def frames(todo: DataFrame) -> DataFrame:
        listed = pick(trees.files(spark, a.input), todo)
        best = trees.pick_video(listed).withColumnRenamed("video_file", "frame_name")
        videos = trees.contents(spark, a.input).join(best, ["video_id", "frame_name"])
        decoded = engines.decode(videos, engine(a.engine), a.fps, a.max_dimension)
        if a.max_frames:
            decoded = engines.sample_frames(decoded, a.max_frames, a.seed)
        made = written(decoded)
        sinks.write_frames(engines.last_of_names(made), f"{a.out}/frames")
        side = trees.pick_metadata(listed).withColumnRenamed("metadata_file", "file_name")
        texts = spark.read.option("pathGlobFilter", "*.info.json").text(f"{a.input}/*", wholetext=True)
        path = trees.file_path()
        found = texts.select(trees.video_of(path).alias("video_id"), trees.name_of(path).alias("file_name"), "value").join(side, ["video_id", "file_name"])
        sinks.write_documents(found, f"{a.out}/metadata")
        copied = found.select("video_id").distinct().withColumn("copied", F.lit(True))
        with_notes = counted(made).join(copied, "video_id", "left")
        return outcome(todo, with_notes, sinks.copy_note(F.coalesce("copied", F.lit(False))))

    def ocr(todo: DataFrame) -> DataFrame:
        if a.frames_table:
            read = trees.written_frames(spark, a.input)
        else:
            chosen = assemble.png_else_jpg(trees.files(spark, a.input).select("video_id", F.col("name").alias("frame_name")))
            read = trees.contents(spark, a.input).join(chosen, ["video_id", "frame_name"])
        made = written(engines.ocr(pick(read, todo), engine(a.engine), a.language))
        sinks.write_documents(sinks.ocr_document(made).withColumn("file_name", F.lit("tesseract_ocr.json")), f"{a.out}/documents")
        return outcome(todo, counted(made))

    def answered(made: DataFrame, called: DataFrame, parsed: Column, error: Column, document: Callable[[DataFrame], DataFrame], wide: list[str], todo: DataFrame) -> DataFrame:
        """Write the answers to batches, then the documents of the parsed ones; both of this pass only."""
        answers = written(called.withColumns({"parsed": parsed, "unusable": error, "model": F.lit(a.model), "ts": F.current_timestamp()}))
        rows = made.drop(*wide).join(cost.with_cost(answers), ["video_id", "batch"]).withColumns({"ok": F.col("parsed").isNotNull(), "seconds": F.lit(None).cast("double")})
        sinks.write_documents(document(rows.filter("ok")), f"{a.out}/documents")
        return outcome(todo, ledger.directory_totals(rows))

    def text_model(todo: DataFrame) -> DataFrame:
        texts = trees.frame_texts(spark, a.input) if a.frame_texts else trees.ocr_texts(spark, a.input)
        numbered = pick(texts, todo).withColumn("frame_idx", frame_number(F.col("frame_name"))).filter("frame_idx is not null")
        made = batching.batches(numbered, a.batch_size)
        called = engines.call_model(made, trees.prompt(spark, a.prompt), engine(a.engine), model_of)
        return answered(made, called, parse.text_response(F.col("response")), F.lit(None).cast("string"), sinks.text_batch_document, ["batch_text"], todo)

    def image_model(todo: DataFrame) -> DataFrame:
        listed = pick(trees.files(spark, a.input).select("video_id", F.col("name").alias("frame_name")), todo)
        chosen = assemble.png_else_jpg(listed).withColumn("frame_idx", frame_number(F.col("frame_name"))).filter("frame_idx is not null")
        made = batching.image_batches(chosen, a.batch_size)
        with arrow_rows(spark, 1):
            called = engines.call_image_model(engines.with_images(made, trees.contents(spark, a.input)), trees.prompt(spark, a.prompt), engine(a.engine), model_of)
            response = F.col("response")
            return answered(made, called, parse.image_response(response, a.layout), parse.too_many_frames(response), sinks.image_batch_document, ["frame_names"], todo)

    return {"frames": frames, "ocr": ocr, "text-model": text_model, "image-model": image_model}[a.command]


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    a = parser().parse_args(argv)
    spark = spark or session("framewright-" + a.command)
    if a.command == "cost-stats":
        docs = trees.json_documents(spark, a.input)
        report = sinks.stats_report(cost.cost_stats(docs.select(cost.document_cost(F.col("value")).alias("cost_usd"))))
        report.show(truncate=False)
        return report
    if a.command == "export":
        frames = trees.frame_files(spark, a.frames)
        if a.video_ids:
            wanted = ledger.requested(frames.select("video_id").distinct(), [v for v in a.video_ids.split(",") if v])
            frames = frames.join(wanted.distinct(), "video_id", "left_semi")
        batches = trees.text_batches(spark, a.batches) if a.text_batches else trees.batch_files(spark, a.batches)
        made = assemble.samples(frames, batches, trees.ocr_texts(spark, a.ocr), trees.aux_files(spark, a.aux) if a.aux else None, a.seed)
        sinks.write_export(made, a.out, a.mode)
        return made
    if a.engine == "tesseract" and not engines.tesseract_installed():
        raise SystemExit(f"there is no OCR program {engines.ocr_command()}; install it or set TESSERACT_CMD")
    if a.command == "ocr" and a.frames_table:
        listing = lambda: trees.written_frames(spark, a.input).select(F.col("video_id").alias("rel_path")).distinct()
    else:
        listing = lambda: trees.subdirectories(spark, a.input)
    strict = a.command == "frames"
    if a.watch:
        since = datetime.now(timezone.utc)
        query = daemon.watch(daemon.ticks(spark), listing, a.ledger, f"{a.out}/state", a.command, _work(spark, a), a.watch, a.start, a.end, not strict, a.dry_run)
        return daemon.until_stopped(query, spark, a.ledger, a.command, since)
    return daemon.run_pass(listing(), a.ledger, a.command, _work(spark, a), a.start, a.end, clamp=not strict, dry_run=a.dry_run)


if __name__ == "__main__":
    main()
