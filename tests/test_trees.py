"""File trees, assembly with every skip rule, engines, daemon and command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from framewright import cli
from framewright.functions import text
from framewright.operators import assemble, batching, engines, ledger
from framewright.sources import sinks, trees
from framewright.streaming import daemon


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(value, bytes):
        path.write_bytes(value)
    else:
        path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8")


def batch(texts, **change):
    doc = {"task1_raw_ocr": texts, "task2_augmented": texts, "task3_cleaned": [f"c {t}" for t in texts], "task4_markdown": [f"# {t}" for t in texts], "task5_summary": "s"} | change
    return {k: v for k, v in doc.items() if v != "gone"}


@pytest.fixture
def tree(tmp_path):
    frames, ocr, llm, aux = (tmp_path / n for n in ("frames", "ocr", "llm", "aux"))
    for video, n in (("v1", 7), ("v2", 12), ("no_llm", 3), ("no_ocr", 3), ("bad_ocr", 3), ("no_batch", 3), ("all_bad", 3)):
        for k in range(n):
            put(frames / video / f"frame_{k:06d}.png", b"x")
        put(ocr / video / "tesseract_ocr.json", {f"frame_{k:06d}.png": f" ocr  {k} " for k in range(n)})
        for b in range(0, n, 3):
            put(llm / video / f"llm_output_batch_{b // 3:04d}.json", batch([f"t{k}" for k in range(b, min(n, b + 3))]))
    for f in (llm / "no_llm").iterdir():
        f.unlink()
    (llm / "no_llm").rmdir()
    (ocr / "no_ocr" / "tesseract_ocr.json").unlink()
    put(ocr / "bad_ocr" / "tesseract_ocr.json", "{broken")
    (llm / "no_batch" / "llm_output_batch_0000.json").unlink()
    put(llm / "all_bad" / "llm_output_batch_0000.json", batch([]))
    put(frames / "empty" / ".keep", "")
    put(frames / "v1" / "notes.txt", "x")
    v2 = ocr / "v2" / "tesseract_ocr.json"
    texts = json.loads(v2.read_text())
    texts["frame_000003.jpg"] = texts.pop("frame_000003.png")
    del texts["frame_000004.png"]
    texts["frame_000005.png"] = ""
    put(v2, texts)
    for name in ("a.mp4", "b.webm", "x.info.json", "x_fr.vtt", "x_en.srt"):
        put(aux / "v1" / name, "x")
    return tmp_path


def samples(spark, tree, **more):
    return assemble.samples(
        trees.frame_files(spark, f"{tree}/frames"), trees.batch_files(spark, f"{tree}/llm"), trees.ocr_texts(spark, f"{tree}/ocr"), trees.aux_files(spark, f"{tree}/aux"), **more
    )


def test_samples(spark, tree):
    rows = samples(spark, tree, profiles=[]).orderBy("video_id", "frame_stem").collect()
    assert {r.video_id for r in rows} == {"v1", "v2"}
    v1, v2 = ([r for r in rows if r.video_id == v] for v in ("v1", "v2"))
    assert [r.llm_clean_ocr for r in v1] == [f"c t{k}" for k in range(7)]
    assert [r.tesseract_ocr for r in v1] == [f"ocr {k}" for k in range(7)]
    assert v1[0].metadata_filepath.endswith("x.info.json") and [p[-8:] for p in v1[0].subtitle_filepaths] == ["x_en.srt", "x_fr.vtt"]
    assert [r.frame_stem[-1] for r in v2] == list("012356789") + ["0", "1"]
    assert (v2[3].tesseract_ocr, v2[4].tesseract_ocr) == ("ocr 3", "") and v2[0].subtitle_filepaths == [] and v2[0].metadata_filepath is None
    noisy = samples(spark, tree, seed=3).filter("augmented_llm_clean_ocr is null").count()
    assert noisy == 0


BROKEN = {
    "no_json": "{",
    "empty": batch([]),
    "no_summary": batch(["a"], task5_summary="gone"),
    "short": batch(["a", "b"], task3_cleaned=["a"]),
    "none_of_task2": batch(["a"], task2_augmented="gone"),
    "text_task4": batch(["a"], task4_markdown="a"),
}
GOOD = {
    "plain": batch(["a"]),
    "null_summary": batch(["a"], task5_summary=None),
    "other_task2": batch(["a"], task2_augmented="gone", task2_augmented_imperfections=["z"]),
    "empty_task2": batch(["a"], task2_augmented=[], task2_augmented_imperfections=["z"]),
}


def test_batch_rules(spark, tmp_path):
    for name, value in (BROKEN | GOOD).items():
        put(tmp_path / name / "llm_output_batch_0000.json", value)
    parsed = trees.batch_files(spark, str(tmp_path))
    assert {r.video_id for r in parsed.filter(assemble.is_valid(F.col("has_summary"))).collect()} == set(GOOD)
    assert {r.video_id for r in assemble.batch_rows(parsed).collect()} == set(GOOD)


def test_scopes_of_references(spark):
    frames = spark.createDataFrame([("v", f"frame_{k}.png", "p") for k in range(4)], "video_id string, frame_name string, frame_path string")
    made = [("v", "b0", ["a", "F:0"]), ("v", "b1", ["c", "F:0 x"])]
    batches = spark.createDataFrame([(v, b, t, t, None, t, t, "s") for v, b, t in made], f"video_id string, batch_file string, {assemble.BATCH_SCHEMA}")
    ocr = spark.createDataFrame([("v", f"frame_{k}.png", "o") for k in range(4)], "video_id string, frame_name string, raw_text string")
    clean = lambda scope: [r.llm_clean_ocr for r in assemble.samples(frames, batches, ocr, profiles=[], ref_scope=scope).orderBy("frame_stem").collect()]
    assert clean("video") == ["a", "a", "c", "a x"]
    assert clean("batch") == ["a", "a", "c", "c x"]


def test_alignment_by_batch_number(spark):
    made = [("v", "llm_output_batch_0000.json", ["a", "b"]), ("v", "llm_output_batch_0001.json", []), ("v", "llm_output_batch_0002.json", ["e", "f"])]
    batches = spark.createDataFrame([(v, b, t, t, None, t, t, "s") for v, b, t in made], f"video_id string, batch_file string, {assemble.BATCH_SCHEMA}")
    places = lambda *a: [(r.pos, r.t3) for r in assemble.batch_rows(batches, *a).orderBy("pos").collect()]
    assert places() == [(0, "a"), (1, "b"), (2, "e"), (3, "f")]
    assert places("batch_offset", 2) == [(0, "a"), (1, "b"), (4, "e"), (5, "f")]
    with pytest.raises(ValueError, match="unknown alignment"):
        assemble.batch_rows(batches, "other")


def test_names_with_odd_characters(spark, tmp_path):
    put(tmp_path / "a b+c%" / "tesseract_ocr.json", {"frame_000001.png": "é\nü"})
    assert [tuple(r) for r in trees.ocr_texts(spark, str(tmp_path)).collect()] == [("a b+c%", "frame_000001.png", "é\nü")]
    sinks.write_documents(spark.createDataFrame([("a b+c%", "batch_1.json", "{}")], "video_id string, file_name string, value string"), f"{tmp_path}/out")
    assert [tuple(r) for r in trees.documents(spark, f"{tmp_path}/out", "batch_*.json").collect()] == [("a b+c%", "batch_1.json", "{}")]


def test_text_files_as_frames(spark, tmp_path):
    put(tmp_path / "v" / "frame_000001.txt", "one\ntwo")
    assert [tuple(r) for r in trees.frame_texts(spark, str(tmp_path)).collect()] == [("v", "frame_000001.png", "one\ntwo")]


def test_batches(spark):
    df = spark.createDataFrame([("v", k, f"frame_{k}.png", t) for k, t in zip((0, 1, 2, 5, 8, 9, 10), "abc d\ne", strict=True)], "video_id string, frame_idx long, frame_name string, raw_text string")
    rows = batching.batches(df, 3).orderBy("batch").collect()
    assert [r.file_name for r in rows] == ["batch_000000_000002.json", "batch_000005_000009.json", "batch_000010_000010.json"]
    two = spark.createDataFrame([("v", 0, "f", "a"), ("v", 1, "g", "")], df.schema)
    assert batching.batches(two).first().batch_text == "--- Frame 0 ---\na\n\n--- Frame 1 ---"


def test_ledger(spark):
    dirs = spark.createDataFrame([(f"d{k}",) for k in range(1, 6)], "rel_path string")
    lines = spark.createDataFrame([("d2",), ("gone",), ("",), ("a\\nb",), (" d2 ",), ("x" * 1025,)], "value string")
    done = ledger.parse_checkpoint(lines)
    keys = lambda df: [r.rel_path for r in df.orderBy("rel_path").collect()]
    assert keys(done) == ["d2", "gone"] and ledger.malformed_entries(lines).first().n_malformed == 2
    todo = ledger.pending(dirs, done)
    assert keys(todo) == ["d1", "d3", "d4", "d5"] and keys(ledger.stale(done, dirs)) == ["gone"]
    assert keys(ledger.slice_pending(todo, "rel_path", 1, 3)) == ["d3", "d4"]
    assert keys(ledger.slice_pending(todo, "rel_path", 0, 99)) == ["d1", "d3", "d4", "d5"]
    assert keys(ledger.slice_pending(todo, "rel_path", 0, 99, clamp=False)) == []
    videos = spark.createDataFrame([("a",), ("b",)], "video_id string")
    ids = lambda wanted: [r.video_id for r in ledger.requested(videos, wanted).collect()]
    assert ids(["b", "z", "a", "b"]) == ["b", "a", "b"] and sorted(ids(["z"])) == ["a", "b"] == sorted(ids([]))


def test_picks(spark, tree):
    listed = trees.files(spark, f"{tree}/aux")
    assert [tuple(r) for r in trees.pick_video(listed).collect()] == [("v1", "a.mp4", 1)]
    assert trees.pick_metadata(listed).first().metadata_file == "x.info.json"
    assert trees.list_subtitles(listed).first().subtitle_files == ["x_en.srt", "x_fr.vtt"]
    assert "empty" in {r.rel_path for r in trees.subdirectories(spark, f"{tree}/frames").collect()}


def test_engines(spark):
    frames = spark.createDataFrame([("v", "a", bytearray(b" text ")), ("v", "b", bytearray(b"")), ("v", "c", bytearray(b"!bad"))], "video_id string, frame_name string, content binary")
    got = {r.frame_name: (r.raw_text, r.ocr_failed) for r in engines.ocr(frames, engines.byte_ocr).collect()}
    assert got == {"a": ("text", False), "b": (engines.OCR_EMPTY, True), "c": ("<<< OCR_EXCEPTION: bad >>>", True)}
    asked = spark.createDataFrame([("v", 0, " \n"), ("v", 1, "--- Frame 3 ---\nhi")], "video_id string, batch int, batch_text string")
    answers = {r.batch: r for r in engines.call_model(asked, "p", engines.echo_model).collect()}
    assert (answers[0].response, answers[0].input_tokens) == ("", 0) and "-- Frame 3 --\nhi" in answers[1].response
    videos = spark.createDataFrame([("v", bytearray(b"0\na\n\nb"))], "video_id string, content binary")
    assert [r.frame_count for r in engines.decode(videos, engines.line_decoder, 30.0).collect()] == [0, 2]


def test_a_model_task_holds_few_rows(spark):
    from framewright.session import arrow_rows

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    asked = spark.createDataFrame([("v", 0, "text")], "video_id string, batch int, batch_text string")
    with arrow_rows(spark, 10_000):
        engines.call_model(asked, "p", engines.echo_model)
        assert int(spark.conf.get(key)) == 256
    with arrow_rows(spark, 1):
        engines.call_model(asked, "p", engines.echo_model)
        assert int(spark.conf.get(key)) == 1


def test_failed_ocr_is_told_from_odd_texts(spark, tmp_path):
    import __spark_entry__ as entry

    texts = [(2, "!bang"), (5, " \n"), (8, ""), (11, "=x"), (1, "y"), (3, "z")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.video_id: (r.raw_text, r.ocr_failed) for r in entry.queries()["ocr_failed_sentinel"](spark, str(tmp_path)).collect()}
    plain = {"2": ("!bang", False), "5": ("", False), "8": ("", False), "11": ("=x", False)}
    assert got == plain | {"1": ("<<< OCR_EXCEPTION: page 1 >>>", True), "3": (engines.OCR_EMPTY, True)}


def test_sinks(spark, tree, tmp_path):
    made = samples(spark, tree, profiles=[])
    with pytest.raises(ValueError, match="unknown export mode"):
        sinks.write_export(made, f"{tmp_path}/out", "other")
    sinks.write_export(made, f"{tmp_path}/out", "cleaning_pairs")
    rows = spark.read.json(f"{tmp_path}/out").collect()
    assert len(rows) == made.count() and set(rows[0].asDict()) == {"frame_path", "raw_ocr", "clean_ocr"}
    assert sinks.copy_metadata(spark, f"{tree}/aux/v1/x.info.json", f"{tmp_path}/copy.json") and not sinks.copy_metadata(spark, f"{tree}/none", f"{tmp_path}/c")


def test_daemon_retries_until_done(spark, tree, tmp_path):
    path = f"{tmp_path}/ledger"
    dirs = lambda: trees.subdirectories(spark, f"{tree}/frames")
    work = lambda bad: lambda todo: todo.select("rel_path", F.when(F.col("rel_path") == bad, F.lit("Failed")).otherwise(F.lit("Success")).alias("status"), F.lit(1).alias("n_items"), F.lit(0.0).alias("cost_usd"))
    assert daemon.run_pass(dirs(), path, "s", work("v1"), dry_run=True).count() == 8
    daemon.run_pass(dirs(), path, "s", work("v1"))
    assert {r.rel_path for r in ledger.pending(dirs(), daemon.done(spark, path, "s")).collect()} == {"v1"}
    put(tree / "frames" / "v9" / "frame_000000.png", b"x")
    arrivals = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(f"{tree}/frames/*")
    daemon.watch(arrivals, dirs, path, f"{tmp_path}/state", "s", work("none")).awaitTermination()
    assert ledger.pending(dirs(), daemon.done(spark, path, "s")).isEmpty()


def test_command_line(spark, tree, tmp_path):
    run = lambda *a: cli.main([str(x) for x in a], spark)
    put(tree / "prompt.md", "Clean.")
    for k in range(2):
        put(tree / "raw" / "v1" / f"frame_{k:06d}.png", f" text  {k}".encode())
    done = run("ocr", "--input", tree / "raw", "--out", tmp_path / "o", "--ledger", tmp_path / "l1")
    assert [(r.rel_path, r.status, r.n_items) for r in done.collect()] == [("v1", "Success (2)", 2)]
    done = run("text-model", "--input", tree / "ocr", "--out", tmp_path / "t", "--ledger", tmp_path / "l2", "--prompt", tree / "prompt.md", "--batch-size", 5, "--end", 99)
    status = {r.rel_path: r.status for r in done.collect()}
    assert status["v1"] == "Success (7)" and status["bad_ocr"].startswith("No frame_")
    report = run("cost-stats", "--input", tmp_path / "t")
    assert report.first().line == "files with a cost: 8" and report.count() == 6
    assert {r.video_id for r in trees.text_batches(spark, f"{tmp_path}/t").collect()} == {"v1", "v2", "no_llm", "no_batch", "all_bad"}
    chained = run("text-model", "--input", tmp_path / "o", "--out", tmp_path / "u", "--ledger", tmp_path / "l5", "--prompt", tree / "prompt.md")
    assert trees.ocr_texts(spark, f"{tmp_path}/o").count() == 2 and chained is not None
    documents = trees.json_documents(spark, f"{tree}/llm")
    assert documents.count() > 5
    run("export", "--frames", tree / "frames", "--batches", tree / "llm", "--ocr", tree / "ocr", "--out", tmp_path / "e", "--mode", "cleaning_pairs", "--video-ids", "v1,zz")
    assert spark.read.json(f"{tmp_path}/e").count() == 7
    put(tree / "video" / "v1" / "a.mp4", "1\nf0\nf1\nf2")
    done = run("frames", "--input", tree / "video", "--out", tmp_path / "f", "--ledger", tmp_path / "l3", "--max-frames", 2)
    assert done.first().status == "Success (2) (metadata not copied)"
    assert run("frames", "--input", tree / "video", "--out", tmp_path / "g", "--ledger", tmp_path / "l4", "--dry-run").first().status == "Success (dry run)"


def flaky(flag, answer):
    """An engine that fails once on a text with ``boom``; ``flag`` remembers that it did."""

    def factory():
        def ask(prompt, given):
            import os

            if "boom" in str(given) and not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("busy")
            return answer()(prompt, given)

        return ask

    return factory


def test_a_failed_call_is_repaired_by_the_next_pass(spark, tmp_path, monkeypatch):
    put(tmp_path / "in" / "a" / "tesseract_ocr.json", {f"frame_{k:06d}.png": f"text {k}" + " boom" * (k == 3) for k in range(4)})
    put(tmp_path / "in" / "b" / "tesseract_ocr.json", {"frame_000000.png": "other"})
    put(tmp_path / "prompt.md", "Clean.")
    monkeypatch.setattr(cli, "engine", lambda name: flaky(f"{tmp_path}/flag", engines.echo_model))
    args = ["text-model", "--input", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--ledger", f"{tmp_path}/ledger", "--prompt", f"{tmp_path}/prompt.md", "--batch-size", "2"]
    told = []
    for _ in range(3):
        cli.main(args, spark)
        rows = spark.read.parquet(f"{tmp_path}/ledger").orderBy("ts", "rel_path").collect()
        told.append([(r.rel_path, r.status, r.n_items) for r in rows])
    assert told[0] == [("a", "Failed (1 of 2)", 2), ("b", "Success (1)", 1)]
    assert told[1] == told[2] == [*told[0], ("a", "Success (4)", 4)]
    half, whole = (r.cost_usd for r in rows if r.rel_path == "a")
    assert 0 < half < whole < 3 * half
    batches = {(r.video_id, r.batch_file) for r in trees.text_batches(spark, f"{tmp_path}/out/documents").collect()}
    assert batches == {("a", "batch_000000_000001.json"), ("a", "batch_000002_000003.json"), ("b", "batch_000000_000000.json")}
    assert trees.text_batches(spark, f"{tmp_path}/out/documents").count() == 3
    assert sinks.plain_files(spark, f"{tmp_path}/out/documents", f"{tmp_path}/plain") == 3
    assert json.loads((tmp_path / "plain" / "b" / "batch_000000_000000.json").read_text())["llm_output"]["task3_cleaned_text"] == ["other"]


def test_image_stage_sends_bytes_in_order(spark, tmp_path, monkeypatch):
    for k in range(5):
        put(tmp_path / "in" / "v" / f"frame_{k:06d}.png", f"image {k}".encode())
    put(tmp_path / "in" / "w" / "note.txt", "no frames")
    put(tmp_path / "prompt.md", "Look.")
    run = lambda *a: cli.main(["image-model", "--input", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--ledger", f"{tmp_path}/ledger", "--prompt", f"{tmp_path}/prompt.md", "--batch-size", "3", *a], spark)
    assert {r.rel_path: (r.status, r.n_items) for r in run().collect()} == {"v": ("Success (5)", 5), "w": ("No frame_*.png or frame_*.jpg", 0)}
    made = trees.batch_files(spark, f"{tmp_path}/out/documents").orderBy("batch_file").collect()
    assert [r.batch_file for r in made] == ["llm_output_batch_0000.json", "llm_output_batch_0001.json"]
    assert [r.task1_raw_ocr for r in made] == [["image 0", "image 1", "image 2"], ["image 3", "image 4"]]
    monkeypatch.setattr(cli, "engine", lambda name: lambda: lambda prompt, images: ("==== TASK 1: x ====\n-- Frame 2000000000 --\ny", 1, 1))
    again = cli.main(["image-model", "--input", f"{tmp_path}/in", "--out", f"{tmp_path}/out2", "--ledger", f"{tmp_path}/ledger2", "--prompt", f"{tmp_path}/prompt.md"], spark)
    assert {r.rel_path: r.status for r in again.collect()}["v"] == "Failed (0 of 1)"


def test_a_missing_image_fails_its_batch(spark):
    batches = spark.createDataFrame([("v", 0, ["frame_0.png", "frame_1.png"]), ("v", 1, ["frame_2.png", "x.txt"]), ("v", 2, ["y.txt"])], "video_id string, batch int, frame_names array<string>")
    contents = spark.createDataFrame([("v", n, bytearray(n.encode())) for n in ("frame_0.png", "frame_2.png", "x.txt", "y.txt")], "video_id string, frame_name string, content binary")
    got = {r.batch: r for r in engines.call_image_model(engines.with_images(batches, contents), "p", engines.caption_model).collect()}
    assert got[0].response is None and got[0].error == "no file frame_1.png" and got[2].error == "no images"
    assert "1 images" in got[1].response and got[1].input_tokens == len("frame_2.png")


def test_frames_are_resized_named_and_kept_once_a_second(spark, tmp_path):
    put(tmp_path / "in" / "v" / "a.mp4", "4\n" + "\n".join(f"2000x1000|f{k}" for k in range(8)))
    put(tmp_path / "in" / "v" / "x.info.json", '{"id": "é"}')
    run = lambda *a: cli.main(["frames", "--input", f"{tmp_path}/in", *a], spark)
    assert run("--out", f"{tmp_path}/o", "--ledger", f"{tmp_path}/l", "--fps", "2", "--max-dimension", "500").first().status == "Success (4)"
    got = {r.frame_name: bytes(r.content) for r in trees.written_frames(spark, f"{tmp_path}/o/frames").collect()}
    assert got == {"frame_000000.jpg": b"500x250|f2", "frame_000001.jpg": b"500x250|f4", "frame_000002.jpg": b"500x250|f6"}
    assert [r.value for r in trees.documents(spark, f"{tmp_path}/o/metadata", "*.info.json").collect()] == ['{"id": "é"}']
    run("--out", f"{tmp_path}/p", "--ledger", f"{tmp_path}/l2", "--max-dimension", "0")
    assert {bytes(r.content)[:9] for r in trees.written_frames(spark, f"{tmp_path}/p/frames").collect()} == {b"2000x1000"}
    read = cli.main(["ocr", "--frames-table", "--input", f"{tmp_path}/o/frames", "--out", f"{tmp_path}/q", "--ledger", f"{tmp_path}/l3"], spark)
    assert [(r.rel_path, r.status) for r in read.collect()] == [("v", "Success (3)")]


def test_short_videos_share_a_result(spark):
    class Videos:  # a table whose task runs here
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):  # noqa: N802
            videos = engines.pd.DataFrame({"video_id": [str(k) for k in range(3000)], "content": [b"1\nf"] * 3000})
            self.parts = [len(p) for p in run(iter([videos]))]
            return spark.createDataFrame([], schema)

    videos = Videos()
    engines.decode(videos, engines.line_decoder)
    assert videos.parts == [1024, 1024, 952]


def test_tables_of_items_have_few_files_and_the_newest_counts(spark, tmp_path):
    docs = lambda *rows: spark.createDataFrame(list(rows), "video_id string, file_name string, value string").coalesce(1)
    root = f"{tmp_path}/out/documents"
    sinks.write_documents(docs(*[(f"v{k}", "a.json", "old") for k in range(300)]), root)
    assert len([f for f in (tmp_path / "out").rglob("part-*")]) == 1
    put(tmp_path / "out" / "documents" / "video_id=w%2F1" / "file_name=a.json" / "part-0.txt", "earlier\n")
    put(tmp_path / "out" / "documents" / "video_id=v3" / "file_name=a.json" / "part-0.txt", "earlier\n")
    sinks.write_documents(docs(("v1", "a.json", "new"), ("v1", "b.txt", "x"), ("v2", "a.json", "a\n\nb\n")), root)
    want = {(f"v{k}", "a.json"): "old" for k in range(300)} | {("v1", "a.json"): "new", ("v2", "a.json"): "a\n\nb\n", ("w/1", "a.json"): "earlier"}
    got = trees.documents(spark, f"{tmp_path}/out", "*.json").collect()
    assert len(got) == len(want) and {(r.video_id, r.file_name): r.value for r in got} == want
    assert trees.json_documents(spark, root).count() == len(want)
    assert {r.rel_path for r in trees.subdirectories(spark, root).collect()} == {v for v, _ in want}
    frames = lambda *rows: spark.createDataFrame([(v, n, bytearray(c)) for v, n, c in rows], "video_id string, frame_name string, content binary").coalesce(1)
    sinks.write_frames(frames(*[(f"v{k}", n, b"old") for k in range(300) for n in "ab"]), f"{tmp_path}/frames")
    assert len(list((tmp_path / "frames").rglob("part-*"))) == 1
    frames(("e", "a", b"earlier"), ("v4", "a", b"earlier")).write.partitionBy("video_id").mode("append").parquet(f"{tmp_path}/frames")
    sinks.write_frames(frames(("v1", "a", b"new")), f"{tmp_path}/frames")
    kept = trees.written_frames(spark, f"{tmp_path}/frames").collect()
    assert len(kept) == 600 and [(r.frame_name, bytes(r.content)) for r in kept if r.video_id == "v1"] == [("a", b"new")]
    assert {bytes(r.content) for r in kept if r.video_id == "v4"} == {b"old"} and "e" in {r.video_id for r in kept}


def test_missing_ocr_program_stops_the_stage(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("TESSERACT_CMD", f"{tmp_path}/none")
    with pytest.raises(SystemExit, match="no OCR program"):
        cli.main(["ocr", "--input", "x", "--out", "y", "--ledger", "z", "--engine", "tesseract"], spark)
    program = tmp_path / "reader"
    program.write_text('#!/bin/sh\n[ "$4" = eng ] && cat || exit 1\n')
    program.chmod(0o755)
    monkeypatch.setenv("TESSERACT_CMD", str(program))
    assert engines.tesseract_installed() and engines.tesseract()(b" text ") == " text " and engines.tesseract("xx")(b"a") is None


def test_hosted_model(monkeypatch):
    import sys
    from types import ModuleType, SimpleNamespace

    seen = []

    class Models:
        def count_tokens(self, model, contents):
            return SimpleNamespace(total_tokens=len(contents))

        def generate_content_stream(self, model, contents, config):
            seen.append((model, contents, config))
            return iter([SimpleNamespace(text="a"), SimpleNamespace(text=None), SimpleNamespace(text="b")])

    with pytest.raises(RuntimeError):
        engines.genai_text(engines.Sampling())
    google, genai = ModuleType("google"), ModuleType("google.genai")
    google.genai, genai.Client = genai, lambda **k: SimpleNamespace(models=Models(), **k)
    monkeypatch.setitem(sys.modules, "google", google)
    monkeypatch.setitem(sys.modules, "google.genai", genai)
    with pytest.raises(RuntimeError, match="are not set"):
        engines.genai_text(engines.Sampling())
    monkeypatch.setenv("GOOGLE_CLOUD_PROJECT", "p")
    monkeypatch.setenv("GOOGLE_CLOUD_LOCATION", "l")
    assert engines.genai_text(engines.Sampling("m", 0.1))("prompt", "text") == ("ab", 2, 1)
    assert engines.made(engines.genai_images, sampling=engines.Sampling("m"))("prompt", [("n", "image/png", b"x")]) == ("ab", 2, 1)
    assert seen[0][2]["temperature"] == 0.1 and seen[1][1][1] == {"inline_data": {"data": b"x", "mime_type": "image/png"}} and len(seen[1][2]["safety_settings"]) == 4


def test_daemon_passes_without_arrivals(spark, tmp_path):
    from datetime import datetime, timezone

    dirs = lambda: spark.createDataFrame([(f"d{k}",) for k in range(4)], "rel_path string")
    seen: list[list[str]] = []

    def work(todo):
        names = sorted(r.rel_path for r in todo.collect())
        seen.append(names)
        return spark.createDataFrame([(n, "Failed" if n == "d1" and len(seen) < 3 else "Success", 2, 0.5) for n in names], "rel_path string, status string, n_items int, cost_usd double")

    since = datetime.now(timezone.utc)

    def until(passes, **more):
        query = daemon.watch(daemon.ticks(spark), dirs, f"{tmp_path}/l", f"{tmp_path}/state", "s", work, "1 second", **more)
        for _ in range(600):
            if len(seen) >= passes or not query.isActive:
                break
            query.awaitTermination(0.1)
        daemon.stop(query)

    until(3, start=1, end=3)
    assert seen[0] == ["d1", "d2"] and seen[1] == ["d0", "d1", "d3"] and seen[2] == ["d1"]
    told = daemon.summary(spark, f"{tmp_path}/l", "s", since).first()
    assert (told.attempted, told.successful, told.failed, told.frames) == (6, 4, 2, 8) and told.cost_usd == 3.0
    del seen[:]
    until(1, start=9, end=10, clamp=False)  # a strict range that is out of range, after a restart
    assert seen[0] == []


def test_cleaned_text_survives_the_model_chain(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark)
    assert rows.columns == ["video_id", "frame_idx", "clean"] and rows.filter(F.col("clean") != text.clean_ocr(F.col("clean"))).count() == 0
