"""Decoding, OCR and model calls as pluggable engines over Arrow batches.

An engine is a plain callable that a factory makes once per task; its results are columns of their own (value, error),
so one failed item does not fail the task. Results should be written before anything is derived from them: a plan that is
evaluated twice would call the engine twice.
"""

from __future__ import annotations

import inspect
import os
import shutil
import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions import parse
from framewright.functions.frames import frame_name, media_type, second_label
from framewright.session import bound_arrow, ship

#: The texts that stand for a failed OCR.
OCR_EMPTY, OCR_ERROR = "<<< OCR_FAILED_EMPTY_TEXT >>>", "<<< OCR_EXCEPTION: {} >>>"

OcrEngine = Callable[[bytes], "str | None"]
ModelEngine = Callable[[str, str], "tuple[str, int, int]"]
Image = tuple[str, str, bytes]
"""Name, media type, bytes."""
ImageEngine = Callable[[str, "list[Image]"], "tuple[str, int, int]"]
Frame = bytes | tuple[int, int, bytes]
"""Bytes, or width, height and bytes."""
Decoder = Callable[[bytes], "tuple[float, Iterator[Frame | None]]"]
"""A decoder whose frames have a size may have an attribute ``resize``: (bytes, width, height) -> bytes."""


@dataclass(frozen=True)
class Sampling:
    """How a model is asked. The defaults."""

    model: str = "gemini-2.5-pro-preview-05-06"
    temperature: float = 0.7
    top_p: float = 1.0
    max_output_tokens: int = 65_000


def made(factory: Callable, **options: object) -> Callable:
    """An engine from its factory, which gets those of the options that it asks for."""
    asked = inspect.signature(factory).parameters
    return factory(**{k: v for k, v in options.items() if k in asked})


def ocr_command() -> str:
    return os.environ.get("TESSERACT_CMD", "tesseract")


def tesseract_installed() -> bool:
    """Whether the OCR program is there; asked on the driver before a run."""
    return shutil.which(ocr_command()) is not None


def tesseract(language: str = "eng") -> OcrEngine:
    """The OCR program, a process per image; an image that it can't read has no text."""
    command = [ocr_command(), "stdin", "stdout", "-l", language]

    def read(content: bytes) -> str | None:
        done = subprocess.run(command, input=content, capture_output=True, check=False)
        return done.stdout.decode("utf-8", "replace") if done.returncode == 0 else None

    return read


def ocr(frames: DataFrame, factory: Callable[..., OcrEngine], language: str = "eng") -> DataFrame:
    """(video_id, frame_name, content) -> (video_id, frame_name, raw_text, ocr_failed); failures are texts of their own."""
    ship(frames.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = made(factory, language=language)
        for batch in batches:
            texts, failed = [], []
            for content in batch["content"]:
                try:
                    text = engine(bytes(content))
                    texts.append(OCR_EMPTY if text is None else text.strip())
                    failed.append(text is None)
                except Exception as problem:  # noqa: BLE001  an engine may raise anything
                    texts.append(OCR_ERROR.format(problem))
                    failed.append(True)
            yield pd.DataFrame({"video_id": batch["video_id"], "frame_name": batch["frame_name"], "raw_text": texts, "ocr_failed": failed})

    return frames.select("video_id", "frame_name", "content").mapInPandas(run, "video_id string, frame_name string, raw_text string, ocr_failed boolean")


#: Rows whose texts and answers a task holds in Python at a time.
ROWS_ASKED = 256
ANSWER = "video_id string, batch int, response string, input_tokens long, output_tokens long, error string"


def _asked(rows: DataFrame, factory: Callable, sampling: Sampling, call: Callable[[Callable, tuple], tuple | None]) -> DataFrame:
    """``call(engine, row)`` for every row (video_id, batch, ...): the answer, or the error that it raised; None is an empty answer."""
    ship(rows.sparkSession)
    bound_arrow(rows.sparkSession, ROWS_ASKED)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = made(factory, sampling=sampling)
        for part in parts:
            out: list[tuple] = []
            for row in part.itertuples(index=False):
                try:
                    response, n_in, n_out = call(engine, row) or ("", 0, 0)
                    out.append((row.video_id, row.batch, response if isinstance(response, str) else "".join(response), n_in, n_out, None))
                except Exception as problem:  # noqa: BLE001  an engine may raise anything
                    out.append((row.video_id, row.batch, None, None, None, str(problem) or type(problem).__name__))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER.split(", ")]).astype({"input_tokens": "Int64", "output_tokens": "Int64"})

    return rows.mapInPandas(run, ANSWER)


def call_model(batches: DataFrame, prompt: str, factory: Callable[..., ModelEngine], sampling: Sampling = Sampling()) -> DataFrame:  # noqa: B008
    """(video_id, batch, response, input_tokens, output_tokens, error) of rows with video_id, batch, batch_text. A blank text is not sent."""
    return _asked(batches.select("video_id", "batch", "batch_text"), factory, sampling, lambda engine, row: engine(prompt, row.batch_text) if (row.batch_text or "").strip() else None)


def with_images(batches: DataFrame, contents: DataFrame) -> DataFrame:
    """``batches`` (video_id, batch, frame_names in order) with images: array of (place, name, mime, content); content is null where the file is missing.

    ``contents``: (video_id, frame_name, content).
    """
    listed = batches.select("video_id", "batch", F.posexplode("frame_names").alias("place", "frame_name"))
    image = F.struct("place", F.col("frame_name").alias("name"), media_type(F.col("frame_name")).alias("mime"), "content")
    found = listed.join(contents.select("video_id", "frame_name", "content"), ["video_id", "frame_name"], "left")
    return batches.join(found.groupBy("video_id", "batch").agg(F.array_sort(F.collect_list(image)).alias("images")), ["video_id", "batch"])


def call_image_model(batches: DataFrame, prompt: str, factory: Callable[..., ImageEngine], sampling: Sampling = Sampling(max_output_tokens=65_535)) -> DataFrame:  # noqa: B008
    """The same for rows with video_id, batch, images (see ``with_images``), sent in order.

    One missing file fails the batch; files that are no images are left out, and a batch without images fails.
    """

    def call(engine: ImageEngine, row: tuple) -> tuple:
        images = [(i["name"], i["mime"], i["content"]) for i in row.images]
        missing = [name for name, _, content in images if content is None]
        if missing:
            raise FileNotFoundError(f"no file {missing[0]}")
        images = [(name, mime, bytes(content)) for name, mime, content in images if mime is not None]
        if not images:
            raise ValueError("no images")
        return engine(prompt, images)

    return _asked(batches.select("video_id", "batch", "images"), factory, sampling, call)


def genai_client():
    """A model client for the project and place that the environment names."""
    try:
        from google import genai
    except ImportError as missing:
        raise RuntimeError("the google-genai package is not installed") from missing
    project, location = os.environ.get("GOOGLE_CLOUD_PROJECT"), os.environ.get("GOOGLE_CLOUD_LOCATION")
    if not project or not location:
        raise RuntimeError("GOOGLE_CLOUD_PROJECT and GOOGLE_CLOUD_LOCATION are not set")
    return genai.Client(vertexai=True, project=project, location=location)


def _generated(sampling: Sampling, more: dict) -> Callable[[list], tuple[str, int, int]]:
    """One request: its parts counted, the answer's pieces joined and counted."""
    client = genai_client()
    config = {"temperature": sampling.temperature, "top_p": sampling.top_p, "max_output_tokens": sampling.max_output_tokens} | more
    count = lambda parts: client.models.count_tokens(model=sampling.model, contents=parts).total_tokens

    def ask(parts: list) -> tuple[str, int, int]:
        pieces = client.models.generate_content_stream(model=sampling.model, contents=parts, config=config)
        before, text = count(parts), "".join(p.text for p in pieces if p.text)
        return text, before, count([text])

    return ask


#: Categories of content that a model of images is not to hold back.
UNFILTERED = ("HARM_CATEGORY_HATE_SPEECH", "HARM_CATEGORY_DANGEROUS_CONTENT", "HARM_CATEGORY_SEXUALLY_EXPLICIT", "HARM_CATEGORY_HARASSMENT")


def genai_text(sampling: Sampling) -> ModelEngine:
    """A hosted model for texts."""
    ask = _generated(sampling, {})
    return lambda prompt, text: ask([prompt, text])


def genai_images(sampling: Sampling) -> ImageEngine:
    """A hosted model for images, each sent as bytes with its media type."""
    safety = [{"category": c, "threshold": "OFF"} for c in UNFILTERED]
    ask = _generated(sampling, {"safety_settings": safety, "response_modalities": ["TEXT"], "thinking_config": {"include_thoughts": True}})
    return lambda prompt, images: ask([prompt, *({"inline_data": {"data": content, "mime_type": mime}} for _, mime, content in images)])


def scaled(width: int, height: int, most: int) -> tuple[int, int]:
    """A size that fits a square of ``most``; 0 leaves it."""
    longest = max(width, height)
    return (width, height) if most <= 0 or longest <= most else (int(width * (most / longest)), int(height * (most / longest)))


#: Frames, and bytes of them, that leave a decoding task together, whichever videos they are of.
FRAMES_AT_ONCE, BYTES_AT_ONCE = 1024, 16_000_000


def decode(videos: DataFrame, factory: Callable[..., Decoder], target_fps: float = 1.0, max_dimension: int = 0) -> DataFrame:
    """(video_id, content) -> (video_id, frame_count, native_fps, content, second, frame_name): kept frames only; empty ones are counted but dropped.

    Frames larger than ``max_dimension`` (0: no limit) are resized by the decoder; one that fails to stays as it is.
    """
    ship(videos.sparkSession)
    columns = ["video_id", "frame_count", "native_fps", "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = factory()

        def fitted(frame: Frame) -> bytes:
            if isinstance(frame, bytes):
                return frame
            width, height, content = frame
            to = scaled(width, height, max_dimension)
            if to == (width, height) or not hasattr(decoder, "resize"):
                return content
            try:
                return decoder.resize(content, *to)
            except Exception:  # noqa: BLE001
                return content

        held: list[tuple] = []
        size = 0
        for batch in batches:
            for video_id, content in zip(batch["video_id"], batch["content"], strict=True):
                fps, frames = decoder(bytes(content))
                fps = fps if fps > 0 else 30.0
                interval = max(1, round(fps / target_fps)) if 0 < target_fps < fps else 1
                for k, frame in enumerate(frames):
                    if k % interval == 0 and frame and (isinstance(frame, bytes) or frame[2]):
                        held.append((video_id, k, fps, fitted(frame)))
                        size += len(held[-1][3])
                    if len(held) >= FRAMES_AT_ONCE or size >= BYTES_AT_ONCE:
                        yield pd.DataFrame(held, columns=columns)
                        held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)

    decoded = videos.select("video_id", "content").mapInPandas(run, "video_id string, frame_count long, native_fps double, content binary")
    labelled = decoded.withColumn("second", second_label(F.col("frame_count"), F.col("native_fps")))
    return labelled.withColumn("frame_name", frame_name(F.col("second")))


def last_of_names(frames: DataFrame) -> DataFrame:
    """Of the frames of a video that have one name (one second) the last: the one that a file would hold in the end."""
    last = frames.groupBy("video_id", "frame_name").agg(F.max("frame_count").alias("frame_count"))
    return frames.join(last, ["video_id", "frame_name", "frame_count"], "left_semi")


def echo_model() -> ModelEngine:
    """A deterministic stand-in for a model: returns each frame's text as its cleaned text and its markdown."""

    def answer(prompt: str, text: str) -> tuple[str, int, int]:
        frames = text.split("--- Frame ")[1:]
        pairs = [f.split(" ---\n", 1) if " ---\n" in f else (f.split(" ---")[0], "") for f in frames]
        block = "\n".join(f"-- Frame {n} --\n{t.strip()}" for n, t in pairs)
        response = f"{parse.TASK3}\n{block}\n{parse.TASK4}\n{block}\n{parse.TASK5}\n{len(pairs)} frames"
        return response, len(text.split()), len(response.split())

    return answer


def byte_ocr() -> OcrEngine:
    """A deterministic stand-in for OCR: the bytes are the text; empty bytes have none; ``!`` in front raises."""

    def read(content: bytes) -> str | None:
        if content[:1] == b"!":
            raise ValueError(content[1:].decode())
        return content.decode() or None

    return read


class LineDecoder:
    """A deterministic stand-in for a decoder: the first line is the frame rate, every other line a frame, ``WxH|bytes`` one of a size."""

    def __call__(self, content: bytes) -> tuple[float, Iterator[Frame | None]]:
        rate, *lines = content.split(b"\n")
        return float(rate), map(self.frame, lines)

    @staticmethod
    def frame(line: bytes) -> Frame:
        size, bar, _ = line.partition(b"|")
        width, x, height = size.partition(b"x")
        return (int(width), int(height), line) if bar and x and width.isdigit() and height.isdigit() else line

    @staticmethod
    def resize(content: bytes, width: int, height: int) -> bytes:
        return b"%dx%d|" % (width, height) + content.partition(b"|")[2]


def line_decoder() -> Decoder:
    return LineDecoder()


def caption_model() -> ImageEngine:
    """A deterministic stand-in for a model of images: an image's bytes are its text, the same in every task."""

    def answer(prompt: str, images: list[Image]) -> tuple[str, int, int]:
        block = "\n".join(f"-- Frame {k} --\n{content.decode()}" for k, (_, _, content) in enumerate(images))
        parts = [f"==== TASK {k}: Frames ====\n{block}" for k in (1, 2, 3, 4)]
        response = "\n".join([*parts, f"==== TASK 5: Summary ====\n{len(images)} images"])
        return response, sum(len(content) for _, _, content in images), len(response.split())

    return answer


def sample_frames(frames: DataFrame, most: int, seed: int = 0, key: str = "video_id", position: str = "frame_count") -> DataFrame:
    """At most ``most`` frames per video, drawn by a hash of the frame, in time order; the feature is the draw."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.lit("sample"), F.col(position).cast("string")))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(draw, position))
    return frames.withColumn("__rank", rank).filter(F.col("__rank") <= most).drop("__rank")
