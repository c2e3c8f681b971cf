"""Frame names, thinning, labels, geometry, file kinds and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Video extensions in the order of preference.
VIDEO_EXTENSIONS = (".mp4", ".webm", ".mkv", ".avi", ".mov")
#: Media types by lower-case extension.
MEDIA_TYPES = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png"}
#: Size units.
UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def frame_number(name: Column) -> Column:
    """The number in ``frame_<digits>.``; null if there is none."""
    digits = F.regexp_extract(name, r"frame_(\d+)\.", 1)
    return F.when(digits != "", F.try_to_number(digits, F.lit("9" * 10)).cast("int"))


def frame_name(second: Column, extension: str = "jpg") -> Column:
    return F.format_string(f"frame_%06d.{extension}", second.cast("int"))


def fps_interval(native: Column, target: Column) -> Column:
    """Every how many frames one is kept: native / target rounded half to even if 0 < target < native, else 1."""
    native = F.when(native <= 0, F.lit(30.0)).otherwise(native)
    thin = (target > 0) & (target < native)
    return F.when(thin, F.bround(native / target).cast("int")).otherwise(1)


def second_label(frame: Column, native: Column) -> Column:
    native = F.when(native <= 0, F.lit(30.0)).otherwise(native)
    return F.bround(frame / native).cast("int")


def resized(width: Column, height: Column, most: Column) -> tuple[Column, Column]:
    """(width, height) scaled down so that the longer side is ``most``; a limit of 0 or null means none."""
    longer = F.greatest(width, height)
    limit = F.nullif(most, F.lit(0))
    scale = limit / longer
    shrink = limit.isNotNull() & (longer > limit)
    return (
        F.when(shrink, F.floor(width * scale).cast("int")).otherwise(width),
        F.when(shrink, F.floor(height * scale).cast("int")).otherwise(height),
    )


def extension(name: Column) -> Column:
    """Lower-case text after the last dot; '' if there is none."""
    return F.lower(F.regexp_extract(name, r"\.([^./]*)\z", 1))


def media_type(name: Column) -> Column:
    """The media type of an image name; null for others."""
    out = F.lit(None).cast("string")
    for ext, kind in MEDIA_TYPES.items():
        out = F.when(extension(name) == ext, F.lit(kind)).otherwise(out)
    return out


def is_image(name: Column) -> Column:
    return extension(name).isin(*MEDIA_TYPES)


def readable_size(count: Column) -> Column:
    """0 as ``0B``, else a number rounded to two places and its unit; a negative size is an error."""
    power = F.lit(0)
    for k in range(1, len(UNITS)):
        power = F.when(count >= F.lit(float(1024**k)), F.lit(k)).otherwise(power)
    value = F.bround(count / F.pow(F.lit(1024.0), power), 2)
    text = F.concat(value.cast("string"), F.lit(" "), F.element_at(F.array(*map(F.lit, UNITS)), power + 1))
    return F.when(count < 0, F.raise_error(F.lit("a size can't be negative")).cast("string")).when(count == 0, F.lit("0B")).otherwise(text)
