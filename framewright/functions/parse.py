"""Model responses as columns: 1 text to lists of frame texts per task."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions import text as tx
from framewright.functions.let import let

#: The headers of the text layout, and the mark for an unchanged frame.
TASK3 = "==== TASK 3: CLEANED AND CORRECTED OCR TEXT ===="
TASK4 = "==== TASK 4: MARKDOWN REPRESENTATION ===="
TASK5 = "==== TASK 5: CONTEXTUAL SUMMARY AND KEY INFORMATION ===="
SAME = "<<< SAME_AS_PREVIOUS >>>"
#: The keys of the k-th block by layout; the last is a text, the others are lists of frames.
LAYOUTS = {
    "v5": ("task1_raw_ocr", "task2_augmented", "task3_cleaned", "task4_markdown", "task5_summary"),
    "v3": ("task1_cleaned_ocr", "task2_structured_markdown", "task3_narrative_summary"),
}
#: The grammar of headers and marks.
HEADER = r"(?imd)^====\s*TASK \d+:[^=]+?\s*====$"
MARKER = r"(?imd)^--\s*Frame (\d+)\s*--$"
NO_TEXTS = "array<string>"
MOST_FRAMES = 100_000
"""Frame numbers of a response from here on are no frames of a batch."""


def text_response(response: Column) -> Column:
    """struct<task3_cleaned_text, task4_markdown_text, task5_summary>, or null if nothing was found.

    A block runs from its header (first occurrence) to the next task's; a frame is what follows ``-- Frame <n> --``, in
    the order of appearance.
    """

    def frames(block: Column) -> Column:
        parts = F.filter(F.split(block, "-- Frame ", -1), lambda p: p.rlike(r"(?U)\A\d+\s*--"))
        return F.transform(parts, lambda p: tx.strip(F.regexp_replace(p, r"(?U)\A\d+\s*--\n?", "")))

    def blocks(t: Column) -> Column:
        at3, at4, at5 = (F.instr(t, h) for h in (TASK3, TASK4, TASK5))
        end = F.char_length(t) + 1
        after4 = F.when(at5 > 0, at5).otherwise(end)
        after3 = F.when(at4 > 0, at4).otherwise(after4)

        def cut(at: Column, header: str, stop: Column) -> Column:
            begin = at + len(header)
            return F.when((at > 0) & (stop > begin), tx.strip(F.substr(t, begin, F.greatest(stop - begin, F.lit(0))))).otherwise(F.lit(""))

        return F.struct(
            frames(cut(at3, TASK3, after3)).alias("task3_cleaned_text"),
            frames(cut(at4, TASK4, after4)).alias("task4_markdown_text"),
            cut(at5, TASK5, end).alias("task5_summary"),
        )

    def found(s: Column) -> Column:
        nothing = (F.size(s["task3_cleaned_text"]) == 0) & (F.size(s["task4_markdown_text"]) == 0) & (s["task5_summary"] == "")
        return F.when(~nothing, s)

    return let(tx.strip(F.coalesce(response, F.lit(""))), lambda t: let(blocks(t), found))


def fill_same(texts: Column) -> Column:
    """Each mark for an unchanged frame replaced by the frame before; '' where there is none."""

    def runs(own: Column) -> Column:
        until = lambda k: F.coalesce(F.get(own, k + 1), F.size(texts))
        filled = F.flatten(F.transform(own, lambda i, k: F.array_repeat(F.get(texts, i), until(k) - i)))
        return F.concat(F.array_repeat(F.lit(""), F.coalesce(F.get(own, F.lit(0)), F.size(texts))), filled)

    texts_that_are = F.filter(F.transform(texts, lambda c, i: F.when(c.eqNullSafe(F.lit(SAME)), F.lit(None)).otherwise(i)), lambda i: i.isNotNull())
    return let(texts_that_are, runs)


def _numbered(block: Column) -> Column:
    """The marks of a block in order, as struct<n, k, body>: a frame's number, its mark's place, and what follows it."""
    numbers = F.transform(F.regexp_extract_all(block, F.lit(MARKER), F.lit(1)), lambda n: n.try_cast("int"))

    def pairs(bodies: Column) -> Column:
        return F.transform(numbers, lambda n, k: F.struct(n.alias("n"), k.alias("k"), F.get(bodies, k + 1).alias("body")))

    return F.filter(let(F.split(block, MARKER, -1), pairs), lambda p: p["n"].isNotNull() & p["body"].startswith("\n"))


def frame_list(block: Column, most: int = MOST_FRAMES) -> Column:
    """Frame texts by number from 0: the last of equal numbers counts, missing ones are '', marks are filled.

    Null if a number reaches ``most``: the list would be as long as the number.
    """

    def dense(found: Column) -> Column:
        last = F.filter(found, lambda p, i: F.coalesce(F.get(found, i + 1)["n"] != p["n"], F.lit(True)))

        def gaps(one: Column) -> Column:
            before = lambda i: F.coalesce(F.get(one, i - 1)["n"], F.lit(-1))
            return F.flatten(F.transform(one, lambda p, i: F.concat(F.array_repeat(F.lit(""), p["n"] - before(i) - 1), F.array(tx.strip(p["body"])))))

        top = F.element_at(found, -1)["n"]
        return F.when(F.size(found) == 0, F.array().cast(NO_TEXTS)).when(top < most, let(let(last, gaps), fill_same))

    return let(block, lambda b: let(F.array_sort(_numbered(b)), dense))


def image_response(response: Column, layout: str = "v5", most: int = MOST_FRAMES) -> Column:
    """struct of the layout's keys: the k-th header opens the k-th block, whatever its number; null for an empty response.

    A response with a frame number of ``most`` or more is null as well: it failed (see ``too_many_frames``).
    """
    keys = LAYOUTS[layout]

    def blocks(parts: Column) -> Column:
        block = lambda k: tx.strip(F.coalesce(F.get(parts, F.lit(k)), F.lit("")))
        lists = [frame_list(block(k), most).alias(key) for k, key in enumerate(keys[:-1], 1)]
        return F.struct(*lists, block(len(keys)).alias(keys[-1]))

    def whole(found: Column) -> Column:
        bad = [found[key].isNull() for key in keys[:-1]]
        return F.when(~reduce(or_, bad), found)

    return F.when(F.coalesce(response, F.lit("")) != "", let(let(F.split(response, HEADER, -1), blocks), whole))


def too_many_frames(response: Column, most: int = MOST_FRAMES) -> Column:
    """An error for a response with a frame number of ``most`` or more, else null."""
    digits = F.transform(F.regexp_extract_all(F.coalesce(response, F.lit("")), F.lit(MARKER), F.lit(1)), lambda n: n.try_cast("int"))
    top = F.array_max(digits)
    return F.when(top >= most, F.concat(F.lit("a frame number is "), top.cast("string")))
