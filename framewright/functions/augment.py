"""Noise for OCR-like training pairs: eight operators and ten profiles, as column expressions.

Every draw is a function of the seed, the row's key, the operator's tag and the position, so a result does not
depend on partitioning or retries. An empty text and a probability of 0 leave the text as it is. With ``compat`` (the
default) the line operators join lines with a backslash and an n, as the data they are meant to match do, and word
deletion flattens lines; without it lines stay lines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions import text as tx
from framewright.functions.let import let
from framewright.functions.rng import draw, draw_int, randint, stream

#: What a character may be misread as, in the order of the default map that results have to match. The lower-case form of
#: a character is looked up first, then itself.
MISREADINGS: dict[str, str | list[str]] = {
    "l": ["1", "|"],
    "1": ["l", "i"],
    "o": ["0", "()"],
    "0": "o",
    "i": ["1", "l", "!"],
    "s": ["5", "$"],
    "5": "s",
    "a": ["@", "4"],
    "e": ["3", "€"],
    "t": ["7", "+"],
    "S": ["$", "5"],
    "G": ["6", "&"],
    "B": ["8", "ß"],
    "g": ["9", "q"],
    "c": ["(", "["],
    "k": ["<"],
    "z": ["2"],
    "r": ["Я"],
}

Op = Callable[..., Column]


def every_second(hits: Column) -> Column:
    """Of each run of hits the first, third and so on: a boolean for every element, in one pass over the run's ends."""

    def runs(ends: Column) -> Column:
        def run(end: Column, k: Column) -> Column:
            own = F.when(end < 0, F.array().cast("array<boolean>")).otherwise(F.array(F.lit(False)))
            until = F.coalesce(F.get(ends, k + 1), F.size(hits))
            return F.concat(own, F.transform(F.array_repeat(F.lit(True), until - end - 1), lambda x, j: j % 2 == 0))

        return F.flatten(F.transform(ends, run))

    misses = F.filter(F.transform(hits, lambda h, i: F.when(h, F.lit(None)).otherwise(i)), lambda i: i.isNotNull())
    return let(F.concat(F.array(F.lit(-1)), misses), runs)



class Noise:
    """The eight operators for one seed and row key."""

    def __init__(self, seed: int | str, key: Column, compat: bool = True) -> None:
        self.seed, self.key, self.compat = seed, key, compat
        self.line_join = "\\n" if compat else "\n"

    def _guard(self, text: Column, probability: float, tag: str, body: Callable[[Column, Column], Column]) -> Column:
        """``body(text, start)`` for texts that are not empty; ``start`` is the operator's stream of draws for the row."""
        if probability == 0:
            return text
        noisy = lambda t: let(stream(self.seed, self.key, tag), lambda s: body(t, s))
        return let(text, lambda t: F.when(t.isNull() | (t == ""), t).otherwise(noisy(t)))

    def delete_sentences(self, text: Column, probability: float, tag: str = "ds") -> Column:
        def glue(kept: Column) -> Column:
            def with_gap(s: Column, i: Column) -> Column:
                open_end = ~s.rlike(r"[.!?]\z")
                next_word = F.get(kept, i + 1).rlike(r"\A[\p{L}\p{N}]")
                return F.when((i < F.size(kept) - 1) & (open_end | next_word), F.concat(s, F.lit(" "))).otherwise(s)

            return F.array_join(F.transform(kept, with_gap), "")

        def body(t: Column, start: Column) -> Column:
            def keep(all_: Column) -> Column:
                kept = F.filter(all_, lambda s, i: draw(start, i) > probability)
                return F.when(F.size(all_) == 0, t).otherwise(let(kept, glue))

            return let(tx.sentences(t), keep)

        return self._guard(text, probability, tag, body)

    def delete_words(self, text: Column, probability: float, tag: str = "dw") -> Column:
        def drop(t: Column, start: Column, line: Column | None = None) -> Column:
            return F.array_join(F.filter(tx.words(t), lambda w, i: draw(start, i, *([] if line is None else [line])) > probability), " ")

        def body(t: Column, start: Column) -> Column:
            if self.compat:
                return drop(t, start)
            return F.array_join(F.transform(tx.lines(t), lambda line, n: drop(line, start, n)), "\n")

        return self._guard(text, probability, tag, body)

    def duplicate_lines(self, text: Column, probability: float, most: int = 1, tag: str = "dl") -> Column:
        def body(t: Column, start: Column) -> Column:
            def again(line: Column, i: Column) -> Column:
                return F.array_repeat(line, 1 + F.when(draw(start, i) < probability, draw_int(start, i, 1, most)).otherwise(0))

            return F.array_join(F.flatten(F.transform(tx.lines(t), again)), self.line_join)

        return self._guard(text, probability, tag, body)

    def merge_lines(self, text: Column, probability: float, tag: str = "ml") -> Column:
        """A line that is merged takes the next one with it, so of a run of lines that are hit every second one merges."""

        def body(t: Column, start: Column) -> Column:
            def merged(split: Column, opens: Column) -> Column:
                last = F.size(split) - 1

                def one(line: Column, i: Column) -> Column:
                    both = F.concat(tx.strip(line), F.lit(" "), tx.strip(F.get(split, i + 1)))
                    return F.when(F.get(opens, i - 1), F.lit(None)).when(F.get(opens, i) & (i < last), both).otherwise(line)

                return F.array_join(F.filter(F.transform(split, one), lambda x: x.isNotNull()), self.line_join)

            def whole(split: Column) -> Column:
                hits = F.transform(split, lambda line, i: draw(start, i) < probability)
                out = let(let(hits, every_second), lambda opens: merged(split, opens))
                return F.when(F.size(split) < 2, t).otherwise(out)

            return let(tx.lines(t), whole)

        return self._guard(text, probability, tag, body)

    def split_lines(self, text: Column, probability: float, tag: str = "sl") -> Column:
        def body(t: Column, start: Column) -> Column:
            def cut(line: Column, i: Column) -> Column:
                def halves(w: Column) -> Column:
                    n = F.size(w)
                    at = draw_int(start, i, 1, F.greatest(n - 1, F.lit(1)))
                    two = let(at, lambda k: F.array(F.array_join(F.slice(w, 1, k), " "), F.array_join(F.slice(w, k + 1, n), " ")))
                    return F.when(n > 1, two).otherwise(F.array(line))

                return F.when(draw(start, i) < probability, let(tx.words(line), halves)).otherwise(F.array(line))

            return F.array_join(F.flatten(F.transform(tx.lines(t), cut)), self.line_join)

        return self._guard(text, probability, tag, body)

    def character_noise(self, text: Column, probability: float, char_map: dict[str, str | list[str]] | None = None, tag: str = "ch") -> Column:
        table = {k: [v] if isinstance(v, str) else list(v) for k, v in (char_map or MISREADINGS).items()}
        misread = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])

        def body(t: Column, start: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                found = F.coalesce(F.try_element_at(misread, F.lower(c)), F.try_element_at(misread, c))
                choice = let(found, lambda f: F.when(f.isNull(), c).otherwise(F.get(f, draw_int(start, i, 0, F.size(f) - 1))))
                return F.when(draw(start, i) < probability, choice).otherwise(c)

            return F.array_join(F.transform(F.split(t, ""), one), "")

        return self._guard(text, probability, tag, body)

    def whitespace_noise(self, text: Column, missing: float, extra: float, tag: str = "ws") -> Column:
        """One draw per gap: no space, two, or one. Around an empty piece (two spaces in a row) the piece before comes again."""

        def body(t: Column, start: Column) -> Column:
            def glue(split: Column) -> Column:
                def piece(w: Column, i: Column) -> Column:
                    before = F.get(split, i - 1)
                    gap = let(draw(start, i), lambda u: F.when(u < missing, F.lit("")).when(u < missing + extra, F.lit("  ")).otherwise(F.lit(" ")))
                    return F.when(i == 0, w).when((before == "") | (w == ""), F.concat(before, w)).otherwise(F.concat(gap, w))

                return F.array_join(F.transform(split, piece), "")

            return let(F.split(t, " ", -1), glue)

        return text if missing == 0 and extra == 0 else self._guard(text, 1.0, tag, body)

    def partial_lines(self, text: Column, probability: float, mode: str, low: float, high: float, most: int = 1, tag: str = "dp") -> Column:
        """Repeat a part of a line: its first words (``words_start``), last words (``words_end``) or a stretch (``random_ratio``).

        Rounds of the first two add up on the line; each round of the third starts from the line's words, so the last one counts.
        """
        steps = {"words_start": self._again_start, "words_end": self._again_end, "random_ratio": None}
        if mode not in steps:
            return text

        def body(t: Column, start: Column) -> Column:
            def line_noise(line: Column, i: Column) -> Column:
                def repeat(w: Column) -> Column:
                    count = draw_int(start, i, 1, most)
                    if mode == "random_ratio":
                        return let(count, lambda k: self._again_ratio(w, start, i, k, low, high))
                    count_words = lambda k: F.least(draw_int(start, i, int(low), int(high), 2, k), F.size(w))
                    return F.aggregate(F.sequence(F.lit(1), count), line, lambda acc, k: let(count_words(k), lambda n: steps[mode](acc, w, n)))

                hit = (draw(start, i) < probability) & (tx.strip_bound(line) != "")
                return F.when(hit, let(tx.words(line), repeat)).otherwise(line)

            return F.array_join(F.transform(tx.lines(t), line_noise), self.line_join)

        return self._guard(text, probability, tag, body)

    def _again_start(self, line: Column, w: Column, n: Column) -> Column:
        return let(
            F.array_join(F.slice(w, 1, n), " "),
            lambda part: F.concat(F.substr(line, F.lit(1), F.char_length(part)), F.lit(" "), part, F.substr(line, F.char_length(part) + 1)),
        )

    def _again_end(self, line: Column, w: Column, n: Column) -> Column:
        def last_place(text: Column, piece: Column) -> Column:
            """1-based place of the last occurrence; 0 if none."""
            back = F.instr(F.reverse(text), F.reverse(piece))
            return F.when(back == 0, F.lit(0)).otherwise(F.char_length(text) - back - F.char_length(piece) + 2)

        def insert(part: Column) -> Column:
            final = F.element_at(part, -1)
            end = last_place(line, final) + F.char_length(final) - 1
            at = last_place(F.substr(line, F.lit(1), end), F.element_at(part, 1))
            grown = lambda k: F.concat(F.substr(line, F.lit(1), k - 1), F.array_join(part, " "), F.lit(" "), F.substr(line, k))
            return let(at, lambda k: F.when(k == 0, line).otherwise(grown(k)))

        return let(F.slice(w, F.size(w) - n + 1, n), insert)

    def _again_ratio(self, w: Column, start: Column, i: Column, k: Column, low: float, high: float) -> Column:
        size = F.size(w)
        ratio = F.lit(low) + draw(start, i, 2, k) * (high - low)
        length = F.when(size == 1, 1).otherwise(F.greatest(F.lit(1), F.floor(size * ratio).cast("int")))

        def insert(n: Column) -> Column:
            """The stretch again after its first occurrence, sought in the joined words: comparing lists word by word costs the square of a long line."""

            def again(joined: Column, part: Column) -> Column:
                first = F.instr(F.concat(F.lit(" "), joined, F.lit(" ")), F.concat(F.lit(" "), part, F.lit(" ")))
                end = first + F.char_length(part)
                return let(end, lambda e: F.concat(F.substr(joined, F.lit(1), e - 1), F.lit(" "), part, F.substr(joined, e)))

            stretch = F.array_join(F.slice(w, draw_int(start, i, 1, size - n + 1, 3, k), n), " ")
            return let(F.array_join(w, " "), lambda joined: let(stretch, lambda part: again(joined, part)))

        return let(length, insert)


#: The steps of the ten profiles, in order. ds, dw: delete sentences, words. dl: duplicate lines (p, most). ps, pe, pr: repeat
#: first words, last words, a stretch (p, low, high, most). ml, sl: merge, split lines. ws: white space (missing, extra). ch: characters.
PROFILES: dict[str, list[tuple]] = {
    "slight_stutter": [("dw", 0.01), ("dl", 0.05, 1), ("ps", 0.10, 2, 3, 1), ("pe", 0.10, 2, 3, 1), ("ws", 0.01, 0.02), ("ch", 0.005)],
    "gappy_and_fragmented": [("ds", 0.10), ("dw", 0.15), ("ml", 0.02), ("sl", 0.02), ("ch", 0.01)],
    "overly_eager_diff": [("dw", 0.02), ("dl", 0.20, 2), ("pr", 0.25, 0.3, 0.5, 1), ("ch", 0.005)],
    "line_boundary_chaos": [("ds", 0.02), ("dw", 0.05), ("ml", 0.20), ("sl", 0.15), ("ws", 0.025, 0.05), ("ch", 0.01)],
    "classic_bad_ocr": [("ds", 0.03), ("dw", 0.08), ("dl", 0.01, 1), ("pr", 0.01, 0.1, 0.3, 1), ("ws", 0.015, 0.03), ("ch", 0.05)],
    "the_echo_chamber": [("dw", 0.005), ("ds", 0.005), ("dl", 0.30, 3), ("pr", 0.30, 0.2, 0.6, 2), ("ws", 0.001, 0.001), ("ch", 0.001)],
    "telegraphic_transmission": [("ds", 0.15), ("dw", 0.25), ("ml", 0.05), ("sl", 0.05), ("ch", 0.01)],
    "jittery_frame_capture": [("ds", 0.02), ("dw", 0.07), ("dl", 0.03, 1), ("ps", 0.15, 1, 2, 1), ("pe", 0.15, 1, 2, 1), ("ws", 0.01, 0.02), ("ch", 0.02)],
    "minimalist_diff_max_omission": [("ds", 0.25), ("dw", 0.30), ("pr", 0.02, 0.05, 0.15, 1), ("ws", 0.005, 0.005), ("ch", 0.005)],
    "comprehensive_degradation": [("ds", 0.05), ("dw", 0.10), ("dl", 0.10, 1), ("pr", 0.10, 0.20, 0.30, 1), ("ml", 0.05), ("sl", 0.05), ("ws", 0.015, 0.03), ("ch", 0.03)],
}


def step(noise: Noise, text: Column, op: str, args: Sequence[float], tag: str) -> Column:
    """One step of a profile."""
    modes = {"ps": "words_start", "pe": "words_end", "pr": "random_ratio"}
    if op in modes:
        p, low, high, most = args
        return noise.partial_lines(text, p, modes[op], low, high, int(most), tag)
    apply = {
        "ds": noise.delete_sentences,
        "dw": noise.delete_words,
        "dl": lambda t, p, most, tag: noise.duplicate_lines(t, p, int(most), tag),
        "ml": noise.merge_lines,
        "sl": noise.split_lines,
        "ws": noise.whitespace_noise,
        "ch": lambda t, p, tag: noise.character_noise(t, p, None, tag),
    }[op]
    return apply(text, *args, tag=tag)


def profile(text: Column, key: Column, name: str, seed: int | str = 0, compat: bool = True) -> Column:
    """All steps of a profile, one after the other; each step draws with its own tag."""
    noise = Noise(seed, key, compat)
    for k, (op, *args) in enumerate(PROFILES[name]):
        text = step(noise, text, op, args, f"{name}:{k}:{op}")
    return text


def profile_choice(text: Column, key: Column, seed: int | str = 0, names: Sequence[str] | None = None, compat: bool = True) -> Column:
    """A profile drawn per row; '' for an empty text."""
    names = list(names if names is not None else PROFILES)
    drawn = chosen_profile(key, seed, len(names))
    out = F.lit("")
    for k, name in enumerate(names):
        out = F.when(drawn == k, profile(text, key, name, seed, compat)).otherwise(out)
    return F.when(text.isNull() | (text == "") | (F.lit(len(names)) == 0), F.lit("")).otherwise(out)


def chosen_profile(key: Column, seed: int | str, count: int) -> Column:
    return randint(seed, key, "profile", F.lit(0), 0, max(0, count - 1))
