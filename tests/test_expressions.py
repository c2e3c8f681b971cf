"""Cleaning, noise, references, parsers and scalars against worked examples."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.functions import augment, cost, frames, parse, refs, rng, text
from framewright.functions.let import let


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r.x for r in df.select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


CLEAN = [
    ("Line 1  with   extra spaces.\n\n\nLine 2 after triple newline.\r\nLine 3 with carriage return.\n\n\n\nLine 4 after even more newlines.",
     "Line 1 with extra spaces.\nLine 2 after triple newline.\nLine 3 with carriage return.\nLine 4 after even more newlines."),
    ("   Leading and trailing spaces   \n\nJust one blank line here.\nAnd   another   line.", "Leading and trailing spaces\nJust one blank line here.\nAnd another line."),
    ("LineA\nLineB\n\nLineC\n\n\nLineD", "LineA\nLineB\nLineC\nLineD"),
    ("", ""),
    ("   \n \n  \n   ", ""),
    ("Hello     World\nThis  is  a    test.", "Hello World\nThis is a test."),
    ("Line with\ttabs\tand  spaces.", "Line with tabs and spaces."),
    (" x\x1c\n\x0b y ", "x\ny"),
    (None, ""),
]


def test_clean(spark):
    assert apply(spark, [c for c, _ in CLEAN], text.clean_ocr) == [w for _, w in CLEAN]


SPACES = "ab .!?\n\r\t\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　é"


@given(st.lists(st.text(alphabet=SPACES, max_size=14), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_splits_like_python(spark, values):
    assert apply(spark, values, text.words) == [v.split() for v in values]
    assert apply(spark, values, text.lines) == [v.splitlines() for v in values]
    assert apply(spark, values, text.strip) == [v.strip() for v in values]
    clean = apply(spark, values, text.clean_ocr)
    assert apply(spark, clean, text.clean_ocr) == clean


def test_sentences(spark):
    assert apply(spark, ["A b. C!D? e", "none", " ... ", "", None], text.sentences) == [["A b.", "C!", "D?", "e"], ["none"], [".", ".", "."], [], []]


BACK = "\\n"
CASES = [
    ("delete_sentences", (1.0,), "A b. C d.", ""),
    ("delete_words", (1.0,), "a b", ""),
    ("duplicate_lines", (1.0, 1), "a\nb", f"a{BACK}a{BACK}b{BACK}b"),
    ("partial_lines", (1.0, "words_start", 2, 2), "a b c", "a b a b c"),
    ("partial_lines", (1.0, "words_end", 2, 2), "a b c", "a b c b c"),
    ("partial_lines", (1.0, "random_ratio", 1.0, 1.0), "a b c", "a b c a b c"),
    ("partial_lines", (1.0, "unknown", 1, 1), "a b c", "a b c"),
    ("merge_lines", (1.0,), "a\nb\nc", f"a b{BACK}c"),
    ("merge_lines", (1.0,), "a", "a"),
    ("split_lines", (1.0,), "a b", f"a{BACK}b"),
    ("character_noise", (1.0, {"a": ["x"]}), "aAb", "xxb"),
    ("character_noise", (1.0,), "0", "o"),
    ("whitespace_noise", (1.0, 0.0), "a b c", "abc"),
    ("whitespace_noise", (0.0, 1.0), "a b c", "a  b  c"),
    ("whitespace_noise", (0.5, 0.5), "a  b", "aab"),
]


@pytest.mark.parametrize(("op", "args", "before", "after"), CASES)
def test_noise(spark, op, args, before, after):
    noise = augment.Noise(1, F.col("v"))
    assert apply(spark, [before, "", None], lambda v: getattr(noise, op)(v, *args)) == [after, "", None]


@pytest.mark.parametrize("op", ["delete_sentences", "delete_words", "duplicate_lines", "merge_lines", "split_lines", "character_noise"])
def test_probability_zero(spark, op):
    noise = augment.Noise(1, F.col("v"))
    assert apply(spark, ["a b.\nc  d"], lambda v: getattr(noise, op)(v, 0.0)) == ["a b.\nc  d"]


def test_noise_with_real_lines(spark):
    noise = augment.Noise(1, F.col("v"), compat=False)
    assert apply(spark, ["a\nb"], lambda v: noise.duplicate_lines(v, 1.0)) == ["a\na\nb\nb"]
    assert apply(spark, ["a b\nc d"], lambda v: noise.delete_words(v, 1e-12)) == ["a b\nc d"]


def test_deleting_leaves_a_subsequence_whatever_the_partitions(spark):
    df = spark.range(200).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("w"), i.cast("string")))).alias("t"))
    noisy = lambda d: {r.id: r.x for r in d.select("id", augment.Noise(3, F.col("id")).delete_words(F.col("t"), 0.3).alias("x")).collect()}
    got = noisy(df)
    assert got == noisy(df.repartition(7))
    order = {f"w{k}": k for k in range(1, 41)}
    places = [[order[w] for w in x.split()] for x in got.values()]
    assert all(p == sorted(set(p)) for p in places)
    assert 0.65 < sum(map(len, places)) / (200 * 40) < 0.75


def test_profiles(spark):
    df = spark.createDataFrame([(1, "One two. Three four five six."), (2, ""), (3, None)], "k int, t string")
    for name in augment.PROFILES:
        got = [r.x for r in df.select("k", augment.profile(F.col("t"), F.col("k"), name).alias("x")).orderBy("k").collect()]
        assert got[1:] == ["", None]
    chosen = [r.x for r in df.select("k", augment.profile_choice(F.col("t"), F.col("k")).alias("x")).orderBy("k").collect()]
    assert chosen[1:] == ["", ""]


def test_uniform(spark):
    values = [r.u for r in spark.range(4000).select(rng.uniform(1, F.col("id"), "x", F.lit(0)).alias("u")).collect()]
    assert 0 <= min(values) and max(values) < 1 and abs(sum(values) / 4000 - 0.5) < 0.02
    assert {r.n for r in spark.range(200).select(rng.randint(1, F.col("id"), "x", F.lit(0), 2, 4).alias("n")).collect()} == {2, 3, 4}
    assert spark.range(1).select(let(F.lit(2), lambda x: x * x).alias("y")).first().y == 4


REFS = ["A", "F:0", " F:0", "F:1 tail", "F:9", "F:x", "F:", "F:3+", "F:02", "F:4z", "F:10", 'F:0 + "\\nB"', "F:99999999999999999999", "F:1²"]
SOLVED = ["A", "A", " F:0", "A tail", "F:9", "F:x", "F:", "A tail+", " F:0", "F:9z", "F:10", 'A + "\\nB"', "F:99999999999999999999", "F:1²"]


def test_references(spark):
    assert apply(spark, [REFS], refs.resolve_list, "array<string>") == [SOLVED]
    decoded = apply(spark, [REFS], lambda v: refs.resolve_list(v, True), "array<string>")[0]
    assert decoded[11] == "A\nB" and decoded[:11] == SOLVED[:11]


@given(st.lists(st.text(alphabet="aF:0 1\n", max_size=6), min_size=1, max_size=8))
@settings(max_examples=15, deadline=None)
def test_references_round_trip(spark, texts):
    texts = ["|" + t for t in texts]  # no text is a reference of its own
    rows = spark.createDataFrame([(k, t, texts[k - 1] if k else None) for k, t in enumerate(texts)], "i int, t string, p string")
    coded = [r.c for r in rows.select("i", refs.encode_refs(F.col("t"), F.col("p"), F.col("i")).alias("c")).orderBy("i").collect()]
    assert apply(spark, [coded], refs.resolve_list, "array<string>") == [texts]


V5 = """==== TASK 1: Raw ====
-- Frame 0 --
hello
-- Frame 2 --
<<< SAME_AS_PREVIOUS >>>
==== TASK 2: Aug ====
-- frame 0 --
<<< SAME_AS_PREVIOUS >>>
-- Frame 1 --
x
-- Frame 1 --
y
==== TASK 3: Clean ====
no markers
==== TASK 4: Md ====
==== TASK 5: Sum ====
story"""


def test_image_response(spark):
    got = apply(spark, [V5, "", None, "no headers"], parse.image_response)
    assert got[0].asDict() == {"task1_raw_ocr": ["hello", "", ""], "task2_augmented": ["", "y"], "task3_cleaned": [], "task4_markdown": [], "task5_summary": "story"}
    assert got[1:3] == [None, None]
    assert got[3].task1_raw_ocr == [] and got[3].task5_summary == ""
    v3 = apply(spark, [V5], lambda v: parse.image_response(v, "v3"))[0]
    assert v3.task1_cleaned_ocr == ["hello", "", ""] and v3.task3_narrative_summary == "no markers"


def test_text_response(spark):
    t3, t4, t5 = parse.TASK3, parse.TASK4, parse.TASK5
    got = apply(
        spark,
        [
            f"{t3}\n-- Frame 0 --\na\n-- Frame 7 --\nb\n{t4}\n-- Frame 0 --\nm\n{t5}\ns",
            f"{t3}\n-- Frame 0 --\na",
            f"{t3}\n-- Frame 0 --\na\n--- Frame 1 ---\nb",
            "nothing",
            "  \n ",
            None,
            f"{t4}\n-- Frame 0 --\nm\n{t3}\n-- Frame 0 --\na",
        ],
        parse.text_response,
    )
    assert (got[0].task3_cleaned_text, got[0].task4_markdown_text, got[0].task5_summary) == (["a", "b"], ["m"], "s")
    assert (got[1].task3_cleaned_text, got[1].task4_markdown_text, got[1].task5_summary) == (["a"], [], "")
    assert got[2].task3_cleaned_text == ["a\n-", "-\nb"]
    assert got[3:6] == [None, None, None]
    assert got[6].task3_cleaned_text == [] and got[6].task4_markdown_text == [f"m\n{t3}", "a"]


COSTS = [
    ("gemini-2.5-pro-preview-05-06", 200_000, 1000, 0.26),
    ("gemini-2.5-pro-preview-05-06", 200_001, 1000, 0.5150025),
    ("gemini-9-pro", 128_000, 1000, 0.165),
    ("gemini-2.5-pro-exp-03-25", 200_000, 1000, 0.26),
    ("gemini-2.5-flash-x", 1000, 1000, 0.000375),
    ("gemini-2.0-flash-001", 1000, 1000, 0.0005),
    ("other-model", 1000, 1000, 0.0),
    ("gemini-9-pro", None, 1000, 0.0),
]


def test_cost(spark):
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(COSTS)], "k int, model string, input_tokens long, output_tokens long, want double")
    assert all(abs(r.cost_usd - r.want) < 1e-12 for r in cost.with_cost(df).collect())
    stats = cost.cost_stats(spark.createDataFrame([(1.0,), (3.0,), (None,)], "cost_usd double")).first()
    assert (stats.n, stats.total, stats["mean"], stats["std"], stats.least, stats.most) == (2, 4.0, 2.0, 1.0, 1.0, 3.0)


def test_scalars(spark):
    assert apply(spark, [0, 1023, 1024, 1536, 1048576], frames.readable_size, "long") == ["0B", "1023.0 B", "1.0 KB", "1.5 KB", "1.0 MB"]
    with pytest.raises(Exception, match="negative"):
        apply(spark, [-1], frames.readable_size, "long")
    rates = [((30.0, 1.0), 30), ((25.0, 10.0), 2), ((15.0, 10.0), 2), ((5.0, 5.0), 1), ((30.0, 0.0), 1), ((0.0, 1.0), 30)]
    assert [spark.range(1).select(frames.fps_interval(F.lit(a), F.lit(b)).alias("x")).first().x for (a, b), _ in rates] == [w for _, w in rates]
    assert apply(spark, [15, 45], lambda v: frames.second_label(v, F.lit(30.0)), "int") == [0, 2]
    names = ["frame_000123.jpg", "x_frame_7.png", "frame_12", "frm_1.png", None]
    assert apply(spark, names, frames.frame_number) == [123, 7, None, None, None]
    assert apply(spark, ["a.JPG", "a.jpeg", "a.png", "a.gif", "a"], frames.media_type) == ["image/jpeg", "image/jpeg", "image/png", None, None]
    sizes = spark.createDataFrame([(1920, 1080, 1024), (800, 600, 1024), (1920, 1080, 0)], "w int, h int, m int")
    w, h = frames.resized(F.col("w"), F.col("h"), F.col("m"))
    assert [tuple(r) for r in sizes.select(w, h).collect()] == [(1024, 576), (800, 600), (1920, 1080)]


def test_a_long_line_of_equal_beginnings_repeats_a_stretch_in_time(spark):
    import time

    line = "a " * 20_000 + "b"
    df = spark.createDataFrame([(k, line) for k in range(4)], "k int, t string").repartition(4)
    noisy = augment.Noise(1, F.col("k")).partial_lines(F.col("t"), 1.0, "random_ratio", 0.4, 0.6)
    began = time.time()
    rows = df.select(noisy.alias("t")).collect()
    assert time.time() - began < 15
    assert all(28_000 <= len(r.t.split()) <= 32_002 and set(r.t.split()) == {"a", "b"} for r in rows)
