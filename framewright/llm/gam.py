"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is described by measures of its characters, words and repetitions (``FEATURES``). The model has one
lookup table per feature and one per chosen pair of features: shallow trees are boosted cyclically, each round one
tree of at most four leaves for each feature on the residuals of a logistic loss, then, with the single features held,
the same for the pairs that best explain what is left. Trees are added into the tables, so that a
score is a sum of table entries, looked up for whole batches at once.

Fitting takes at most ``SAMPLE`` labelled rows, those with the smallest hash of their doc_id. Measures of a
text come from its bytes alone; no label, language, source or id is an input.

Nulls: a null text counts as empty and gets a score like any text; labels that are null are left out, and of a
doc_id's several labels the largest counts. Without labels of both kinds every text gets the same score. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import tokens as tk
from framewright.llm.store import settle, small_batches

SAMPLE = 20_000
FEATURES = (
    "log_words", "word_bytes", "upper", "digit", "punctuation", "non_ascii", "newline", "bar", "bang", "symbol",
    "distinct_words", "same_as_last", "top_word", "repeated_fives", "words_per_stop", "short_words", "wide_space",
)


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[np.frombuffer(chars.encode(), np.uint8)] = 1
    return out


_CLASS = {
    "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _table("0123456789"),
    "punctuation": _table("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"),
    "non_ascii": np.r_[np.zeros(128, np.uint8), np.ones(128, np.uint8)],
    "newline": _table("\n"),
    "bar": _table("|"),
    "bang": _table("!"),
    "symbol": _table("#$%&*"),
    "stop": _table(".!?"),
    "space": tk.SPACE.astype(np.uint8),
}


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The features of a block of texts, one row per text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    count = {k: np.zeros(n) for k in _CLASS}
    if len(some):
        for k, table in _CLASS.items():
            count[k][some] = np.add.reduceat(table[data], offsets[some], dtype=np.int64)
    hashes, at = tk.words(data, offsets)
    words = np.diff(at)
    out = np.zeros((n, len(FEATURES)))
    col = {k: out[:, i] for i, k in enumerate(FEATURES)}
    m, b = np.maximum(words, 1), np.maximum(size, 1)
    col["log_words"][:] = np.log1p(words)
    col["word_bytes"][:] = (size - count["space"]) / m
    for k in ("upper", "digit", "punctuation", "non_ascii", "newline"):
        col[k][:] = count[k] / b
    for k in ("bar", "bang", "symbol"):
        col[k][:] = count[k] / m
    col["words_per_stop"][:] = np.log1p(words / (1 + count["stop"]))
    col["wide_space"][:] = count["space"] / m
    same = np.append(hashes[1:] == hashes[:-1], False) if len(hashes) else np.zeros(0, bool)
    for i, (u, v) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if u == v:
            continue
        _, times = np.unique(hashes[u:v], return_counts=True)
        col["distinct_words"][i] = len(times) / (v - u)
        col["top_word"][i] = times.max() / (v - u)
        col["same_as_last"][i] = same[u : v - 1].mean() if v - u > 1 else 0
    five = tk.shingles(hashes, at)
    col["repeated_fives"][:] = [1 - len(s) / max(1, w - 4) if w else 0 for s, w in zip(five, words.tolist(), strict=True)]
    col["short_words"][:] = count["space"] / b
    return out


def _leaves(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A shallow tree over the bins of one feature: the value of each bin."""
    cuts, g, h = [0, len(grad)], np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(hess))
    part = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                mid = np.arange(a + 1, b)
                gain = part(a, mid) + part(mid, b) - part(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(mid[k])))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def _quarters(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """A tree of one cut along each of two features: the value of each cell and the gain."""
    g, h = np.pad(grad.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(hess.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = grad.shape
    x, y = np.arange(1, n)[:, None], np.arange(1, m)[None, :]
    gain, value = np.zeros((n - 1, m - 1)), []
    for a, b, c, d in ((0, x, 0, y), (0, x, y, m), (x, n, 0, y), (x, n, y, m)):
        box = lambda t: t[b, d] - t[a, d] - t[b, c] + t[a, c]  # noqa: B023, E731
        gain = gain + box(g) ** 2 / (box(h) + ridge)
        value.append(box(g) / (box(h) + ridge))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty((n, m))
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = (v[i, j] for v in value)
    return out, float(gain[i, j])


@dataclass
class Gam:
    """Bin edges and tables; ``score`` adds up what the bins say."""

    base: float
    edges: list[np.ndarray]
    one: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    two: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)], 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if len(self.one):
            fine, rough = self.bins(x, self.edges), self.bins(x, self.coarse)
            for k, t in enumerate(self.one):
                out += t[fine[:, k]]
            for (i, j), t in zip(self.pairs, self.two, strict=True):
                out += t[rough[:, i], rough[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, leaves: int = 4, bins: int = 64, pairs: int = 8, ridge: float = 5.0) -> Gam:
    """Boost the tables on features ``x`` and labels ``y`` (0 or 1)."""
    if not len(y) or y.min() == y.max():
        return Gam(0.0 if not len(y) else (4.0 if y[0] else -4.0), [], [])
    cut = lambda n: [np.unique(np.quantile(x[:, k], np.linspace(0, 1, n + 1)[1:-1])) for k in range(x.shape[1])]
    model = Gam(float(np.log(y.mean() / (1 - y.mean()))), cut(bins), [], [], cut(8), [])
    fine, rough = model.bins(x, model.edges), model.bins(x, model.coarse)
    model.one = [np.zeros(len(e) + 1) for e in model.edges]
    f = np.full(len(y), model.base)
    p = lambda: 1 / (1 + np.exp(-f))
    for _ in range(rounds):
        for k, t in enumerate(model.one):
            q = p()
            step = rate * _leaves(np.bincount(fine[:, k], y - q, len(t)), np.bincount(fine[:, k], q * (1 - q), len(t)), leaves, ridge)
            t += step
            f += step[fine[:, k]]
    q = p()
    cell = lambda i, j, w: np.bincount(rough[:, i] * (len(model.coarse[j]) + 1) + rough[:, j], w, (len(model.coarse[i]) + 1) * (len(model.coarse[j]) + 1)).reshape(len(model.coarse[i]) + 1, -1)
    wide = [k for k, e in enumerate(model.coarse) if len(e)]
    gains = sorted(((_quarters(cell(i, j, y - q), cell(i, j, q * (1 - q)), ridge)[1], i, j) for i in wide for j in wide if i < j), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:pairs]]
    model.two = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(rounds // 3):
        for (i, j), t in zip(model.pairs, model.two, strict=True):
            q = p()
            step = rate * _quarters(cell(i, j, y - q), cell(i, j, q * (1 - q)), ridge)[0]
            t += step
            f += step[rough[:, i], rough[:, j]]
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in tk.blocks(batch.column("text")):
            flat = pa.array(measure(data, offsets).ravel())
            rows = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * len(FEATURES)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("y").slice(i, j - i), rows], names=["y", "x"])


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the doc_id as text modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def labelled(docs: DataFrame, labels: DataFrame, label: str, kept: Column, limit: int) -> DataFrame:
    """(doc_id, text, y) of at most ``limit`` labelled documents, the smallest hashes of doc_id first; of a doc_id's several texts the least."""
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    marks = marks.filter(kept).groupBy("doc_id").agg(F.max("y").alias("y"))
    marks = marks.orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(limit)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    met = texts.join(F.broadcast(marks), "doc_id")  # at most `limit` rows of 12 bytes
    return met.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, kept: Column, limit: int = SAMPLE) -> Gam:
    small_batches(docs.sparkSession)
    sample = settle(labelled(docs, labels, "quality", kept, limit).select("y", "text").mapInArrow(_features, "y int, x array<double>"))
    rows = sorted((r.y, tuple(r.x)) for r in sample.toLocalIterator())  # in an order that no partition changes
    return fit(np.array([r[1] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r[0] for r in rows], float))


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """(doc_id, score) of every whole text."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in tk.blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(sent.value.score(measure(data, offsets)))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
