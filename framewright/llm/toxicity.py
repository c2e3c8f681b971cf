"""Toxicity: a counterfactually regularised linear classifier over the words of a text.

A text's features are which words, and which beginnings of longer words (``HEADS`` bytes, so that a stem counts in all its
forms), of the model's vocabulary it has (words: runs of letters, digits and non-ASCII characters, lower-cased). The vocabulary is chosen on the labelled sample: the words whose presence tells the
two labels apart by more than the best of so many words would by chance (that test alone decides, however many pass it), and all identity terms. In every labelled text that names a group, each identity
term is swapped for the other terms of its set; besides the logistic loss, training penalises the squared
change of the score under those swaps, so that naming a group carries no weight of its own. A swap changes all features
of a term, its beginnings included, but for those that other words of the text have as well.

Fitting takes at most ``SAMPLE`` labelled rows, a parameter; the vocabulary is a part of their words.

Nulls: a null text counts as empty and gets the score of a text without any word of the vocabulary; null labels are
left out, and of a doc_id's several labels the largest counts. Without labels of both kinds every text gets the same
score. Long texts are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import tokens as tk
from framewright.llm.gam import labelled
from framewright.llm.store import settle, small_batches, table

SAMPLE = 20_000
HEADS = (4, 5, 6)
#: Sets of identity terms whose members are swapped for one another.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens"),
    ("old", "young"),
    ("blind", "deaf", "disabled"),
)
U = np.uint64


@dataclass
class Model:
    keys: np.ndarray
    """Sorted word hashes."""
    weight: np.ndarray
    base: float

    def logit(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, cols = present(data, offsets, self.keys)
        return self.base + np.bincount(rows, self.weight[cols], len(offsets) - 1)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(data, offsets), -30, 30)))


def present(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words of ``keys`` each text has: pairs of row and column, each once."""
    return _present(*tk.words(data, offsets, tk.NOT_ALNUM, HEADS), keys)


def _present(hashes: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, at = hashes.ravel(), at * hashes.shape[1]
    col = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.flatnonzero(keys[col] == hashes)
    row = np.searchsorted(at, hit, "right") - 1
    pair = np.unique(row * len(keys) + col[hit])
    return pair // len(keys), pair % len(keys)


def _named(hashes: np.ndarray, at: np.ndarray, keys: np.ndarray, terms: np.ndarray, watched: np.ndarray) -> tuple[list[list[int]], list[list[list[int]]]]:
    """Each text's identity terms, and for each of them the columns of ``watched`` that the text's other words have."""
    out: tuple[list, list] = ([[] for _ in at[1:]], [[] for _ in at[1:]])
    own = np.isin(hashes[:, 0], terms)
    near = np.flatnonzero(own | np.isin(hashes, keys[watched]).any(1))
    text = np.searchsorted(at, near, "right") - 1
    for k in np.unique(text[own[near]]).tolist():
        mine = hashes[near[text == k]]
        for term in np.intersect1d(mine[:, 0], terms):
            rest = mine[mine[:, 0] != term]
            out[0][k].append(int(term.view(np.int64)))
            out[1][k].append(watched[np.isin(keys[watched], rest)].tolist())
    return out


def fit(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, width: int, swaps: list[list[int]], fairness: float = 10.0, ridge: float = 1e-4, steps: int = 300, changes: Counter | None = None) -> tuple[np.ndarray, float]:
    """Weights and base of the penalised logistic loss, by gradient steps of adapted length.

    ``swaps``: sets of columns that are exchanged for one another. Exchanging term s for t in a labelled text changes
    its score by weight[t] - weight[s]; the squared changes of all such pairs of texts are averaged.
    ``changes``: instead of these, the columns gained and lost by a swap, and how many pairs of texts differ so.
    """
    n = len(y)
    w, base = np.zeros(width), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    if changes is None:
        seen = np.bincount(cols, minlength=width)
        changes = Counter({((t,), (s,)): int(seen[s]) for group in swaps for s in group for t in group if s != t and seen[s]})
    times = np.array(list(changes.values()), float)
    differs = [(p, c, sign) for p, sides in enumerate(changes) for side, sign in zip(sides, (1.0, -1.0), strict=True) for c in side]
    pair, moved, sign = (np.array([d[k] for d in differs], kind) for k, kind in enumerate((np.int64, np.int64, float)))
    total = max(1, times.sum())
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    theta, m, v = np.append(w, base), np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, steps + 1):
        w = theta[:-1]
        logit = theta[-1] + np.bincount(rows, w[cols], n)
        lost = balance * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n
        change = 2 * fairness * np.bincount(pair, sign * w[moved], len(times)) * times / total
        grad = np.bincount(cols, lost[rows], width) + ridge * w + np.bincount(moved, sign * change[pair], width)
        step = np.append(grad, lost.sum())
        m, v = 0.9 * m + 0.1 * step, 0.99 * v + 0.01 * step**2
        rate = 0.1 * (1 - k / (steps + 1))
        theta = theta - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta[:-1], float(theta[-1])


def swapped(named: Iterator[tuple[int, list[int]]], features: dict[int, set[int]], groups: list[list[int]]) -> Counter:
    """Columns gained and lost when a term of a text is swapped for another of its set, with the number of such pairs.

    ``named``: terms of texts, each with the columns that the other words of the text have.
    """
    changes: Counter = Counter()
    for term, others in named:
        for group in groups:
            for t in group if term in group else ():
                if t != term:
                    gained, lost = features[t] - features[term], features[term] - features[t]
                    changes[tuple(sorted(gained.difference(others))), tuple(sorted(lost.difference(others)))] += 1
    return changes


def identity_features() -> dict[int, np.ndarray]:
    """Hash of each identity term: those of the term and of its beginnings."""
    found = {}
    for group in IDENTITY:
        for term in group:
            hashes, _ = tk.words(*tk.text_bytes(pa.array([term])), tk.NOT_ALNUM, HEADS)
            found[int(hashes[0, 0])] = hashes[0][hashes[0] != 0]
    return found


def identity_keys() -> list[list[int]]:
    return [[tk.word_hash(w) for w in group] for group in IDENTITY]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = np.asarray(batch.column("y"))
        for i, j, data, offsets in tk.blocks(batch.column("text")):
            hashes, at = tk.words(data, offsets, tk.NOT_ALNUM, HEADS)
            own = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            own = [o[o != 0] for o in own]
            flat = np.concatenate([*own, np.zeros(0, U)])
            toxic = np.repeat(y[i:j], [len(o) for o in own])
            key, back = np.unique(flat, return_inverse=True)
            n = np.bincount(back, minlength=len(key))
            bad = np.bincount(back, toxic, len(key))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(bad.astype(np.int64))], names=["key", "n", "bad"])


def train(docs: DataFrame, labels: DataFrame, kept: Column, limit: int = SAMPLE, fairness: float = 10.0) -> Model:
    """Choose the vocabulary on the sample, then fit its weights."""
    small_batches(docs.sparkSession)
    sample = table(labelled(docs, labels, "toxic", kept, limit).select("doc_id", "y", "text"), "toxic-sample")
    total, bad = sample.agg(F.count("y"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < bad < total:
        return Model(np.zeros(0, U), np.zeros(0), 0.0 if not total else (4.0 if bad else -4.0))
    counts = sample.select("y", "text").mapInArrow(_word_counts, "key long, n long, bad long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rate = bad / total
    z = F.abs(F.col("bad") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate) + 1)
    counts = settle(counts)
    least = max(4.0, (2 * np.log(max(2, counts.count()))) ** 0.5)  # what the best of so many words reaches by chance
    chosen = counts.filter(z >= least).select("key")
    groups = identity_keys()
    keys = np.unique(np.array([r.key for r in chosen.collect()] + [k - 2**64 if k >= 2**63 else k for g in groups for k in g], np.int64).view(U))

    features = {k: set(np.flatnonzero(np.isin(keys, f)).tolist()) for k, f in identity_features().items()}
    terms, watched = np.array(sorted(features), U), np.array(sorted(set().union(*features.values())), np.int64)

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in tk.blocks(batch.column("text")):
                hashes, at = tk.words(data, offsets, tk.NOT_ALNUM, HEADS)
                rows, cols = _present(hashes, at, keys)
                named, others = _named(hashes, at, keys, terms, watched)
                ends = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
                x = pa.ListArray.from_arrays(pa.array(ends), pa.array(cols.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), batch.column("y").slice(i, j - i), x, pa.array(named, pa.list_(pa.int64())), pa.array(others, pa.list_(pa.list_(pa.int32())))], names=["doc_id", "y", "x", "named", "others"])

    found = settle(sample.mapInArrow(flags, "doc_id long, y int, x array<int>, named array<long>, others array<array<int>>"))
    got = sorted((r.doc_id, r.y, r.x, r.named, r.others) for r in found.toLocalIterator())
    sizes = [len(g[2]) for g in got]
    rows = np.repeat(np.arange(len(got)), sizes)
    cols = np.concatenate([np.array(g[2], np.int64) for g in got])
    changes = swapped(((n % 2**64, o) for g in got for n, o in zip(g[3], g[4], strict=True)), features, groups)
    weight, base = fit(rows, cols, np.array([g[1] for g in got], float), len(keys), [], fairness, changes=changes)
    return Model(keys, weight, base)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in tk.blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(sent.value.score(data, offsets))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the texts whose score reaches ``threshold``; all columns stay, and no row is joined."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            ok = [sent.value.score(data, offsets) < threshold for _, _, data, offsets in tk.blocks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate([*ok, np.zeros(0, bool)])))

    return docs.mapInArrow(run, docs.schema)
