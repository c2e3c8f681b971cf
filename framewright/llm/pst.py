"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are words (runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased), then one end per text. Words seen at least
``LEAST`` times in training are symbols of their own; all others share the symbol RARE, whose
members divide its probability as (count + 1) / (their counts + their number + 1), an unseen word included.

The tree holds contexts of up to ``DEPTH`` symbols, with an entry for each symbol that follows them at least ``LEAST`` times. A context is retained if the distribution after it
differs from that after its longest retained suffix by more than the description of its own entries costs:
sum n * ln(P(x | context) / P(x | suffix)) > entries / 2 * ln(n(context)). Distributions are smoothed by taking a discount from
each entry; the mass of all that has no entry is divided as the suffix's distribution divides it; the root is the add-one
unigram model, so that probabilities over all words (and one unseen) sum to one. A token is scored in the state of the longest retained suffix.
``LEAST`` is a count, not a share, and nothing else bounds the tree, so it grows with the corpus.

1. Each block of texts (``BLOCK`` bytes) sends its distinct words with their counts, cut by hash into parts. A part numbers its
   symbols and answers each block with the numbers and whole counts of its words.
2. Each block sends every position with its ``DEPTH`` symbols before, dealt by the symbol just before. All contexts that end in a symbol, and all that
   follows them, so meet in one part, with the whole branch of the tree below that symbol: it counts, tests from the shortest context to the longest, and scores its positions, and
   sends each block the sums of its texts.
3. A symbol with over half the positions of a part has a part of its own. One with over ``HOT`` times as many is dealt by the two symbols before. Its own followers are then counted
   beforehand: blocks send their pairs, which are dealt by both symbols, and a row of sums per such symbol decides its test.

A part so holds a bounded number of positions (about ``PART``, or ``HOT`` times as many of one symbol), unless one pair of words has more. Counts are exact at any size. Words and
numbers are 64-bit hashes. Texts are read and cut into blocks twice; if the blocks differ, as those of a source that changes or of rows
in another order out of a shuffle may, the job fails, and the texts have to be written or sorted before.

Nulls: a null text is empty and has the end as its only token; a null doc_id counts as the empty text for the fold.
Repeated rows count as often as they occur. Without training rows every token is unseen. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import tokens as tk
from framewright.llm.store import forget, small_batches, table, writers

U = np.uint64
LEAST = 2
DEPTH = 3
DISCOUNT = 0.75
BLOCK = 12 << 20
PART = 2_000_000
HOT = 2
END = U(0x454E44)
NONE, RARE, END_NUMBER, FIRST = 0, 1, 2, 3
"""Numbers of symbols: none before a text's first word, rare words, the end; words have those from FIRST."""

ASKED = "block long, part long, hashes binary, n binary, tokens long"
ANSWER = "block long, part long, numbers binary, n binary, tokens long, total long, distinct long, ends long, rare long, rare_words long, top long"
BLOCKS = "block long, docs array<long>, train binary, lens binary, words binary, keys binary"
PAIRS = "block long, part long, last binary, symbol binary, n binary, mass binary"
PAIRED = "block long, part long, n binary, symbol long, entries long, held double, mass double, gain double"
DEALT = "block long, part long, docs array<long>, train binary, sums binary, positions binary, n long"
SCORED = "block long, docs array<long>, train binary, sums binary, places binary"
RESULT = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"
ENTRIES = "context array<long>, symbol long, n long, ln double"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _table(schema: str, columns: list) -> pa.Table:
    return pa.Table.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns], names=_names(schema))


def _binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


def _longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def _planes(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on, which compresses sorted or small numbers."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _numbers(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _expand(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _pack(ids: np.ndarray) -> bytes:
    """Small numbers as planes of as many bytes as the largest needs, after that number of bytes; compressed."""
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    return _squeeze(bytes([width]) + b"".join(((ids >> (8 * k)) & 255).astype(np.uint8).tobytes() for k in range(width)))


def _unpack(packed: bytes) -> np.ndarray:
    raw = _expand(packed)
    width = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1)
    out = planes[0].astype(np.int64)
    for k in range(1, width):
        out |= planes[k].astype(np.int64) << (8 * k)
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, list[np.ndarray]]]:
    """Blocks of texts: number, doc_ids, whether each is for training, and each one's word hashes with the end."""
    block, size, held = TaskContext.get().partitionId() << 24, 0, []

    def flush() -> tuple[int, list, np.ndarray, list[np.ndarray]]:
        return block, [i for h in held for i in h[0]], np.array([t for h in held for t in h[1]], bool), [w for h in held for w in h[2]]

    for batch in batches:
        ids, train = batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("train").to_pylist()
        for i, j, data, offsets in tk.blocks(batch.column("text")):
            hashes, at = tk.words(data, offsets)
            held.append((ids[i:j], train[i:j], [np.append(hashes[a:b], END) for a, b in zip(at[:-1], at[1:], strict=True)]))
            size += len(data) + j - i
            if size >= BLOCK:
                yield flush()
                block, size, held = block + 1, 0, []
    if held:
        yield flush()


def _cut(part: np.ndarray, parts: int, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Rows dealt to parts: each part that has some, with its columns as bytes."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    columns = [c[order] for c in columns]
    for k in np.flatnonzero(np.diff(ends)).tolist():
        yield k, [_planes(c[ends[k] : ends[k + 1]]) for c in columns]


def _pasted(pieces: list[tuple[int, np.ndarray]], part: np.ndarray, kind: type) -> np.ndarray:
    """The answers of the parts, (part, values), back in the order of what was dealt."""
    out = np.empty(len(part), kind)
    values = [v for _, v in sorted(pieces, key=lambda p: p[0])]
    joined = np.concatenate([np.zeros(0, kind), *values])
    if len(joined) != len(part):
        raise ValueError("the texts are not those that were counted; write them to a table first")
    out[np.argsort(part, kind="stable")] = joined
    return out


@contextmanager
def _whole_groups(spark: SparkSession) -> Iterator[None]:
    """Rows of whole blocks go to Python a few at a time, small ones many."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": "65536", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@dataclass
class Hot:
    """Symbols that are spread over parts, sorted, with what their test decided."""

    symbol: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    kept: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    size: np.ndarray = field(default_factory=lambda: np.zeros(0))
    off: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slack: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def at(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``symbol`` are hot, and where they are here."""
        if not len(self.symbol):
            return np.zeros(len(symbol), bool), np.zeros(len(symbol), np.int64)
        place = np.minimum(np.searchsorted(self.symbol, symbol), len(self.symbol) - 1)
        return self.symbol[place] == symbol, place


@dataclass
class Corpus:
    """The corpus-wide sums, and where positions are dealt."""

    tokens: int
    total: int
    distinct: int
    rare: int
    rare_words: int
    word_parts: int
    parts: int
    kind: str
    least: int
    depth: int
    discount: float
    hot: Hot = field(default_factory=Hot)
    large: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    """Symbols, sorted, that have a part of their own after the ``parts`` of all others."""

    @property
    def norm(self) -> float:
        return float(self.total + self.distinct + 1)


class Block:
    """A block's tokens with their symbols and counts."""

    def __init__(self, left: pa.Table, right: pa.Table, corpus: Corpus) -> None:
        row = left.to_pylist()[0]
        self.block, self.docs, self.train = row["block"], row["docs"], np.frombuffer(row["train"], bool)
        self.lens = np.frombuffer(row["lens"], np.int64)
        keys, local = np.frombuffer(row["keys"], U), _unpack(row["words"])
        order = np.argsort(keys)  # as they were asked for
        part, back = (keys[order] % U(corpus.word_parts)).astype(np.int64), np.argsort(order)
        pieces = [(p["part"], _unpack(p["numbers"]), _unpack(p["n"])) for p in right.to_pylist() if p["numbers"] is not None]
        number = _pasted([(p, v) for p, v, _ in pieces], part, np.int64)[back]
        count = _pasted([(p, v) for p, _, v in pieces], part, np.int64)[back]
        rare = number == RARE
        mass = np.where(rare, corpus.rare + corpus.rare_words, count)
        inside = np.where(rare, np.log10((count + 1) / (corpus.rare + corpus.rare_words + 1.0)), 0.0)
        self.symbol, self.mass = number[local], mass[local]
        self.count, self.inside = count[local], inside[local]
        self.first = np.cumsum(self.lens) - self.lens
        self.text = np.repeat(np.arange(len(self.lens)), self.lens)
        self.place = np.arange(len(local)) - self.first[self.text]
        self.trained = self.train[self.text]

    def sums(self, corpus: Corpus) -> np.ndarray:
        """Per text: tokens, known tokens, base score, and the score of what needs no context (all shares inside RARE, and the first token)."""
        base = np.log10((self.count + 1) / corpus.norm)
        known = (self.count > 0).astype(float)
        own = np.add.reduceat(self.inside, self.first) + np.log10((self.mass[self.first] + 1) / corpus.norm)
        return np.stack([self.lens.astype(float), np.add.reduceat(known, self.first), np.add.reduceat(base, self.first), own])


def _ask_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, train, lists in _texts(batches):
            lens = np.array([len(w) for w in lists], np.int64)
            keys, back = np.unique(np.concatenate(lists), return_inverse=True)
            n = np.bincount(back, np.repeat(train, lens), len(keys)).astype("<u4")
            pieces = list(_cut((keys % U(parts)).astype(np.int64), parts, [keys, n]))
            tokens = [int(lens.sum()), *[0] * (len(pieces) - 1)]
            columns = [_longs([block] * len(pieces)), _longs([k for k, _ in pieces]), *(_binary([c[i] for _, c in pieces]) for i in (0, 1)), _longs(tokens)]
            yield pa.RecordBatch.from_arrays(columns, names=_names(ASKED))

    return run


def _number_words(parts: int, least: int):
    """Of a part: the number and whole count of each word, for every block that asked; frequent words have small numbers."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        hashes = [_numbers(x.as_py(), "<u8") for x in group.column("hashes")]
        times = np.concatenate([_numbers(x.as_py(), "<u4") for x in group.column("n")])
        word, back = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(back, times, len(word)).astype(np.int64)
        end = word == END
        named = (total >= least) & ~end
        order = np.lexsort((word, -total))
        order = order[named[order]]
        number = np.full(len(word), RARE, np.int64)
        number[order] = FIRST + np.arange(len(order)) * parts + part
        number[end] = END_NUMBER
        seldom = total[(total > 0) & ~named & ~end]
        tokens = sum(group.column("tokens").to_pylist())
        facts = [tokens, int(total.sum()), int((total > 0).sum()), int(total[end].sum()), int(seldom.sum()), len(seldom), int(number.max())]
        n, ends = len(hashes), np.cumsum([len(h) for h in hashes])
        cut = [back[e - len(h) : e] for e, h in zip(ends.tolist(), hashes, strict=True)]
        answers = [_binary([_pack(x[c]) for c in cut]) for x in (number, total)]
        return _table(ANSWER, [group.column("block"), group.column("part"), *answers, *(_longs([f, *[None] * (n - 1)]) for f in facts)])

    return run


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same blocks again, whole: word numbers and the block's words."""
    for block, docs, train, lists in _texts(batches):
        lens = np.array([len(w) for w in lists], np.int64)
        keys, back = np.unique(np.concatenate(lists), return_inverse=True)
        order = np.argsort(-np.bincount(back), kind="stable")
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        row = (train.tobytes(), lens.tobytes(), _pack(place[back]), keys[order].tobytes())
        yield pa.RecordBatch.from_arrays([_longs([block]), pa.array([docs], pa.list_(pa.int64())), *(_binary([x]) for x in row)], names=_names(BLOCKS))


def _decisions(m: np.ndarray, held: np.ndarray, mass: np.ndarray, gain: np.ndarray, size: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts with ``m`` entries of ``held`` together, whose suffix gives them ``mass``: kept, the discount, ln of what the suffix's other probabilities are multiplied by."""
    size = np.maximum(size, 1.0)
    rest, rest_up = size - held, np.maximum(1e-12, 1 - mass)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gain - held * np.log(size) + np.where(rest > 0.5, rest * np.log(rest / size / rest_up), 0.0)
        everything = rest_up < 1e-9  # every symbol has an entry: nothing to set aside
        off = np.where(everything, 0.0, discount)
        free = np.where(everything, 1.0, (1 - (held - m * off) / size) / rest_up)
        return (m > 0) & (gain > m / 2 * np.log(np.maximum(size, 2.0))), off, np.log(free)


def _pairs(group: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct pairs, in order: where one of each is, each row's pair, and how many."""
    if symbol.max(initial=0) >> 32:
        symbol = np.unique(symbol, return_inverse=True)[1]
    key = group.astype(U)
    key <<= U(32)
    key |= symbol.astype(U)
    order = np.argsort(key)
    key = key[order]
    begins = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=begins[1:])
    del key
    at = order[begins]
    back = np.empty(len(order), np.int32)
    back[order] = np.cumsum(begins, dtype=np.int32) - np.int32(1)
    return at, back, len(at)


def _branch(before: list[np.ndarray], symbol: np.ndarray, value: np.ndarray, train: np.ndarray, paired: np.ndarray | None, corpus: Corpus, entries: list | None = None) -> np.ndarray:
    """ln of the probability of each position's symbol, given all positions after the same symbols; ``value`` has it without context, and is changed.

    ``paired``: how often a hot symbol is followed by the position's symbol in all. ``entries``: gets the retained contexts' entries.
    """
    alive = np.arange(len(symbol), dtype=np.int32)
    entry = _pairs(np.zeros(len(symbol), np.int8), symbol)[1]
    context = np.zeros(len(symbol), np.int32)
    for length, last in enumerate(before, 1):
        there = last[alive] != NONE
        if not there.all():
            alive, entry, context = alive[there], entry[there], context[there]
        del there
        if not len(alive):
            break
        own = last[alive]
        some_of, context, contexts = _pairs(context, own)
        some, entry, n_entries = _pairs(entry, own)
        hot, place = corpus.hot.at(own[some_of]) if length == 1 else (np.zeros(contexts, bool), None)
        del own
        weight = train[alive]
        n, size = np.bincount(entry, weight, n_entries), np.bincount(context, weight, contexts)
        del weight
        above = context[some]
        if hot.any():
            n = np.where(hot[above], paired[alive[some]], n)
        frequent, up = n >= corpus.least, value[alive[some]]
        sums = lambda x: np.bincount(above[frequent], x, contexts)
        times, above_up = n[frequent], up[frequent]
        m, held, shared, gain = sums(None), sums(times), sums(np.exp(above_up)), sums(times * (np.log(times) - above_up))
        kept, off, slack = _decisions(m, held, shared, gain, size, corpus.discount)
        if hot.any():
            at = place[hot]
            kept[hot], off[hot], slack[hot], size[hot] = corpus.hot.kept[at], corpus.hot.off[at], corpus.hot.slack[at], corpus.hot.size[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            chance = np.log((n - off[above]) / size[above])
        inside = kept[context]
        at, e, c = alive[inside], entry[inside], context[inside]
        value[at] = np.where(frequent[e], chance[e], value[at] + slack[c])
        if entries is not None:
            names = lambda p: [int(b[alive[p]]) for b in before[:length][::-1]]  # noqa: B023, E731
            for e in np.flatnonzero(frequent & kept[above]).tolist():
                entries.append((names(some[e]), int(symbol[alive[some[e]]]), int(n[e]), float(chance[e])))
            for c in np.flatnonzero(kept).tolist():
                entries.append((names(some_of[c]), None, int(size[c]), float(slack[c])))
        more = (m > 0)[context]  # a longer context can have frequent entries only where its suffix has
        alive, entry, context = alive[more], entry[more], context[more]
    return value


def _part_of(last: np.ndarray, second: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Positions are dealt by the symbol before; by the two before if that is hot."""
    key = last.astype(U) + U(1)
    hot, _ = corpus.hot.at(last)
    key = np.where(hot, key + tk.mix(second.astype(U) + U(7)), key)
    part = (tk.mix(key) % U(corpus.parts)).astype(np.int64)
    if len(corpus.large):
        place = np.minimum(np.searchsorted(corpus.large, last), len(corpus.large) - 1)
        part = np.where(corpus.large[place] == last, corpus.parts + place, part)
    return part


def _deal(corpus: Corpus):
    """A block's positions for the parts, and its texts' sums."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("the texts are not those that were counted; write them to a table first")
        b = Block(left, right, corpus)
        at = np.flatnonzero(b.place > 0)
        before = [np.where(b.place[at] >= k, b.symbol[at - np.minimum(k, at)], NONE) for k in range(1, corpus.depth + 1)]
        symbol, mass = b.symbol[at], b.mass[at]
        hot, _ = corpus.hot.at(before[0])
        paired = np.zeros(len(at) if len(corpus.hot.symbol) else 0, np.int64)
        if hot.any():
            where = np.flatnonzero(hot)
            found = [(p["part"], _numbers(p["n"], "<i8")) for p in right.to_pylist() if p["numbers"] is None]
            first, back, part = _hot_pairs(before[0][where], symbol[where], corpus)
            paired[where] = _pasted(found, part, np.int64)[back]
        place = b.text[at] << 1 | b.trained[at]
        part = _part_of(before[0], before[1] if corpus.depth > 1 else before[0], corpus)
        order = np.lexsort((symbol, before[0], part))
        ends = np.searchsorted(part[order], np.arange(corpus.parts + len(corpus.large) + 1))
        rows = []
        del hot
        columns = [x[order].astype(kind) for x, kind in zip((*before, symbol, mass, place, paired), _kinds(corpus), strict=False)]
        del before, symbol, mass, place, paired, order
        for k in np.flatnonzero(np.diff(ends)).tolist():
            piece = [c[ends[k] : ends[k + 1]] for c in columns]
            mass = corpus.depth + 1
            piece[mass] = piece[mass][np.unique(piece[corpus.depth], return_index=True)[1]]  # once per symbol
            for c in (0, corpus.depth):  # sorted, so their differences are small
                piece[c] = np.diff(piece[c], prepend=piece[c].dtype.type(0))
            order = [*range(mass), *range(mass + 1, len(piece)), mass]
            rows.append((k, _squeeze(b"".join(_planes(piece[c]) for c in order)), len(piece[0])))
        n = len(rows)
        head = [_longs([b.block] * (n + 1)), _longs([int(tk.mix(np.array([b.block], U))[0] % U(corpus.parts)), *[k for k, _, _ in rows]]), pa.array([b.docs, *[None] * n], pa.list_(pa.int64()))]
        tail = [_binary([b.train.tobytes(), *[None] * n]), _binary([b.sums(corpus).tobytes(), *[None] * n]), _binary([None, *[x for _, x, _ in rows]]), _longs([0, *[m for _, _, m in rows]])]
        return _table(DEALT, head + tail)

    return run


def _kinds(corpus: Corpus) -> list[str]:
    """The columns of dealt positions: symbols before, symbol, its count for the root, text and fold; the pair's count if any symbol is hot.

    A piece has the count for the root last, once for each distinct symbol.
    """
    return [*[corpus.kind] * (corpus.depth + 1), "<i8", "<u4", *["<i8"] * bool(len(corpus.hot.symbol))]


def _opened(group: pa.Table, corpus: Corpus) -> tuple[list[dict], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """A part's pieces, and all their positions: symbols before, symbol, ln of its probability without context, text and fold, count of the pair."""
    kinds = _kinds(corpus)
    pieces = [{"row": k, "block": b, "n": n} for k, (b, n) in enumerate(zip(group.column("block").to_pylist(), group.column("n").to_pylist(), strict=True)) if n]
    total, done = sum(p["n"] for p in pieces), 0
    columns = [np.empty(total, float if c == corpus.depth + 1 else kind) for c, kind in enumerate(kinds)]
    for p in pieces:
        raw, at = _expand(group.column("positions")[p["row"]].as_py()), 0
        for c, kind in enumerate(kinds):
            if c == corpus.depth + 1:
                continue
            size = np.dtype(kind).itemsize * p["n"]
            x = _numbers(raw[at : at + size], kind)
            columns[c][done : done + p["n"]] = np.cumsum(x, dtype=x.dtype) if c in (0, corpus.depth) else x
            at += size
        _, back = np.unique(columns[corpus.depth][done : done + p["n"]], return_inverse=True)
        columns[corpus.depth + 1][done : done + p["n"]] = np.log((_numbers(raw[at:], "<i8") + 1) / corpus.norm)[back]
        done += p["n"]
    *before, symbol = columns[: corpus.depth + 1]
    return pieces, before, symbol, *columns[corpus.depth + 1 : corpus.depth + 3], columns[corpus.depth + 3] if len(columns) > corpus.depth + 3 else None


def _score_part(corpus: Corpus):
    """A part's sums for the texts of each block; the texts' own sums pass through."""

    def run(group: pa.Table) -> pa.Table:
        pieces, before, symbol, value, place, paired = _opened(group, corpus)
        value = _branch(before, symbol, value, (place & 1).astype(bool), paired, corpus)
        value /= np.log(10)
        del before, symbol, paired
        out, at = [(r["block"], r["docs"], r["train"], r["sums"], None) for r in group.select(["block", "docs", "train", "sums"]).to_pylist() if r["docs"] is not None], 0
        for p in pieces:
            text = place[at : at + p["n"]] >> 1
            some = np.unique(text)
            sums = np.bincount(np.searchsorted(some, text), value[at : at + p["n"]])
            out.append((p["block"], None, None, sums.tobytes(), some.astype("<u4").tobytes()))
            at += p["n"]
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
        return _table(SCORED, [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)])

    return run


def _sum_block(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    own = next(r for r in rows if r["docs"] is not None)
    tokens, known, base, score = np.frombuffer(own["sums"], np.float64).reshape(4, -1).copy()
    for r in rows:
        if r["places"] is not None:
            score[np.frombuffer(r["places"], "<u4")] += np.frombuffer(r["sums"], np.float64)
    columns = [_longs(own["docs"]), pa.array(np.frombuffer(own["train"], bool)), _longs(tokens.astype(np.int64)), _longs(known.astype(np.int64)), pa.array(base), pa.array(score)]
    return _table(RESULT, columns)


def _hot_pairs(last: np.ndarray, symbol: np.ndarray, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a hot symbol and its follower: where each is first, each row's pair, and the part it is dealt to."""
    order = np.unique(last, return_inverse=True)[1]
    first, back, _ = _pairs(order, symbol)
    part = (tk.mix(last[first].astype(U) * U(0x9E3779B97F4A7C15) + symbol[first].astype(U)) % U(corpus.parts)).astype(np.int64)
    return first, back, part


def _ask_pairs(corpus: Corpus):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left, right, corpus)
        at = np.flatnonzero(b.place > 0)
        at = at[corpus.hot.at(b.symbol[at - 1])[0]]
        last, symbol = b.symbol[at - 1], b.symbol[at]
        first, back, part = _hot_pairs(last, symbol, corpus)
        n = np.bincount(back, b.trained[at], len(first)).astype(np.int64)
        pieces = list(_cut(part, corpus.parts, [last[first], symbol[first], n, b.mass[at][first]]))
        return _table(PAIRS, [_longs([b.block] * len(pieces)), _longs([k for k, _ in pieces]), *(_binary([c[i] for _, c in pieces]) for i in range(4))])

    return run


def _sum_pairs(corpus: Corpus):
    """The whole count of each pair for the blocks that have it, and per hot symbol the sums of its test."""

    def run(group: pa.Table) -> pa.Table:
        columns = [[_numbers(x.as_py(), "<i8") for x in group.column(c)] for c in ("last", "symbol", "n", "mass")]
        lens = [len(x) for x in columns[0]]
        last, symbol, times, mass = (np.concatenate(c) for c in columns)
        names, order = np.unique(last, return_inverse=True)
        first, back, pairs = _pairs(order, symbol)
        n = np.bincount(back, times, pairs)
        above, up = order[first], np.log((mass[first] + 1) / corpus.norm)
        frequent = n >= corpus.least
        sums = lambda x: np.bincount(above[frequent], x, len(names))
        some, above_up = n[frequent], up[frequent]
        facts = [sums(None).astype(np.int64), sums(some), sums(np.exp(above_up)), sums(some * (np.log(some) - above_up))]
        total = n.astype(np.int64)[back]
        ends, k = np.cumsum(lens), len(names)
        answers = [_planes(total[e - m : e]) for e, m in zip(ends.tolist(), lens, strict=True)]
        nothing = [None] * len(answers)
        stated = [_longs([*nothing, *names.tolist()]), _longs([*nothing, *facts[0].tolist()]), *(pa.array([*nothing, *f.tolist()], pa.float64()) for f in facts[1:])]
        part = group.column("part").to_pylist()
        return _table(PAIRED, [_longs([*group.column("block").to_pylist(), *[None] * k]), _longs([*part, *part[:1] * k]), _binary([*answers, *[None] * k]), *stated])

    return run


def _prepared(docs: DataFrame, train: Column, depth: int, least: int, discount: float, part: int) -> tuple[Corpus, DataFrame, DataFrame, list[DataFrame]] | None:
    """The corpus, its blocks (not yet made), the answers that they need, and the tables to delete in the end; None without texts."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), train.alias("train"))
    word_parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = texts.mapInArrow(_ask_words(word_parts), ASKED)
    with _whole_groups(spark):
        answers = table(asked.groupBy("part").applyInArrow(_number_words(word_parts, least), ANSWER).coalesce(writers(spark)), "words")
    forget(spark)
    facts = [F.sum(c) for c in ("tokens", "total", "distinct", "ends", "rare", "rare_words")]
    tokens, total, distinct, _, rare, rare_words, top = answers.agg(*facts, F.max("top")).first()
    if tokens is None:
        return None
    kind = "<u4" if top < 1 << 32 else "<u8"
    frequent = _frequent_symbols(answers, part // 2, rare)
    hot = frequent[:, 1] > HOT * part
    large, spread = frequent[~hot, 0], tokens - int(frequent[~hot, 1].sum())
    corpus = Corpus(tokens, total, distinct, rare, rare_words, word_parts, max(1, -(-spread // part)), kind, least, depth, discount, large=large)
    blocks, needed, made = texts.mapInArrow(_encode, BLOCKS), answers.select("block", "part", "numbers", "n"), [answers]
    if hot.any():
        n = int(hot.sum())
        corpus.hot = Hot(frequent[hot, 0], np.zeros(n, bool), frequent[hot, 1].astype(float), np.zeros(n), np.zeros(n))
        with _whole_groups(spark):
            pairs = blocks.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(_ask_pairs(corpus), PAIRS)
            paired = table(pairs.groupBy("part").applyInArrow(_sum_pairs(corpus), PAIRED), "pairs")
        forget(spark)
        made.append(paired)
        sums = paired.filter("symbol is not null").groupBy("symbol").agg(F.sum("entries"), F.sum("held"), F.sum("mass"), F.sum("gain")).toPandas()  # a row per hot symbol
        place = np.searchsorted(corpus.hot.symbol, sums["symbol"].to_numpy())
        columns = np.zeros((4, len(corpus.hot.symbol)))
        columns[:, place] = sums.iloc[:, 1:].to_numpy(float).T
        corpus.hot.kept, corpus.hot.off, corpus.hot.slack = _decisions(*columns, corpus.hot.size, discount)
        numbers = F.lit(None).cast("binary").alias("numbers")
        needed = needed.unionByName(paired.filter("symbol is null").select("block", "part", numbers, "n"))
    return corpus, blocks, needed, made


def _frequent_symbols(answers: DataFrame, least: int, rare: int) -> np.ndarray:
    """Numbers and counts of the symbols with more than ``least`` training tokens, RARE included: at most tokens / ``least`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                number, count = _unpack(numbers), _unpack(n)
                some = np.flatnonzero((count > least) & (number >= FIRST))
                yield pa.RecordBatch.from_arrays([_longs(number[some]), _longs(count[some])], names=["symbol", "n"])

    found = [tuple(r) for r in answers.select("numbers", "n").mapInArrow(run, "symbol long, n long").distinct().collect()]
    return np.array(sorted(found + [(RARE, rare)] * (rare > least)), np.int64).reshape(-1, 2)


def _dealt(corpus: Corpus, blocks: DataFrame, needed: DataFrame) -> DataFrame:
    return blocks.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(_deal(corpus), DEALT)


def score(docs: DataFrame, train: Column, depth: int = DEPTH, least: int = LEAST, discount: float = DISCOUNT, part: int = PART) -> DataFrame:
    """doc_id, train, n_tokens, n_known, base_score, score, train_tokens of every whole text."""
    spark = docs.sparkSession
    ready = _prepared(docs, train, depth, least, discount, part)
    if ready is None:
        return spark.createDataFrame([], RESULT).withColumn("train_tokens", F.lit(0).cast("long"))
    corpus, blocks, needed, made = ready
    with _whole_groups(spark):
        sums = _dealt(corpus, blocks, needed).groupBy("part").applyInArrow(_score_part(corpus), SCORED)
        scored = table(sums.groupBy("block").applyInArrow(_sum_block, RESULT).coalesce(writers(spark)), "scores")
    forget(spark, *made)
    return scored.withColumn("train_tokens", F.lit(int(corpus.total)).cast("long"))


def tree(docs: DataFrame, train: Column, depth: int = DEPTH, least: int = LEAST, discount: float = DISCOUNT, part: int = PART) -> DataFrame:
    """The tree as a table: context (symbols' numbers, oldest first), symbol, n, ln of its probability; without a symbol, n is
    the context's count and ln that of what its suffix's probabilities of symbols without entry are multiplied by."""
    spark = docs.sparkSession
    ready = _prepared(docs, train, depth, least, discount, part)
    if ready is None:
        return spark.createDataFrame([], ENTRIES)
    corpus, blocks, needed, made = ready

    def run(group: pa.Table) -> pa.Table:
        _, before, symbol, value, place, paired = _opened(group, corpus)
        found: list[tuple] = []
        _branch(before, symbol, value, (place & 1).astype(bool), paired, corpus, found)
        kinds = (pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.float64())
        return _table(ENTRIES, [pa.array([f[c] for f in found], kind) for c, kind in enumerate(kinds)])

    with _whole_groups(spark):
        grown = table(_dealt(corpus, blocks, needed).groupBy("part").applyInArrow(run, ENTRIES).distinct(), "tree")
    forget(spark, *made)
    return grown
