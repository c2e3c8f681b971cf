"""BPE encoding and decoding with a contiguous rank array per word.

A word of n parts has an array of part boundaries and an array of the ranks of its adjacent pairs. Again and again
the smallest rank is found, the boundary between its two parts deleted, and the two neighbouring ranks are
looked up anew. Words longer than ``SHORT`` parts keep the ranks in a heap with a linked list instead, with
the same result, since scanning grows with the square of a word's length.

The vocabulary file describes normalisation (NFC, white space to one space, lower case character by character), a
split into letters, single numbers and other marks, and bytes written as characters; its special tokens are
cut out of the raw text first. A process keeps what each distinct word becomes, up to a bounded memory.

Nulls count as empty; an empty text has no ids and decodes to an empty text. The path of the vocabulary file is a
parameter; the file's bytes are read on the driver and sent to the executors, which share no local folder.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from tokenizers import Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.store import small_batches

SHORT = 64
REMEMBER = 1 << 16
"""Entries of a generation of ``Recent``, which keeps two."""
PLAIN = regex.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-\u01c3\u01cd-\u01f0\u2013\u2014\u2018-\u201e\u2026\u20ac]*")
"""Texts whose normalisation and split do not depend on a Unicode version; all others are normalised and split
by the tokenizers library itself, character tables being all that is taken from it."""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is a visible one, else from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


Piece = tuple[int, str, str]


class Recent:
    """What short keys became: those of late and those of the generation before. One that is asked for again stays, so that
    frequent words outlive the many that come once, and memory doesn't grow with the number of distinct words."""

    def __init__(self) -> None:
        self.late: dict[str, Piece] = {}
        self.before: dict[str, Piece] = {}

    def get(self, key: str) -> Piece | None:
        got = self.late.get(key)
        if got is None and (got := self.before.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key: str, piece: Piece) -> None:
        if len(key) <= SHORT:
            if len(self.late) >= REMEMBER:
                self.before, self.late = self.late, {}
            self.late[key] = piece


class WordBpe:
    """The encoder and decoder of one vocabulary file."""

    def __init__(self, spec: str) -> None:
        told = json.loads(spec)
        model = told["model"]
        self.vocab: dict[str, int] = model["vocab"]
        end: str = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        #: Rank of a pair of neighbouring ids, and the id that a merge of that rank makes.
        self.rank = {self.vocab[x] << 20 | self.vocab[y]: k for k, (x, y) in enumerate(pairs)}
        self.made = [self.vocab[x + y] for x, y in pairs]
        self.letters = byte_letters()
        self.inner = {c: self.vocab[c] for c in self.letters if c in self.vocab}
        self.last = {c: self.vocab[c + end] for c in self.letters if c + end in self.vocab}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        split = next(p for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        #: Only normalises and splits, so it gets no vocabulary.
        self.library = Tokenizer.from_str(json.dumps(told | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        #: By stretch between blanks; a word of visible ASCII is the stretch that it makes alone. Other words go by the letters of their bytes.
        self.near, self.seen = Recent(), Recent()

    def merge(self, word: str) -> list[int]:
        """The ids of one word, given as the letters of its bytes."""
        parts = [self.inner[c] for c in word]
        parts[-1] = self.last[word[-1]]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank, made = self.rank, self.made
        never = len(made)
        ranks = [rank.get(x << 20 | y, never) for x, y in zip(parts, parts[1:], strict=False)]
        while ranks and (low := min(ranks)) != never:
            i = ranks.index(low)
            parts[i] = new = made[low]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] << 20 | new, never)
            if i < len(ranks):
                ranks[i] = rank.get(new << 20 | parts[i + 1], never)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        rank, n = self.rank, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            low, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = self.made[low], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := rank.get(parts[k] << 20 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> Piece:
        """Number of ids, the ids joined by spaces, and the decoded tokens joined by spaces."""
        kept = self.near if word.isascii() else self.seen
        got = kept.get(word)
        if got is None:
            ids = self.merge(word)
            got = len(ids), " ".join([str(i) for i in ids]), " ".join([self.token[i] for i in ids])
            kept.put(word, got)
        return got

    def _together(self, pieces: list[Piece]) -> Piece:
        counts, ids, decoded = zip(*pieces, strict=True) if pieces else ((), (), ())
        return sum(counts), " ".join(ids), " ".join(decoded)

    def _stretch(self, low: str) -> Piece:
        """A stretch between blanks, lower-cased: it is split; letters with at most one other mark at the end need no pattern."""
        got = self.near.get(low)
        if got is not None:
            return got
        if low.isalpha():
            cut = [low]
        elif low[:-1].isalpha():
            cut = [low[:-1], low[-1]]
        else:
            cut = self.split.findall(low)
        letters = self.letters
        pieces = [self.word(w if w.isascii() else "".join([letters[b] for b in w.encode()])) for w in cut]
        got = pieces[0] if len(pieces) == 1 else self._together(pieces)
        self.near.put(low, got)
        return got

    def _plain(self, text: str) -> Piece:
        """A text of well-known characters."""
        near, new = self.near.late.get, self._stretch
        return self._together([near(s) or new(s) for s in text.lower().split()])

    def _any(self, text: str) -> Piece:
        low = self.library.normalizer.normalize_str(text)
        return self._together([self.word(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(low)])

    def both(self, text: str) -> Piece:
        """Number of ids, ids joined by spaces, decoded text."""
        found = []
        for k, raw in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                found.append((1, str(self.special[raw]), raw))
            elif raw:
                found.append(self._plain(raw) if PLAIN.fullmatch(raw) else self._any(raw))
        return found[0] if len(found) == 1 else self._together([f for f in found if f[0]])

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.both(text)[1].split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, as a vocabulary without a decoder of its own is read; unknown ids are skipped."""
        return " ".join(self.token[i] for i in ids if i in self.token)


_ready: dict[str, WordBpe] = {}


def _coder(key: str, spec: str) -> WordBpe:
    if key not in _ready:
        _ready.clear()
        _ready[key] = WordBpe(spec)
    return _ready[key]


def _broadcast_spec(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return df.sparkSession.sparkContext.broadcast(spec), hashlib.sha256(spec.encode()).hexdigest()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (text of those ids) of every whole text."""
    small_batches(docs.sparkSession)
    spec, key = _broadcast_spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, spec.value)
        for batch in batches:
            made = [coder.both(t or "") for t in batch.column("text").to_pylist()]
            ids = pa.array([[int(x) for x in m[1].split()] for m in made], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("__k"), ids, pa.array([m[2] for m in made], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").alias("__k"), "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    small_batches(docs.sparkSession)
    spec, key = _broadcast_spec(docs, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, spec.value)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            n, ids, decoded = [], [], []
            for t in batch.column("text"):
                count, joined, text = coder.both(t.as_py() or "")
                n.append(count), ids.append(sha(joined)), decoded.append(sha(text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
