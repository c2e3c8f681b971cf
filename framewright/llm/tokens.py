"""Vectorised tokenisation: 64-bit hashes of the words of many texts at once, with numpy over UTF-8 bytes.

Words are maximal runs of non-delimiter bytes; A-Z count as a-z. A word's hash is a polynomial in its
bytes modulo 2**64, taken as a difference of prefix sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEGMENT = 1 << 19
"""Bytes that are tokenised at once; longer texts are cut between words and put together again."""

_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_powers: list[np.ndarray] = []


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SEGMENT + 64)
        with np.errstate(over="ignore"):
            up = np.full(size, U(_BASE))
            down = np.full(size, U(pow(_BASE, -1, 2**64)))
            up[0] = down[0] = 1
            _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and their offsets; a null counts as empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words(data: np.ndarray, cuts: np.ndarray, delimiter: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of the words of ``data``; no word crosses a position in ``cuts``.

    With ``prefixes`` there is a column for the word and one for its first bytes, as many as each entry says; 0 if it has no more.
    """
    n = len(data)
    inside = ~delimiter[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = cuts[(cuts > 0) & (cuts < n)]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _pow(n)
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(U))
    if prefixes:
        columns = [hashes]
        for k in prefixes:
            head = mix((total[np.minimum(start + k, n)] - total[start]) * down[start] + U(k + (1 << 32)))
            columns.append(np.where(end - start > k, head, U(0)))
        hashes = np.stack(columns, axis=1)
    return hashes, start


def blocks(column: pa.Array, limit: int = SEGMENT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``limit`` bytes together, or one longer row: (from, to, bytes, offsets)."""
    data, offsets = text_bytes(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, delimiter: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block's texts in order, and each text's offsets into them."""
    if len(data) <= SEGMENT:
        h, start = _words(data, offsets, delimiter, prefixes)
        return h, np.searchsorted(start, offsets)
    found, counts, base = [], np.zeros(len(offsets), np.int64), 0
    while base < len(data):  # pieces end at a delimiter, so no word is cut
        stop = min(len(data), base + SEGMENT)
        if stop < len(data):
            back = np.flatnonzero(delimiter[data[base:stop]])
            if len(back):
                stop = base + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(delimiter[data[stop:]])
                stop = stop + int(ahead[0]) + 1 if len(ahead) else len(data)
        h, start = _words(data[base:stop], offsets - base, delimiter, prefixes)
        counts += np.searchsorted(start, offsets - base)
        found.append(h)
        base = stop
    return np.concatenate(found), counts


def word_hash(word: str) -> int:
    """The hash of one word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    never = np.zeros(256, bool)
    return int(_words(raw, np.array([0, len(raw)]), never)[0][0])


_PLACE = mix(np.arange(1, 6, dtype=np.uint64) * U(0xD1342543DE82EF95)) | U(1)


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingles; a text of fewer words has its whole sequence as one."""
    rolling = np.zeros(0, U)
    if len(hashes) >= width:
        m = len(hashes) - width + 1
        rolling = sum((hashes[k : k + m] * _PLACE[k] for k in range(1, width)), hashes[:m] * _PLACE[0])
        rolling = mix(rolling)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolling[a : b - width + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * _PLACE[: b - a]).sum(keepdims=True, dtype=U) + U(b - a)))
        else:
            out.append(np.zeros(0, U))
    return out
