"""URL filter by a Bloom filter cascade.

Listed keys are domains; a url is listed if its host or a parent domain is. Over the complete universe of keys in the corpus
(every suffix of every host) level 1 encodes the listed keys, level 2 the keys of the universe that level 1
wrongly reports, level 3 the listed keys that level 2 wrongly reports, and so on until no key is wrong.
Membership of any key of the universe is then exact, by bit tests alone: urls are never joined with the list. Keys are
64-bit hashes, so exact means that two different keys of the corpus and the list don't share one.

A suffix's hash is a difference of sums over the host's bytes, so a host costs its length however many labels it has.
All levels together have a bounded size (``MAX_MB``), known before they are made; a larger
list is cut by key hash into shards of the cascade that are applied one after the other, each with what it found written before the next is sent.

Explicit rules come before the cascade: the longest rule whose host covers the url's host and whose path begins its path; of rules
of one length the last. They are looked up by the hashes of the host's suffixes and compared as text; every worker holds all rules.

Nulls: a null url, or one without ``://``, has an empty host and path, is on no list and gets the verdict of an
unlisted url, allow. Repeated rows stay. Hosts of one label, with empty labels or of any length are keys like others. Listed keys
and the hosts of rules count in lower case (A-Z). An empty table, an empty list and an empty universe work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import tokens as tk
from framewright.llm.store import settle, small_batches, table
from framewright.llm.tokens import mix

U = np.uint64
MAX_MB = 64
KEY_BYTES = 6
"""A key takes under 6 bytes on level 1 at its lowest rate, 1e-9, and 0.4 on the others."""
DOT = ord(".")
LATER_RATE = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    after = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    return F.coalesce(F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.when(F.locate("://", url) > 0, F.regexp_extract(url, "^(?s).*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def suffix_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every host and its parent domains, longest first, where each begins, and each host's offsets into them."""
    n = len(data)
    up, down = tk._pow(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(tk._BYTE[data] * up[:n], out=total[1:])
    dots = np.flatnonzero(data == DOT)
    rows = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, dots, "right") - 1])
    starts = np.concatenate([offsets[:-1], dots + 1])
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    ends = offsets[rows + 1]
    keys = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))
    return keys, starts, np.searchsorted(rows, np.arange(len(offsets)))


def key_of(name: str) -> int:
    """The hash of one key."""
    raw = np.frombuffer(name.encode(), np.uint8)
    return int(suffix_keys(raw, np.array([0, len(raw)]))[0][0])


def _rows(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with the bytes and offsets of a text column."""
    for i, j, data, offsets in tk.blocks(batch.column(column)):
        yield batch.slice(i, j - i), data, offsets


class Book:
    """Rules by the hash of their host."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        ranked = sorted(enumerate(rules), key=lambda r: (len(r[1].text), r[0]), reverse=True)
        self.rules = [r for _, r in ranked]
        hashes = np.array([key_of(r.host) for r in self.rules], U)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.place = hashes[order], order

    def fitting(self, data: np.ndarray, offsets: np.ndarray, paths: pa.Array) -> list[Rule | None]:
        """The longest rule that fits each host and path."""
        out = np.full(len(offsets) - 1, len(self.rules))
        if len(self.rules):
            keys, starts, ends = suffix_keys(data, offsets)
            lo, hi = np.searchsorted(self.hashes, keys, "left"), np.searchsorted(self.hashes, keys, "right")
            for at in np.flatnonzero(hi > lo).tolist():
                row = int(np.searchsorted(ends, at, "right")) - 1
                for k in range(lo[at], hi[at]):
                    place = int(self.place[k])
                    rule = self.rules[place]
                    if place < out[row] and data[starts[at] : offsets[row + 1]].tobytes() == rule.host.translate(str.maketrans(UPPER, LOWER)).encode() and (paths[row].as_py() or "").startswith(rule.path):
                        out[row] = place
        return [self.rules[k] if k < len(self.rules) else None for k in out.tolist()]


def _places(key: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions (keys x hashes) of 64-bit key hashes in a level."""
    a = mix(key + U((level * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    b = mix(a ^ U(0xD6E8FEB86659FD93)) | U(1)
    return (a[:, None] + b[:, None] * np.arange(hashes, dtype=U)) % U(bits)


@dataclass
class Level:
    bits: int
    hashes: int
    words: np.ndarray

    def has(self, key: np.ndarray, level: int) -> np.ndarray:
        at = _places(key, level, self.bits, self.hashes)
        return ((self.words[at >> U(6)] >> (at & U(63))) & U(1)).all(axis=1)


class Cascade:
    """Levels of bits; ``has`` is exact for keys of the universe they were built over."""

    def __init__(self, levels: list[Level]) -> None:
        self.levels = levels

    @property
    def bytes(self) -> int:
        return sum(x.words.nbytes for x in self.levels)

    def has(self, key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), bool)
        alive = np.arange(len(key))
        for k, level in enumerate(self.levels, 1):
            inside = level.has(key[alive], k)
            out[alive[~inside]] = k % 2 == 0
            alive = alive[inside]
        out[alive] = len(self.levels) % 2 == 1
        return out


def shape(n: int, rate: float) -> tuple[int, int]:
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    return (bits + 63) // 64 * 64, max(1, round(-math.log2(rate)))


def fill(keys: DataFrame, level: int, bits: int, hashes: int) -> np.ndarray:
    """The level's words: set per batch, merged with bit_or per word; at most ``bits`` / 64 rows come back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = _places(batch["key"].to_numpy().view(U), level, bits, hashes).ravel()
            word, back = np.unique(at >> U(6), return_inverse=True)
            mask = np.zeros(len(word), U)
            np.bitwise_or.at(mask, back, U(1) << (at & U(63)))
            yield pd.DataFrame({"word": word.astype(np.int64), "mask": mask.view(np.int64)})

    words = np.zeros(bits // 64, U)
    got = keys.mapInPandas(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(U)
    return words


def _in_shard(shard: int, shards: int):
    """A test of a key column: whether it belongs to a shard of the cascade."""
    return lambda key: F.pmod(key, F.lit(shards)) == shard


def build(listed: DataFrame, universe: DataFrame, shard: int = 0, shards: int = 1) -> Cascade:
    """A cascade of ``listed`` (key: long hash) over ``universe`` (key: long hash), of the keys of one shard."""
    mine = _in_shard(shard, shards)(F.col("key"))
    universe = settle(universe.filter(mine).distinct())
    include = settle(listed.filter(mine).distinct().join(universe, "key", "left_semi"))
    exclude = universe.join(include, "key", "left_anti")
    n, others = include.count(), universe.count()
    levels: list[Level] = []
    while n:
        k = len(levels) + 1
        rate = min(0.5, max(1e-9, math.sqrt(0.5) * n / max(1, others - n))) if k == 1 else LATER_RATE
        bits, hashes = shape(n, rate)
        level = Level(bits, hashes, fill(include, k, bits, hashes))
        levels.append(level)

        def wrong(batches: Iterator[pd.DataFrame], level: Level = level, k: int = k) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch[level.has(batch["key"].to_numpy().view(U), k)]

        include, exclude = settle(exclude.mapInPandas(wrong, "key long")), include
        n = include.count()
    return Cascade(levels)


def _universe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in _rows(batch, "host"):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(suffix_keys(data, offsets)[0]).view(np.int64))], names=["key"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of whole names."""
    for batch in batches:
        for _, data, offsets in _rows(batch, "key"):
            keys, _, ends = suffix_keys(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(keys[ends[:-1]].view(np.int64))], names=["key"])


def listed(hosts: DataFrame, keys: DataFrame, max_mb: float = MAX_MB) -> DataFrame:
    """``hosts`` (with a column host) and ``listed``: whether the host or a parent domain is among ``keys`` (key: string)."""
    small_batches(hosts.sparkSession)
    hashed = settle(keys.filter("key is not null").select("key").mapInArrow(_whole, "key long").distinct())
    universe = hosts.select("host").mapInArrow(_universe, "key long")
    room = max_mb * 2**20
    shards = max(1, math.ceil(hashed.count() * KEY_BYTES / room))
    while shards > 1 and hashed.groupBy(F.pmod("key", F.lit(shards)).alias("shard")).count().agg(F.max("count")).first()[0] * KEY_BYTES > room:
        shards += 1  # a shard has more than its share
    if shards > 1:
        universe = table(universe.distinct(), "universe")
    names = [c for c in hosts.columns if c != "listed"]
    seen = hosts.select(*names, F.lit(False).alias("listed"))
    for shard in range(shards):
        cascade = build(hashed, universe, shard, shards)
        sent = hosts.sparkSession.sparkContext.broadcast(cascade)
        seen = seen.mapInArrow(_tested(sent, names.index("host"), shard, shards), seen.schema)
        if shards > 1:
            seen = table(seen, "listed")
            sent.unpersist()
    return seen


def _tested(sent, host: int, shard: int, shards: int):
    """For rows with a last column that says what the shards before have found: the same with this one's keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in _rows(batch, batch.schema.names[host]):
                keys, _, ends = suffix_keys(data, offsets)
                own = np.flatnonzero(keys.view(np.int64) % shards == shard)
                hit = np.zeros(len(keys) + 1, np.int64)
                hit[own + 1] = sent.value.has(keys[own])
                hit = np.cumsum(hit)
                found = (hit[ends[1:]] > hit[ends[:-1]]) | np.asarray(part.column(part.num_columns - 1).to_numpy(zero_copy_only=False), bool)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], schema=part.schema)

    return run


def judge(pages: DataFrame, rules: Sequence[Rule], keys: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every row of ``pages`` (page_id, url)."""
    urls = pages.select("page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    book = Book(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in _rows(batch, "host"):
                found = book.fitting(data, offsets, part.column("path"))
                texts = (pa.array([r and f(r) for r in found], pa.string()) for f in (lambda r: r.text, lambda r: r.verdict))
                yield pa.RecordBatch.from_arrays([*part.columns, *texts], names=[*part.schema.names, "rule", "ruled"])

    kind = pages.select("page_id").schema[0].dataType.simpleString()
    found = listed(urls, keys).mapInArrow(run, f"page_id {kind}, host string, path string, listed boolean, rule string, ruled string")
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
