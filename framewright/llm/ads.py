"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component, so that the largest inner product is the smallest distance, and are rotated at random; then
the distance over the first m of D rotated dimensions, times D / m, estimates the whole. Within every probed list
a candidate is abandoned as soon as a hypothesis test on its partial distance (column blocks of ``COLUMNS``) says that
the whole distance exceeds the query's bound: partial * D / m > bound * (1 + EPSILON / sqrt(m))**2. The
bound starts as the K-th distance to the vectors of the fitting sample, which are vectors of the corpus.
Survivors get the exact inner product of the original vectors in double precision. Queries with fewer than K results are scanned again
without the test, four times as many lists each time and all in the end, so that K are found wherever there are K.

There are as many lists as the root of the number of vectors. Centroids, the number of probed lists and the starting bounds come from a sample
(smallest hash of vec_id) of ``SAMPLE`` vectors, or twice the lists if that is more, and of at most ``SAMPLE_BYTES`` bytes once rotated; the
number of lists to probe is the least that finds ``RECALL`` of the sample's true neighbours. Every vector is indexed.
Lists are cut and packed into cells of at most ``CELL_BYTES``, so equal or crowded vectors do not fill a task. A cell's vectors meet
the queries that probe it, ``QUERIES`` at a time: only a cell with more queries than that is sent more than once, so what is
sent grows with the vectors and with the probes of the queries, not with their product. A query leaves at most K rows in a cell.

Vectors that are null, of another length than the most frequent one (of equally frequent ones the least), zero, or hold null or non-finite components take no part,
neither as query nor as candidate; neither do rows with a null vec_id. Repeated vectors are candidates of their own; ties go
to the smaller vec_id. A vec_id names a row: rows that repeat vec_id and vector count as one, as query and as candidate, and a query never
finds a row of its own vec_id, even if that holds another vector. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm.store import settle, small_batches

K = 20
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
RECALL = 0.97
COLUMNS = 16
EPSILON = 2.1
CELL_BYTES = 8 << 20
QUERIES = 16_384
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Index:
    dims: int
    top: float
    """Largest squared length."""
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    sample_ids: np.ndarray
    sample: np.ndarray
    """Rotated."""
    first_cell: np.ndarray
    cells: np.ndarray

    @property
    def all_cells(self) -> int:
        return int((self.first_cell + self.cells).max())

    def reached(self, r: np.ndarray, probes: int) -> np.ndarray:
        """Which cells rotated queries look into."""
        out = np.zeros((len(r), self.all_cells), bool)
        for row, lists in enumerate(self.lists(r, probes)):
            for first, n in zip(self.first_cell[lists].tolist(), self.cells[lists].tolist(), strict=True):
                out[row, first : first + n] = True
        return out

    def rotated(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.top - (x**2).sum(1)))
        return (np.column_stack([x, extra]) @ self.rotation).astype(np.float32)

    def lists(self, r: np.ndarray, probes: int) -> np.ndarray:
        """The nearest lists of rotated vectors."""
        d = (self.centroids**2).sum(1) - 2 * r @ self.centroids.T
        return np.argpartition(d, probes - 1, axis=1)[:, :probes] if probes < len(self.centroids) else np.tile(np.arange(len(self.centroids)), (len(r), 1))

    def bounds(self, ids: np.ndarray, r: np.ndarray, k: int) -> np.ndarray:
        """Squared distance to the k-th nearest other vector of the sample."""
        s = self.sample
        d = (s**2).sum(1) - 2 * r @ s.T + (r**2).sum(1)[:, None]
        d[self.sample_ids[None, :] == ids[:, None]] = np.inf
        return np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(r), np.inf)


def _centroids(x: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        own = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(own, minlength=lists)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dims)


def usable(table: DataFrame, column: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, components as doubles."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("v", lambda x: x != 0)
    return rows.filter(fine)


def fit(rows: DataFrame, dims: int, k: int = K, sample: int = SAMPLE, recall: float = RECALL) -> Index:
    """Centroids, probes and cells; the driver sees the sample and one row per list."""
    n, top = rows.agg(F.count("vec_id"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    lists = max(1, round(n**0.5))
    sample = max(1, min(max(sample, 2 * lists), SAMPLE_BYTES // (4 * (dims + 1))))
    picked = rows.orderBy(F.xxhash64("vec_id", F.lit("ads")), "vec_id").limit(sample).select("vec_id", "v").toArrow().combine_chunks()
    ids, x = picked.column("vec_id").to_numpy(), _vectors(picked.column("v").combine_chunks(), dims)
    rotation = np.linalg.qr(np.random.default_rng(11).normal(size=(dims + 1, dims + 1)))[0]
    count = min(lists, len(x))
    index = Index(dims, float(top), rotation, np.zeros((1, dims + 1), np.float32), 1, ids, x, np.zeros(1, int), np.ones(1, int))
    index.sample = r = index.rotated(x, False)
    index.centroids = _centroids(r, count)
    own = index.lists(r, 1)[:, 0]
    asked = np.random.default_rng(13).choice(len(x), min(200, len(x)), replace=False)
    q = index.rotated(x[asked], True)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-score, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    order = np.argsort((index.centroids**2).sum(1) - 2 * q @ index.centroids.T, axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(count)[None, :].repeat(len(q), 0), 1)
    depth = np.sort(np.take_along_axis(rank, own[true], 1).ravel())
    index.probes = count if not len(depth) else int(depth[min(len(depth) - 1, int(np.ceil(recall * len(depth))))]) + 1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = index.lists(index.rotated(_vectors(batch.column(0), dims), False), 1)[:, 0]
            lists, n = np.unique(own, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int64)), pa.array(n.astype(np.int64))], names=["list", "n"])

    sizes = np.zeros(count, int)
    for row in rows.select("v").mapInArrow(assign, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
        sizes[row.list] = row.n
    room = max(1, min(CELL_BYTES // (8 * dims), max(512, n // 128)))
    index.first_cell, index.cells = np.zeros(count, int), np.maximum(1, -(-sizes // room))
    cell, used = 0, 0
    for k_, s in enumerate(sizes.tolist()):
        if used and (used + s > room or index.cells[k_] > 1):
            cell, used = cell + 1, 0
        index.first_cell[k_] = cell
        used += s
        if index.cells[k_] > 1:
            cell, used = cell + int(index.cells[k_]), 0
    return index


def _scan(index: Index, qid: np.ndarray, q: np.ndarray, bound: np.ndarray, xid: np.ndarray, x: np.ndarray, rx: np.ndarray, own: np.ndarray, k: int, probes: int, tested: bool) -> tuple[np.ndarray, ...]:
    """The adaptive scan of a cell, whose vectors are ``x``, rotated ``rx``, of the lists ``own``: (query, vector, score) of each query's best k survivors.

    Unless ``tested``, a candidate is abandoned only when its partial distance itself exceeds the bound.
    """
    rq = index.rotated(q, True)
    probed = np.zeros((len(q), len(index.centroids)), bool)
    np.put_along_axis(probed, index.lists(rq, probes), True, 1)
    alive = probed[:, own] & (qid[:, None] != xid[None, :])
    total = rx.shape[1]
    part, i, j = np.zeros(alive.shape, np.float32), None, None
    limit = (bound * (1 + 1e-5) + 1e-6).astype(np.float64)
    if not tested:
        limit = limit + 1e-5 * ((rq.astype(float) ** 2).sum(1) + index.top)  # more than single precision loses
    for a in range(0, total, COLUMNS):
        b = min(total, a + COLUMNS)
        slack = 1.0 if b == total else (1 + EPSILON / np.sqrt(b)) ** 2
        most = limit * (b / total) * slack if tested else limit
        if i is None:
            qa, xa = rq[:, a:b], rx[:, a:b]
            part += (qa**2).sum(1)[:, None] + (xa**2).sum(1)[None, :] - 2 * qa @ xa.T
            alive &= part <= most[:, None]
            if alive.mean() < 0.1:
                i, j = np.nonzero(alive)
                left = part[i, j]
        else:
            left = left + ((rq[i, a:b] - rx[j, a:b]) ** 2).sum(1)
            keep = left <= most[i]
            i, j, left = i[keep], j[keep], left[keep]
    if i is None:
        i, j = np.nonzero(alive)
    score = np.empty(len(i))
    for a in range(0, len(i), 65_536):
        score[a : a + 65_536] = (q[i[a : a + 65_536]] * x[j[a : a + 65_536]]).sum(1)
    order = np.lexsort((xid[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    best = place < k
    return qid[i[best]], xid[j[best]], score[best]


def search(table: DataFrame, column: str = "embedding", every: int = 20, k: int = K, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every vector whose id is divisible by ``every``."""
    spark = table.sparkSession
    small_batches(spark)
    rows = usable(table, column)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = lengths[0].d
    rows = settle(rows.filter(F.size("v") == dims).dropDuplicates(["vec_id", "v"]))
    index = fit(rows, dims, k, sample)
    sent = spark.sparkContext.broadcast(index)
    asked, probes = rows.filter(F.pmod("vec_id", F.lit(every)) == 0), index.probes
    found = _pass(rows, asked, index, sent, every, k, probes, True)
    while True:
        full = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
        asked = settle(asked.join(full, "vec_id", "left_anti").select("vec_id", "v"))
        if asked.isEmpty():
            break
        probes = min(4 * probes, len(index.centroids))
        found = settle(found.unionByName(_pass(rows, asked, index, sent, every, k, probes, False)).dropDuplicates(["query_id", "vec_id", "score"]))
        if probes == len(index.centroids):
            break
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(rows: DataFrame, asked: DataFrame, index: Index, sent: Broadcast, every: int, k: int, probes: int, tested: bool) -> DataFrame:
    """(query_id, vec_id, score) of a scan of each query's ``probes`` nearest lists: its best k of every cell."""
    dims, cells = index.dims, index.all_cells
    schema = pa.schema([("cell", pa.int64()), ("part", pa.int64()), ("asks", pa.bool_()), ("vec_id", pa.int64()), ("bound", pa.float64()), ("v", pa.list_(pa.float64()))])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                yield whole.slice(a, 256)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(cells, np.int64)
        for batch in pieces(batches):
            n += sent.value.reached(sent.value.rotated(_vectors(batch.column("v"), dims), True), probes).sum(0)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["cell", "n"])

    parts = np.zeros(cells, np.int64)
    """How often a cell is sent: 0 without queries."""
    for row in asked.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # a row per cell
        parts[row.cell] = -(-row.n // QUERIES)

    def deal(batch: pa.RecordBatch, at: np.ndarray, cell: np.ndarray, part: np.ndarray, asks: bool, bound: np.ndarray) -> pa.RecordBatch:
        n = len(at)
        take = pa.array(at)
        return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(part.astype(np.int64)), pa.array(np.full(n, asks)), batch.column("vec_id").take(take), pa.array(bound), batch.column("v").take(take)], schema=schema)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ix, ids = sent.value, batch.column("vec_id").to_numpy()
            own = ix.lists(ix.rotated(_vectors(batch.column("v"), dims), False), 1)[:, 0]
            cell = ix.first_cell[own] + ids % ix.cells[own]
            at = np.repeat(np.arange(len(ids)), parts[cell])
            part = np.arange(len(at)) - np.searchsorted(at, at)
            yield deal(batch, at, cell[at], part, False, np.zeros(len(at)))

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ix, ids = sent.value, batch.column("vec_id").to_numpy()
            r = ix.rotated(_vectors(batch.column("v"), dims), True)
            bound = ix.bounds(ids, r, k)
            at, cell = np.nonzero(ix.reached(r, probes))
            yield deal(batch, at, cell, ids[at] // every % parts[cell], True, bound[at])

    dealt = "cell long, part long, asks boolean, vec_id long, bound double, v array<double>"
    met = rows.mapInArrow(candidates, dealt).unionByName(asked.mapInArrow(queries, dealt))

    def scan(group: pa.Table) -> pa.Table:
        ix, asks = sent.value, group.column("asks").to_numpy()
        ids, v = group.column("vec_id").to_numpy(), _vectors(group.column("v").combine_chunks(), dims)
        bound = group.column("bound").to_numpy()
        got = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        mine, others = np.flatnonzero(asks), np.flatnonzero(~asks)
        if len(others):
            x, xid = v[others], ids[others]
            rx = ix.rotated(x, False)
            own = ix.lists(rx, 1)[:, 0]
        for a in range(0, len(mine) if len(others) else 0, 512):
            m = mine[a : a + 512]
            got.append(_scan(ix, ids[m], v[m], bound[m], xid, x, rx, own, k, probes, tested))
        return pa.table({n: pa.array(np.concatenate([g[c] for g in got])) for c, n in enumerate(("query_id", "vec_id", "score"))})

    return settle(met.groupBy("cell", "part").applyInArrow(scan, FOUND).dropDuplicates(["query_id", "vec_id", "score"]))
