"""Near-duplicates by b-bit MinHash over five-word shingles.

1. One pass over the texts (Arrow batches, numpy): each text's distinct shingles give ``HASHES`` minima. Bands
   of the minima make candidate keys; the two low bits of every minimum are packed into four longs.
2. Texts with equal shingle sets form a class; only one representative of a class goes on.
3. Representatives that share a band meet its smallest member (a star, never all pairs). Set sizes and the
   similarity estimated from the packed bits (corrected for chance agreement of two bits) discard most;
   the estimate's margin is ``MARGIN`` standard deviations, so that it discards no link.
4. Candidates are confirmed on the full sets, and components are formed. Only those texts' sets are made again: a Bloom
   filter of bounded size picks them during the scan, and an exact join follows.
5. What a star can miss is a link between two members of a band neither of which is its smallest. So the bands whose members lie in
   several components stay open. A member of whose shingles more than 100 - ``PERCENT`` in 100 occur in no other open member
   can't be linked to any; such members are peeled off, round after round, at linear cost. What remains is compared in
   blocks of bounded size: a task has two blocks, counts all their intersections with matrix products over the shingles that
   at least two members share, and returns only links that join components, at most one per member. No pairs are emitted.

A pair of similarity 0.85 shares no band with probability (1 - 0.85**5)**25, below 1e-6.

Shingles are 64-bit hashes and a class is named by its number of shingles and two 64-bit sums over them; neither is compared as text.

Nulls and texts without words: an empty set, linked with nothing. A text of fewer than five words has its whole
sequence as its set. Repeated rows and equal texts fall in one class. Rows that share a doc_id are one document: whatever their texts, each of
their sets links the document, and they have one component_id. A null doc_id takes part in nothing
and is its own row with a null component_id and kept true. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import tokens as tk
from framewright.llm.graph import components
from framewright.llm.sift import maps, sift, tested, unwrapped
from framewright.llm.store import compact, rows_in, settle, small_batches
from framewright.llm.url_cascade import Level, fill, shape

ROWS, BANDS, HASHES = 5, 25, 128
PERCENT = 85
MARGIN = 6
MAX_BITS = 1 << 27
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 20
U = np.uint64
_rng = np.random.Generator(np.random.PCG64(85))
_MUL = _rng.integers(1, 2**64 - 1, HASHES, dtype=np.uint64) | U(1)
_ADD = _rng.integers(1, 2**64 - 1, HASHES, dtype=np.uint64)
_ROW = _rng.integers(1, 2**64 - 1, (BANDS, ROWS), dtype=np.uint64) | U(1)

SIGNED = "doc_id long, n_shingles long, set1 long, set2 long, bits array<long>, bands array<long>"


def _minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HASHES minima for each run of ``values`` that begins at ``starts``."""
    out = np.full((len(starts), HASHES), U(2**64 - 1))
    step = 1 << 16
    edges = np.append(starts, len(values))
    for base in range(0, len(values), step):  # pieces that stay in the cache
        top = min(len(values), base + step)
        lo, hi = np.searchsorted(edges, base, "right") - 1, np.searchsorted(edges, top, "left")
        cuts = np.maximum(edges[lo:hi], base) - base
        piece, room = values[base:top], np.empty(top - base, U)
        for k in range(HASHES):
            np.multiply(piece, _MUL[k], out=room)
            np.add(room, _ADD[k], out=room)
            got = np.minimum.reduceat(room, cuts)
            np.minimum(out[lo:hi, k], got, out=out[lo:hi, k])
    return out


def _names(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, which name it together with its size."""
    return np.add.reduceat(tk.mix(values ^ U(0x5851F42D4C957F2D)), starts), np.add.reduceat(tk.mix(values + U(0x14057B7EF767814F)), starts)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()), ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
    )
    for batch in batches:
        for i, j, data, offsets in tk.blocks(batch.column("text")):
            sets = tk.shingles(*tk.words(data, offsets))
            n = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(n)
            bits, bands = np.zeros((len(sets), 4), U), np.zeros((len(sets), BANDS), U)
            set1, set2 = np.zeros(len(sets), U), np.zeros(len(sets), U)
            if len(some):
                values = np.concatenate([sets[k] for k in some])
                starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
                low = tk.mix(_minima(values, starts))
                for b in range(BANDS):
                    bands[some, b] = tk.mix((low[:, b * ROWS : (b + 1) * ROWS] * _ROW[b]).sum(1, dtype=U) + U(b))
                two = (low & U(3)).reshape(len(some), 4, 32) << (U(2) * np.arange(32, dtype=U))
                bits[some] = np.bitwise_or.reduce(two, axis=2)
                set1[some], set2[some] = _names(values, starts)
            counts = np.where(n > 0, BANDS, 0)
            lists = lambda flat, sizes: pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, j - i).cast(pa.int64()),
                    pa.array(n),
                    pa.array(set1.view(np.int64)),
                    pa.array(set2.view(np.int64)),
                    lists(bits.ravel(), np.full(len(sets), 4)),
                    lists(np.ascontiguousarray(bands[some]).ravel(), counts),
                ],
                schema=schema,
            )


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set1, set2 (128 bits that name the set), bits (packed low bits), bands (keys)."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_sign, SIGNED)


def _sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, shingles) of the classes in ``wanted`` (cid), each from a text of its representative.

    A Bloom filter of at most ``MAX_BITS`` lets the scan skip nearly all others, so that no text is shuffled; beyond that size it lets more
    pass, and the join alone decides.
    """
    needed = compact(classes.select("cid", "rep", "set1", "set2").join(wanted.select("cid").distinct(), "cid", "left_semi"))
    bits, hashes = shape(max(1, rows_in(needed)), 0.01)
    level = Level(min(bits, MAX_BITS), hashes, np.zeros(0, U))
    level.words = fill(needed.select(F.col("rep").alias("key")), 1, level.bits, hashes)
    sent = docs.sparkSession.sparkContext.broadcast(level)
    schema = pa.schema([("rep", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            batch = whole.filter(pa.array(sent.value.has(whole.column("rep").to_numpy().view(U), 1)))
            for i, j, data, offsets in tk.blocks(batch.column("text")):
                sets = tk.shingles(*tk.words(data, offsets))
                n = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(n)
                if len(some):
                    flat, ends = np.concatenate([sets[k] for k in some]), np.cumsum(n[some])
                    names = _names(flat, ends - n[some])
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([batch.column("rep").slice(i, j - i).take(pa.array(some)), *(pa.array(x.view(np.int64)) for x in names), lists], schema=schema)

    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("rep"), F.coalesce("text", F.lit("")).alias("text"))
    made = texts.mapInArrow(run, "rep long, set1 long, set2 long, shingles array<long>").join(needed, ["rep", "set1", "set2"])
    return settle(made.select("cid", "shingles").dropDuplicates(["cid"]))


def agreement(a: str, b: str) -> Column:
    """Estimated similarity from the packed bits of ``a`` and ``b``, corrected for chance (two bits: 1 in 4)."""
    odd = "0x5555555555555555"
    mask = f"cast(conv('{odd[2:]}', 16, 10) as long)"
    differ = " + ".join(f"bit_count(((({a}[{k}] ^ {b}[{k}])) | shiftrightunsigned({a}[{k}] ^ {b}[{k}], 1)) & {mask})" for k in range(4))
    return (1 - F.expr(differ) / HASHES - 0.25) / 0.75


def least_agreement(percent: int = PERCENT) -> float:
    """The estimate below which a pair is discarded: MARGIN standard deviations under the threshold."""
    j = percent / 100
    p = j + (1 - j) / 4
    return j - MARGIN * (p * (1 - p) / HASHES) ** 0.5 / 0.75


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")), classes, docs)
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def _peel(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` without the members that share too few of their shingles with any other member to be linked."""
    rows = rows_in(sets)
    while True:
        alone = sets.select("cid", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("cid").alias("cid"), F.count(F.lit(1)).alias("n")).filter("n = 1")
        own = alone.groupBy("cid").agg(F.count(F.lit(1)).alias("alone"))
        few = F.coalesce("alone", F.lit(0)) * 100 <= (100 - percent) * F.size("shingles")
        sets = settle(sets.join(own, "cid", "left").filter(few).select(*sets.columns))
        left = rows_in(sets)
        if left >= 0.9 * rows or not left:
            return sets
        rows = left


def _joining_links(sizes: np.ndarray, flat: np.ndarray, component: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Positions of linked members of different components that join these; all intersections are counted."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times > 1
    place = np.cumsum(common) - 1
    keep = common[number]
    owner, column = owner[keep], place[number[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((n, n), np.float32)
    step = 2048
    for a in range(0, int(common.sum()), step):
        lo, hi = np.searchsorted(column, (a, a + step))
        x = np.zeros((n, step), np.float32)
        x[owner[lo:hi], column[lo:hi] - a] = 1
        shared += x @ x.T
    union = sizes[:, None] + sizes[None, :] - shared
    linked = (100 * shared.astype(np.float64) >= percent * union) & (component[:, None] < component[None, :])
    if len(np.unique(side)) > 1:
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(linked)
    if not len(i):
        return []
    _, one = np.unique(np.stack([component[i], component[j]]), axis=1, return_index=True)
    up: dict[int, int] = {}

    def root(c: int) -> int:
        while up.get(c, c) != c:
            c = up[c]
        return c

    out = []
    for k in one.tolist():
        x, y = root(int(component[i[k]])), root(int(component[j[k]]))
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((int(i[k]), int(j[k])))
    return out


def _across(keyed: DataFrame, of: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame | None:
    """Links between members of different components that share a band, as far as they join components."""
    named = F.coalesce("component", "cid").alias("component")
    placed = compact(keyed.select("key", "cid").join(of, keyed.cid == of.node, "left").select("key", "cid", named))

    def still_open(rows: DataFrame) -> DataFrame:
        torn = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("cid").alias("centre")).filter("lo < hi")
        return compact(rows.join(compact(torn.select("key", "centre")), "key"))

    open_ = still_open(placed)
    if open_.isEmpty():
        return None
    sets = _peel(_sets(open_.select("cid"), classes, docs), percent)
    left = still_open(open_.drop("centre").join(sets.select("cid"), "cid", "left_semi"))
    group = components(left.filter("cid <> centre").select(F.col("centre").alias("a"), F.col("cid").alias("b")).distinct())
    clusters = group.select("node", F.col("component").alias("cluster"))
    rows = left.select("cid", "component").distinct().join(clusters, F.col("cid") == F.col("node")).join(sets, "cid").select("cid", "component", "cluster", "shingles")
    rows = settle(rows)
    weights = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("m"))
    blocks = weights.select("cluster", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("m") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    mine = rows.join(blocks, "cluster").withColumn("mine", F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks")).cast("int"))
    # one key of its own per cell: grouping by (cluster, i, j) would leave a whole cluster where the join has put it
    cell = F.xxhash64("cluster", F.least("mine", "other"), F.greatest("mine", "other"))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(cell.alias("cell"), "mine", "cid", "component", "shingles")

    def compare(cell: pa.Table) -> pa.Table:
        lists = cell.column("shingles").combine_chunks()
        cid = cell.column("cid").to_numpy()
        found = _joining_links(
            np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), cell.column("component").to_numpy(), cell.column("mine").to_numpy(), percent
        )
        return pa.table({"a": pa.array([cid[x] for x, _ in found], pa.int64()), "b": pa.array([cid[y] for _, y in found], pa.int64())})

    return compact(dealt.groupBy("cell").applyInArrow(compare, "a long, b long"))


NAME = ["set1", "set2", "n_shingles"]


def _of_one_id(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of documents whose rows have different sets."""
    several = usable.groupBy("doc_id").agg(*[F.min(c).alias(f"lo_{c}") for c in NAME], *[F.max(c).alias(f"hi_{c}") for c in NAME])
    several = compact(several.filter(" or ".join(f"lo_{c} <> hi_{c}" for c in NAME)).select("doc_id"))
    of = settle(usable.select("doc_id", *NAME).join(several, "doc_id", "left_semi").join(classes.select(*NAME, "cid"), NAME).select("doc_id", "cid").distinct())
    least = of.groupBy("doc_id").agg(F.min("cid").alias("a"))
    return of.join(least, "doc_id").filter("a < cid").select("a", F.col("cid").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id, component_id, kept."""
    signed = settle(sign(docs))
    usable = signed.filter("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy(*NAME).agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits"), F.first("bands").alias("bands"))
    classes = settle(classes.withColumn("cid", F.monotonically_increasing_id()))
    member = classes.select("cid", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.min("cid").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "centre")
    shared = compact(shared)  # the join then has a plain exchange on either side, of which a crowded key's can be split
    keyed = compact(member.join(shared, "key"))  # members of bands that more than one class shares
    traits = classes.select("cid", "n_shingles", "bits")

    def likely(pairs: DataFrame) -> DataFrame:
        a = traits.select(F.col("cid").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("ba"))
        b = traits.select(F.col("cid").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("bb"))
        sized = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
        return pairs.join(a, "a").join(b, "b").filter(sized & (agreement("ba", "bb") >= least_agreement(percent))).select("a", "b")

    stars = keyed.filter("cid <> centre").select(F.col("centre").alias("a"), F.col("cid").alias("b")).distinct()
    tried = compact(likely(stars))
    links = compact(_confirm(tried, classes, docs, percent).unionByName(_of_one_id(usable, classes)))
    of = components(links)

    more = _across(keyed, of, classes, docs, percent)
    if more is not None and not more.isEmpty():
        of = components(links.unionByName(more))

    linked = settle(classes.select("cid", "rep").join(of, F.col("cid") == F.col("node")).select("cid", "rep", "component"))
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    named = linked.join(least, "component").select(F.col("cid").alias("node"), "least")
    labelled = classes.select(*[F.col(c).alias(f"of_{c}") for c in NAME], "cid", "rep").join(named, F.col("cid") == F.col("node"), "left")
    labelled = labelled.select(*[f"of_{c}" for c in NAME], "rep", F.coalesce("least", "rep").alias("least"))
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"of_{c}") for c in NAME])
    found = usable.select("doc_id", *NAME).join(labelled, same).select("doc_id", "n_shingles", F.col("rep").alias("class_id"), F.col("least").alias("component_id"))
    rest = signed.filter("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without all but one document of each component; all columns stay, rows of a kept id as well.

    Rows are decided by doc_id where they lie; only the few that the bit maps can't tell are joined with the ids.
    """
    hashed = lambda c: F.xxhash64(F.coalesce(c.cast("long"), F.lit(-1)), c.isNull())
    made = near_duplicates(docs, percent).select(F.col("doc_id").alias("id"), "kept").groupBy("id").agg(F.bool_or("kept").alias("kept"))
    made = compact(made.withColumn("key", hashed(F.col("id"))))
    both = maps(made.filter("not kept"), made.filter("kept"))
    stays, unsure = sift(docs, hashed(F.col("doc_id")), both)
    alive = tested(made.filter("kept and id is not null"), both).filter("in_goes").select("id")
    some = unsure.join(alive, F.col("row.doc_id") == F.col("id"), "left").filter(F.col("id").isNotNull() | F.col("row.doc_id").isNull())
    return unwrapped(stays.select("row").unionByName(some.select("row")), docs.columns)
