"""Exact dedup, sharding and mixing against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from framewright.llm import mixing, slots, treemerge

LOWER = str.maketrans(treemerge.UPPER, treemerge.LOWER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check_dedup(got, rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    want, kept = Counter(), 0
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    for r in got:
        kept += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert kept == len(groups)


@pytest.mark.parametrize("fan_bits", [1, 4])
def test_dedup(spark, docs, rows, fan_bits):
    check_dedup(treemerge.dedup(docs, fan_bits).collect(), rows)


def test_dedup_odd(spark, odd, empty):
    from tests.llm.conftest import ODD

    check_dedup(treemerge.dedup(odd).collect(), ODD)
    assert treemerge.dedup(empty).collect() == []
    kept = treemerge.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t, _ in ODD})
    clash = odd.withColumnsRenamed({"lang": "run", "source": "digest"})
    assert treemerge.dedup(clash).count() == len(ODD)


def test_keep_one_decides_rows(spark, monkeypatch):
    from tests.llm.conftest import make_docs

    rows = [(k, f"text {k % 40}", "s") for k in range(200)] + [(7, "again", "s")] * 90 + [(None, "none", "s")] * 5 + [(None, "text 3", "s"), (199, "other", "t"), (199, "OTHER", "t")]
    best = {}
    for i, t, _ in rows:
        best.setdefault(t.lower(), []).append(i)
    want = Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in best.items())
    docs = make_docs(spark, rows).repartition(6).withColumnsRenamed({"lang": "__id", "n_chars": "__sha"})
    for words in (1 << 18, 4):  # with four words the maps tell nearly nothing, and the join decides
        monkeypatch.setattr("framewright.llm.sift.WORDS", words)
        kept = treemerge.keep_one(docs)
        assert kept.columns == docs.columns and Counter((r.doc_id, r.text.lower()) for r in kept.collect()) == want


def check_shards(got, rows, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    places = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards(spark, docs, rows, odd, empty):
    from tests.llm.conftest import ODD

    got = slots.shard(docs, 4, 512).collect()
    check_shards(got, rows, 4)
    held = Counter()
    for r in got:
        held[r.shard] += r.size
    mean = sum(held.values()) / 4
    assert all(abs(held[s] - mean) < 0.02 * mean for s in range(4))
    assert got and slots.shard(docs.repartition(3), 4, 512).exceptAll(spark.createDataFrame(got, slots.shard(docs, 4, 512).schema)).count() == 0
    check_shards(slots.shard(odd, 16).collect(), ODD, 16)
    assert slots.shard(empty, 16).collect() == []


def test_grown_map_moves_only_into_the_new_shard(spark, docs, tmp_path):
    store = slots.MapStore(spark, f"{tmp_path}/map")
    before = {r.doc_id: r.shard for r in slots.shard(docs, 4, 512, store).collect()}
    first = {r.vslot: r for r in store.load(1).collect()}
    grown = {r.vslot: r for r in store.grow(4).collect()}
    assert store.versions() == [1, 2] and len(first) == len(grown) == 512
    new = 0
    for v, r in first.items():
        assert grown[v].shard in (r.shard, 4) and grown[v].version == 2
        new += r.bytes * (grown[v].shard == 4)
    total = sum(r.bytes for r in grown.values())
    assert 0.1 * total < new <= 0.2 * total
    after = {r.doc_id: r.shard for r in slots.shard(docs, 4, 512, store).collect()}
    assert all(after[i] in (before[i], 4) for i in before) and any(after[i] == 4 for i in before)


def test_documents_stay_put_when_more_come(spark, docs, tmp_path):
    from tests.llm.conftest import make_docs

    store = slots.MapStore(spark, f"{tmp_path}/map")
    before = {r.doc_id: r.shard for r in slots.shard(docs, 4, 512, store).collect()}
    more = docs.unionByName(make_docs(spark, [(1000 + k, "x " * 500, "s") for k in range(300)]))
    got = slots.shard(more, 4, 512, store).collect()
    check_slots = defaultdict(list)
    for r in got:
        check_slots[r.shard].append(r.slot)
        assert r.doc_id >= 1000 or r.shard == before[r.doc_id]
    assert all(sorted(p) == list(range(len(p))) for p in check_slots.values()) and store.versions() == [1] and len(got) == len(before) + 300


def test_repeated_ids_spread(spark):
    from tests.llm.conftest import make_docs

    rows = [(5, "again and again", "s")] * 1500 + [(None, "none", "s")] * 1500 + [(k, "a text", "s") for k in range(100, 400)]
    docs = make_docs(spark, rows).repartition(5)
    got = slots.shard(docs, 4).collect()
    check_shards(got, rows, 4)
    held = Counter()
    for r in got:
        held[r.shard] += r.size
    assert max(held.values()) < 1.05 * min(held.values())


def plain_mix(rows, max_epochs=3):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    sums = Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        sums[s] += n
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sums.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > max_epochs * sums[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(max_epochs * sums[s])
            left -= target[s]
            open_.discard(s)
    out = []
    for s in names:
        budget = math.floor(target[s] + 1e-9)
        epochs = budget // sums[s] if sums[s] else 0
        rest = budget - epochs * sums[s]
        mine = sorted((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, n, i) for (i, _, t), n in zip(rows, size, strict=True) if t == s)
        for *_, n, i in mine:
            cut = max(0, min(n, rest))
            rest -= cut
            out.append((i, n, sums[s], round(target[s], 6), epochs * n + cut))
    return Counter(out)


def mixed(df):
    return Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(df).collect())


def test_mix(spark, docs, rows, odd, empty):
    from tests.llm.conftest import ODD, make_docs

    assert mixed(docs) == plain_mix(rows) == mixed(docs.repartition(3))
    assert mixed(odd) == plain_mix(ODD)
    assert mixing.mix(empty).collect() == []
    skewed = [(k, "a b c", "z" if k < 90 else f"s{k}") for k in range(100)]
    assert mixed(make_docs(spark, skewed)) == plain_mix(skewed)
    clash = docs.withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "bucket")
    assert mixed(clash) == plain_mix(rows)


def test_apply_mix(spark, docs, odd):
    took = mixing.apply_mix(docs)
    assert took.columns == docs.columns and took.dtypes == docs.dtypes
    per_source = {r.source: r.words for r in took.selectExpr("source", "size(split(text, ' ')) n").groupBy("source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "words").collect()}
    for r in mixing.mix(docs).select("source", "target").distinct().collect():
        assert abs(per_source.get(r.source, 0) - r.target) <= 150
    assert mixing.apply_mix(odd).columns == odd.columns


def test_apply_mix_of_repeated_rows(spark):
    from tests.llm.conftest import make_docs

    for rows in ([(1, "ten words " * 5, "a")] * 50 + [(k, "a b c", "b") for k in range(10, 20)], [(None, "x y", None)] * 40 + [(k, "a b", "b") for k in range(60)]):
        docs = make_docs(spark, rows).repartition(4).withColumnsRenamed({"lang": "__id", "n_chars": "copies"})
        took = mixing.apply_mix(docs)
        assert took.columns == docs.columns and mixed(docs) == plain_mix(rows)
        words = Counter()
        for r in took.collect():
            words[r.source] += len(r.text.split())
        for r in mixing.mix(docs).select("source", "target").distinct().collect():
            assert abs(words[r.source] - r.target) <= 10


def test_targets_of_many_sources(spark):
    from tests.llm.conftest import make_docs

    rows = [(k, "w " * (k % 37), f"site{k % 900}") for k in range(2700)]
    assert mixed(make_docs(spark, rows)) == plain_mix(rows)
