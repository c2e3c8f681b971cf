"""Near-duplicates, tokenisation, language model, classifiers, urls and vectors against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from framewright.llm import ads, bbit, bpe, gam, graph, pst, tokens, toxicity, url_cascade
from framewright.llm.treemerge import LOWER, UPPER
from tests.llm.conftest import ODD, make_docs

ASCII = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("word_bpe_49k.json")


def words_of(text):
    return WORD.findall((text or "").translate(ASCII))


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows, percent=85):
    sets = [(i, shingle_set(t)) for i, t, _ in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i, _ in sets}


@given(st.lists(st.text(alphabet=st.sampled_from("aAbB é\t\n\x0b\x1cß日"), max_size=30), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_hashes(texts):
    data, offsets = tokens.text_bytes(pa.array(texts))
    hashes, at = tokens.words(data, offsets)
    names = [w for t in texts for w in words_of(t)]
    assert len(hashes) == len(names)
    assert [b - a for a, b in zip(at[:-1], at[1:], strict=True)] == [len(words_of(t)) for t in texts]
    assert hashes.tolist() == [tokens.word_hash(w) for w in names]


def test_long_text_is_cut_between_words():
    text = "alpha beta " * 100_000 + "z" * 1_300_000 + " tail"
    data, offsets = tokens.text_bytes(pa.array([text]))
    hashes, at = tokens.words(data, offsets)
    assert at.tolist() == [0, 200_002]
    assert hashes[-1] == tokens.word_hash("tail") and hashes[-2] == tokens.word_hash("z" * 1_300_000) and len(set(hashes.tolist())) == 4


def test_near_duplicates(spark, docs, rows):
    got = bbit.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(rows)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingle_set(t)) for i, t, _ in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_one_large_group(spark):
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(300):  # neighbours are similar, the ends of the chain are not
        words = list(base)
        words[: k // 4] = [f"n{x}" for x in range(k // 4)]
        rows.append((k, " ".join(words), "s"))
    got = {r.doc_id: r.component_id for r in bbit.near_duplicates(make_docs(spark, rows)).collect()}
    assert got == plain_components(rows)


@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=10), min_size=2, max_size=14), st.booleans())
@settings(max_examples=60, deadline=None)
def test_links_of_a_block(sets, halves):
    side = np.array([k % 2 if halves else 0 for k in range(len(sets))])
    flat = np.array([x for s in sets for x in sorted(s)], np.int64)
    found = bbit._joining_links(np.array([len(s) for s in sets]), flat, np.arange(len(sets)), side, 60)

    def classes(pairs):
        up = list(range(len(sets)))
        for _ in sets:
            for a, b in pairs:
                up[a] = up[b] = min(up[a], up[b])
        return up

    every = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b]) and (not halves or side[a] != side[b])]
    assert classes(found) == classes(every) and len(found) < len(sets)


def test_many_similar_texts_that_are_no_links(spark):
    base = [f"b{k}" for k in range(150)]
    rng = np.random.default_rng(8)
    rows = []
    for k in range(400):  # copies with one to six changed words: most are similar to many others and linked with none
        words = list(base)
        for at in rng.choice(150, rng.integers(1, 7), replace=False):
            words[at] = f"n{k}_{at}"
        rows.append((k, " ".join(words), "s"))
    got = {r.doc_id: r.component_id for r in bbit.near_duplicates(make_docs(spark, rows).repartition(5)).collect()}
    assert got == plain_components(rows)


def test_a_doc_id_with_several_texts_is_one_document(spark):
    words = [f"v{k}" for k in range(60)]
    near = lambda at: " ".join(["z", *words[1:]] if at else words)
    other = " ".join(f"q{k}" for k in range(40))
    rows = [(1, near(0), "s"), (2, near(1), "s"), (2, other, "s"), (3, other + " more", "s"), (4, "alone here", "s"), *[(9, f"t{k} " * 7, "s") for k in range(30)], (10, "t5 " * 7, "s")]
    docs = make_docs(spark, rows)
    got = {(r.doc_id, r.component_id, r.kept) for r in bbit.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (9, 9, True), (10, 9, False)}
    kept = bbit.keep_one(docs.withColumnsRenamed({"lang": "__id", "n_chars": "key"}))
    assert Counter(r.doc_id for r in kept.collect()) == {1: 1, 4: 1, 9: 30} and kept.columns == ["doc_id", "text", "__id", "source", "key"]


def test_near_duplicates_odd(spark, odd, empty):
    got = bbit.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == plain_components(ODD)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert bbit.near_duplicates(empty).collect() == []
    assert bbit.keep_one(odd).columns == odd.columns


def test_agreement_estimates_similarity(spark):
    rng = np.random.default_rng(2)
    pool = [f"t{k}" for k in range(9000)]
    errors = []
    for share in (0.5, 0.7, 0.85, 0.95):
        n = 2000
        both = [pool[k] for k in rng.permutation(9000)[:n]]
        other = both[: int(n * share)] + [f"u{k}" for k in range(n - int(n * share))]
        signed = bbit.sign(make_docs(spark, [(1, " ".join(both), "s"), (2, " ".join(other), "s")])).collect()
        df = spark.createDataFrame([(signed[0].bits, signed[1].bits)], "a array<long>, b array<long>")
        a, b = shingle_set(" ".join(both)), shingle_set(" ".join(other))
        errors.append(abs(df.select(bbit.agreement("a", "b")).first()[0] - len(a & b) / len(a | b)))
    assert max(errors) < 0.2


@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=25))
@settings(max_examples=5, deadline=None)
def test_components(spark, edges):
    up = {n: n for e in edges for n in e}
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {n: c for n, c in up.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_bpe_matches_the_library():
    coder, library = bpe.WordBpe(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(PATH)
    texts = [t or "" for _, t, _ in ODD] + ["ΑΣ ΟΔΟΣ İstanbul ǅ é ﬁ ẞ", "日本語 テスト 123 ½ ² ٣ 😀👍🏽", "can't WE'LL 'S", "ab" * 3000, "\x00\x85\u200b\ufeff", "<|ENDOFTEXT|>x<|endoftext|>y"]
    texts += [chr(c) + "a" + chr(c).upper() for c in range(1, 0x600)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        n, ids, decoded = coder.both(t)
        assert (n, [int(x) for x in ids.split()]) == (len(want), want), repr(t[:40])
        assert decoded == library.decode(want, skip_special_tokens=False) == coder.decode(want)


def test_bpe_remembers_frequent_words_in_bounded_memory(monkeypatch):
    """Words that come once push out neither a frequent word nor, when a generation ends in the middle of a text, a right result."""
    monkeypatch.setattr(bpe, "REMEMBER", 50)
    coder, library, merged = bpe.WordBpe(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(PATH), []
    merge = coder.merge
    coder.merge = lambda word: merged.append(word) or merge(word)
    once = ["".join(chr(97 + k // 26**n % 26) for n in range(3)) + "qz" for k in range(400)]
    for a, b in zip(once[::2], once[1::2], strict=True):
        text = f"Frequent {a} {a}é frequent, {b.upper()}!"
        assert [int(x) for x in coder.both(text)[1].split()] == library.encode(text, add_special_tokens=False).ids
    assert merged.count("frequent") == 1 and len(merged) == len(set(merged))
    assert all(len(kept) <= 50 for store in (coder.near, coder.seen) for kept in (store.late, store.before))
    assert coder.library.get_vocab_size() == 0


@given(st.text(alphabet=st.sampled_from("etaoinshr"), min_size=1, max_size=90))
@settings(max_examples=200, deadline=None)
def test_scan_and_heap_agree(word):
    coder = _coder()
    parts = [*(coder.inner[c] for c in word[:-1]), coder.last[word[-1]]]
    assert coder._scan(list(parts)) == coder._heap(list(parts))


_kept: list[bpe.WordBpe] = []


def _coder() -> bpe.WordBpe:
    if not _kept:
        _kept.append(bpe.WordBpe(open(PATH, encoding="utf-8").read()))
    return _kept[0]


def test_bpe_query(spark, odd, empty):
    library = Tokenizer.from_file(PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t, _ in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in bpe.digests(odd, PATH).collect()) == want
    assert bpe.digests(empty, PATH).collect() == []
    assert sum(len(r.ids) for r in bpe.encode(odd, PATH).collect()) == sum(k[1] * v for k, v in want.items())


def plain_base(rows, train):
    seqs = [(i, [*words_of(t), None]) for i, t, _ in rows]
    c = Counter(w for i, s in seqs if train(i) for w in s)
    n, v = sum(c.values()), len(c)
    return n, Counter((i, len(s), sum(c[w] > 0 for w in s), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s), 5)) for i, s in seqs)


def in_train(i):
    import zlib

    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_suffix_tree_base(request, rows, which):
    df = request.getfixturevalue(which)
    total, want = plain_base(rows if which == "docs" else ODD, in_train)
    got = pst.score(df, gam.fold(F.col("doc_id"), 7) != 2).collect()
    assert {r.train_tokens for r in got} == {total}
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert all(r.train == in_train(r.doc_id) for r in got)


def test_suffix_tree_learns(spark, empty):
    rng = np.random.default_rng(4)
    follow = {"a": "b", "b": "c", "c": "a", "d": "d"}
    rows = []
    for k in range(400):
        w, out = "a", []
        for _ in range(40):
            w = follow[w] if rng.random() < 0.8 else str(rng.choice(list("abcd")))
            out.append(w)
        rows.append((k, " ".join(out) + (f" rare{k}" if k % 3 else ""), "s"))
    docs, train = make_docs(spark, rows), gam.fold(F.col("doc_id"), 7) != 2
    got = pst.score(docs, train).collect()
    held = [r for r in got if not r.train]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    assert pst.score(empty, train).collect() == []
    assert pst.score(docs, F.lit(False)).count() == len(rows)


def plain_tree(rows, train, depth=3, least=2, discount=0.75):
    """Score of each text by the tree's definition, in dictionaries."""
    seqs = [(i, [*words_of(t), None]) for i, t, _ in rows]
    words = Counter(w for i, s in seqs if train(i) for w in s)
    rare = [w for w, n in words.items() if n < least and w is not None]
    inside, norm = sum(words[w] for w in rare) + len(rare) + 1, sum(words.values()) + len(words) + 1
    symbol = lambda w: w if w is None or words[w] >= least else "RARE"
    grams = Counter(tuple(map(symbol, s[k : k + n])) for i, s in seqs if train(i) for n in range(1, depth + 2) for k in range(len(s) - n + 1))
    root = lambda x: (inside if x == "RARE" else words[x] + 1) / norm
    kept, follow = {}, defaultdict(dict)
    for g, n in grams.items():
        if len(g) > 1 and n >= least:
            follow[g[:-1]][g[-1]] = n

    def chance(c, x):
        while c and c not in kept:
            c = c[1:]
        if not c:
            return root(x)
        entries, free = kept[c]
        return entries[x] if x in entries else free * chance(c[1:], x)

    for c in sorted(follow, key=len):
        n, size = follow[c], grams[c]
        up = {x: chance(c[1:], x) for x in n}
        rest, rest_up = size - sum(n.values()), max(1e-12, 1 - sum(up.values()))
        gain = sum(m * math.log(m / size / up[x]) for x, m in n.items()) + (rest * math.log(rest / size / rest_up) if rest else 0)
        if gain > len(n) / 2 * math.log(max(2, size)):
            held = {x: m - (discount if rest_up > 1e-9 else 0) for x, m in n.items()}
            kept[c] = {x: m / size for x, m in held.items()}, (1 - sum(held.values()) / size) / rest_up if rest_up > 1e-9 else 1.0
    out = {}
    for i, s in seqs:
        s_ = [symbol(w) for w in s]
        out[i] = sum(math.log10(chance(tuple(s_[max(0, k - depth) : k]), x)) + (math.log10((words[w] + 1) / inside) if x == "RARE" else 0) for k, (w, x) in enumerate(zip(s, s_, strict=True)))
    return len(kept), out


@pytest.mark.parametrize("part", [pst.PART, 700, 60])
def test_suffix_tree_equals_its_definition(docs, rows, part):
    """With small parts many symbols are hot; RARE among them."""
    kept, want = plain_tree(rows, in_train)
    train = gam.fold(F.col("doc_id"), 7) != 2
    got = {r.doc_id: r.score for r in pst.score(docs, train, part=part).collect()}
    assert kept > 100 and set(got) == set(want)
    assert all(abs(got[i] - want[i]) < 1e-6 * max(1, abs(want[i])) for i in want)
    found = pst.tree(docs, train, part=part).collect()
    assert len({tuple(r.context) for r in found}) == kept == sum(r.symbol is None for r in found)


def test_suffix_tree_sums_to_one(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(rng.choice(list("aaabbc"), 30)).replace("a b", "a b c") + (f" rare{k}" if k % 3 else ""), "s") for k in range(200)]
    found = pst.tree(make_docs(spark, rows), F.lit(True)).collect()
    names = {(): {}}  # context -> symbol -> probability
    slack = {tuple(r.context): math.exp(r.ln) for r in found if r.symbol is None}
    for r in found:
        if r.symbol is not None:
            names.setdefault(tuple(r.context), {})[r.symbol] = math.exp(r.ln)
    words = Counter(w for _, t, _ in rows for w in [*words_of(t), None])
    norm = sum(words.values()) + len(words) + 1
    rare = [w for w, n in words.items() if n == 1]
    common = sorted((n + 1) / norm for w, n in words.items() if n > 1)
    assert len(slack) > 3 and abs(sum(common) + (2 * len(rare) + 1) / norm - 1) < 1e-12
    for context in sorted(slack, key=len):
        up = context[1:]
        while up and up not in slack:
            up = up[1:]
        if up:  # entries of a context have one in its retained suffix, or take the suffix's share for the rest
            under = sum(names[up].get(x, 0) for x in names[context])
            if all(x in names[up] for x in names[context]):
                assert abs(sum(names[context].values()) + slack[context] * (1 - under) - 1) < 1e-9


def test_suffix_tree_keeps_what_is_seldom_in_a_large_corpus(spark):
    filler = " ".join(f"f{k % 50}" for k in range(2000))
    rows = [(k, filler, "s") for k in range(300)] + [(300 + k, f"seldom{k // 4} follows{k // 4}", "s") for k in range(80)]
    got = {r.doc_id: r for r in pst.score(make_docs(spark, rows), F.lit(True)).collect()}
    assert all(got[300 + k].score > got[300 + k].base_score + 3 for k in range(80))


def test_word_numbers_of_any_width():
    for top in (0, 255, 256, 1 << 24, 1 << 33):
        ids = np.array([0, top, top // 2], np.int64)
        assert pst._unpack(pst._pack(ids)).tolist() == ids.tolist()


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_gam_finds_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(4000) < 0.05)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert auc(model.score(x[3000:]), y[3000:]) > 0.9
    assert auc(model.score(x[3000:]), y[3000:]) > auc(gam.fit(x[:3000], y[:3000], pairs=0).score(x[3000:]), y[3000:]) + 0.2


def classified(spark, which):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    if which == "quality":
        held = gam.fold(F.col("doc_id"), 5) == 0
        scored = gam.score(docs, gam.train(docs, labels, ~held))
    else:
        held = gam.fold(F.col("doc_id"), 3) == 1
        scored = toxicity.score(docs, toxicity.train(docs, labels, ~held))
    rows = scored.join(labels, "doc_id").filter(held).select("score", F.col(which).alias("y")).collect()
    return np.array([r.score for r in rows]), np.array([r.y for r in rows])


@pytest.mark.parametrize(("which", "least"), [("quality", 0.97), ("toxic", 0.97)])
def test_held_out_accuracy(spark, which, least):
    score, y = classified(spark, which)
    assert auc(score, y) > least and score.min() >= 0 and score.max() <= 1
    if which == "toxic":
        assert (score[y == 1] >= 0.7).mean() > 0.85 and (score[y == 0] >= 0.7).mean() < 0.02
    else:
        assert ((score >= 0.3) == y).mean() > 0.95


SF = "/root/testdata/sf0.001"


def plain_measures(text):
    """The features of a text, one by one."""
    raw, words = text.encode(), words_of(text)
    n, m = max(1, len(raw)), max(1, len(words))
    count = lambda chars: sum(text.count(c) for c in chars)
    space = sum(c in b" \t\n\x0b\x0c\r" for c in raw)
    fives = shingle_set(text)
    return [
        math.log1p(len(words)),
        (len(raw) - space) / m,
        sum(65 <= c <= 90 for c in raw) / n,
        sum(48 <= c <= 57 for c in raw) / n,
        count("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") / n,
        sum(c > 127 for c in raw) / n,
        text.count("\n") / n,
        text.count("|") / m,
        text.count("!") / m,
        count("#$%&*") / m,
        len(set(words)) / len(words) if words else 0,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / (len(words) - 1) if len(words) > 1 else 0,
        max(Counter(words).values()) / len(words) if words else 0,
        1 - len(fives) / max(1, len(words) - 4) if words else 0,
        math.log1p(len(words) / (1 + count(".!?"))),
        space / n,
        space / m,
    ]


def test_quality_query_against_plain_lookups(spark):
    from framewright.llm import queries

    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    held = gam.fold(F.col("doc_id"), 5) == 0
    model = gam.train(docs, labels, ~held)
    got = {r.doc_id: r for r in queries.op3_quality_gam(spark, SF).collect()}
    rows = docs.select("doc_id", "text", held.alias("held")).collect()
    assert len(got) == len(rows) and len(model.pairs) > 0
    for r in rows:
        x = plain_measures(r.text or "")
        place = lambda edges, k: sum(e <= x[k] for e in edges[k])  # noqa: B023, E731
        logit = model.base + sum(t[place(model.edges, k)] for k, t in enumerate(model.one))
        logit += sum(t[place(model.coarse, i), place(model.coarse, j)] for (i, j), t in zip(model.pairs, model.two, strict=True))
        want = 1 / (1 + math.exp(-max(-30, min(30, logit))))
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == (want >= 0.3) and got[r.doc_id].held_out == r.held


def test_toxicity_query_against_plain_sums(spark):
    from framewright.llm import queries

    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    held = gam.fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, labels, ~held)
    weight = dict(zip(model.keys.tolist(), model.weight.tolist(), strict=True))
    head = lambda w, k: int(tokens._words(np.frombuffer(w, np.uint8), np.array([0, len(w)]), np.zeros(256, bool), (k,))[0][0, 1])
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, SF).collect()}
    rows = docs.select("doc_id", "text", held.alias("held")).collect()
    assert len(got) == len(rows) and len(weight) > 30
    for r in rows:
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").translate(ASCII).encode()))
        has = {tokens.word_hash(w.decode("utf-8", "surrogateescape")) if w.isascii() else int(tokens._words(np.frombuffer(w, np.uint8), np.array([0, len(w)]), np.zeros(256, bool))[0][0]) for w in words}
        has |= {head(w, k) for w in words for k in toxicity.HEADS if len(w) > k}
        want = 1 / (1 + math.exp(-max(-30, min(30, model.base + sum(weight.get(h, 0.0) for h in has)))))
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == (want >= 0.7) and got[r.doc_id].held_out == r.held


def test_counterfactual_loss_is_that_of_swapped_texts():
    """The penalised part of the gradient: the squared score change of every swapped copy of a text, made and measured as a text."""
    texts = ["the muslim man walked", "muslims and a christian", "black and white cats", "nothing here", "women men women"]
    keys = np.unique(np.concatenate([np.array([tokens.word_hash(w) for t in texts for w in t.split()], np.uint64), *toxicity.identity_features().values()]))
    weight = np.random.default_rng(2).normal(size=len(keys))
    model = toxicity.Model(keys, weight, 0.3)
    logit = lambda t: float(model.logit(*tokens.text_bytes(pa.array([t])))[0])
    want = Counter()
    for t in texts:
        for group in toxicity.IDENTITY:
            for a in set(group) & set(t.split()):
                for b in set(group) - {a}:
                    want[round(logit(" ".join(b if w == a else w for w in t.split())) - logit(t), 6)] += 1
    features = {k: set(np.flatnonzero(np.isin(keys, f)).tolist()) for k, f in toxicity.identity_features().items()}
    terms, watched = np.array(sorted(features), np.uint64), np.array(sorted(set().union(*features.values())), np.int64)
    hashes, at = tokens.words(*tokens.text_bytes(pa.array(texts)), tokens.NOT_ALNUM, toxicity.HEADS)
    named, others = toxicity._named(hashes, at, keys, terms, watched)
    changes = toxicity.swapped(((n % 2**64, o) for ns, os in zip(named, others, strict=True) for n, o in zip(ns, os, strict=True)), features, toxicity.identity_keys())
    got = Counter()
    for (gained, lost), times in changes.items():
        got[round(float(weight[list(gained)].sum() - weight[list(lost)].sum()), 6)] += times
    assert got == want and sum(got.values()) > 20


def test_classifiers_odd(spark, odd, empty):
    none = labels_of(spark, [])
    some = labels_of(spark, [(1, 1, 0), (1, 0, 1), (6, None, None), (10, 0, 1), (None, 1, 1), (8, 1, 0)])
    for module in (gam, toxicity):
        for labels in (none, some):
            model = module.train(odd, labels, F.lit(True))
            got = module.score(odd, model).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
            assert module.score(empty, model).collect() == []
        assert module.score(odd, module.train(empty, some, F.lit(True))).count() == len(ODD)
    clean = toxicity.keep_clean(odd, toxicity.train(odd, some, F.lit(True)))
    assert clean.columns == odd.columns


def test_counterfactual_penalty_takes_weight_from_identity_terms():
    rng = np.random.default_rng(0)
    n, width = 2000, 3  # an insult, and two groups of which one is insulted more often
    y = rng.integers(0, 2, n)
    group = np.where(y == 1, rng.random(n) < 0.8, rng.random(n) < 0.2)
    insult = (y == 1) & (rng.random(n) < 0.7)
    has = np.column_stack([insult, group, ~group])
    rows, cols = np.nonzero(has)
    plain, _ = toxicity.fit(rows, cols, y.astype(float), width, [[1, 2]], fairness=0.0)
    fair, _ = toxicity.fit(rows, cols, y.astype(float), width, [[1, 2]], fairness=10.0)
    assert abs(plain[1] - plain[2]) > 1 and abs(fair[1] - fair[2]) < 0.25 * abs(plain[1] - plain[2]) and fair[0] > 1


def test_swaps_cover_beginnings_of_identity_terms(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for k in range(1500):
        toxic = bool(rng.random() < 0.4)
        group = "muslim" if rng.random() < (0.6 if toxic else 0.05) else str(rng.choice(["hindu", "christian", "jewish"]))
        insult = "stupid" if toxic and rng.random() < 0.7 else "quiet"
        rows.append((k, " ".join(["the", group, insult, f"w{rng.integers(0, 300)}", "walked"]), "s"))
        labels.append((k, 1, int(toxic)))
    model = toxicity.train(make_docs(spark, rows), labels_of(spark, labels), F.lit(True))
    data, offsets = tokens.text_bytes(pa.array([f"the {g} walked" for g in ("muslim", "hindu", "christian", "jewish")]))
    logit = model.logit(data, offsets)
    assert logit.max() - logit.min() < 0.3


def test_swap_keeps_what_other_words_have():
    keys = np.unique(np.concatenate([*toxicity.identity_features().values()]))
    features = {k: set(np.flatnonzero(np.isin(keys, f)).tolist()) for k, f in toxicity.identity_features().items()}
    watched = np.arange(len(keys))
    column = lambda w: int(np.searchsorted(keys, np.uint64(tokens.word_hash(w))))
    for text in ("muslim here", "muslims and a muslim here", "hindu muslim muslim"):
        hashes, at = tokens.words(*tokens.text_bytes(pa.array([text])), tokens.NOT_ALNUM, toxicity.HEADS)
        named, others = toxicity._named(hashes, at, keys, np.array(sorted(features), np.uint64), watched)
        want = Counter()
        has = lambda t: set(toxicity.present(*tokens.text_bytes(pa.array([t])), keys)[1].tolist())
        for group in toxicity.IDENTITY:
            for s in set(group) & set(text.split()):
                for t in set(group) - {s}:
                    copy = " ".join(t if w == s else w for w in text.split())
                    want[tuple(sorted(has(copy) - has(text))), tuple(sorted(has(text) - has(copy)))] += 1
        got = toxicity.swapped(((n % 2**64, o) for n, o in zip(named[0], others[0], strict=True)), features, toxicity.identity_keys())
        assert got == want and column("muslim") in {c for _, lost in got for c in lost}


URLS = [None, "", "no scheme", "http://", "http:///p", "HTTP://A.B.Com/X?y#z", "ftp://x.org?q", "http://es.example.org/es/1", "http://example.org/es", "http://example.org/en/12", "https://m.bad.net/#a", "https://bad.net.com/fr/", "a://b://c/d", "http://..bad.net", "http://x.com/de/a\nb"]


def test_urls(spark):
    rules = [url_cascade.Rule("allow", "org", "/"), url_cascade.Rule("block", "example.org", "/es/"), url_cascade.Rule("allow", "com", "/fr/"), url_cascade.Rule("block", "com", "/de/")]
    pages = spark.createDataFrame([*enumerate(URLS), (3, URLS[3])], "page_id long, url string").withColumn("host", F.lit("clash"))
    keys = spark.createDataFrame([("bad.net",), ("bad.net",), (None,), ("absent.net",)], "key string")
    got = {r.page_id: r for r in url_cascade.judge(pages, rules, keys).collect()}
    for i, url in enumerate(URLS):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(ASCII)
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.text), default=None)
        bad = host == "bad.net" or host.endswith(".bad.net")
        want = (host, path, rule and rule.text, rule.verdict if rule else "block" if bad else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, url
    nothing = spark.createDataFrame([], "page_id long, url string")
    assert url_cascade.judge(nothing, rules, keys).collect() == []
    assert url_cascade.judge(pages, [], keys.limit(0)).filter("verdict = 'block'").count() == 0


def test_hosts_of_very_many_labels(spark):
    import time

    host = "a." * 60_000 + "bad.net"
    pages = spark.createDataFrame([(1, f"http://{host}/x"), (2, f"http://{host}.com/y")], "page_id long, url string")
    began = time.time()
    rules = [url_cascade.Rule("block", "com", "/"), url_cascade.Rule("allow", "a.bad.net", "/x/")]
    got = {r.page_id: (r.rule, r.verdict, r.listed) for r in url_cascade.judge(pages, rules, spark.createDataFrame([("BAD.net",)], "key string")).collect()}
    assert got == {1: (None, "block", True), 2: ("com/", "block", False)} and time.time() - began < 60


def test_many_rules(spark):
    rules = [url_cascade.Rule("block" if k % 2 else "allow", f"h{k}.org", f"/p{k % 3}") for k in range(3000)]
    pages = spark.createDataFrame([(k, f"http://x.h{k}.org/p{k % 3}/q") for k in range(0, 3000, 7)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_cascade.judge(pages, rules, spark.createDataFrame([], "key string")).collect()}
    assert got == {k: (rules[k].text, rules[k].verdict) for k in range(0, 3000, 7)}


def test_cascade_in_shards(spark):
    hosts = spark.range(300).select(F.concat(F.lit("m.h"), F.col("id").cast("string"), F.lit(".net")).alias("host"))
    keys = spark.range(0, 300, 3).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".net")).alias("key"))
    got = url_cascade.listed(hosts, keys, max_mb=0.0003).collect()  # two shards
    assert sorted(r.host for r in got if r.listed) == sorted(f"m.h{k}.net" for k in range(0, 300, 3)) and len(got) == 300


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    listed = spark.range(0, 20_000, 7).select(F.xxhash64("id").alias("key"))
    cascade = url_cascade.build(listed, universe)
    assert len(cascade.levels) > 2
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("key")).collect()
    has = cascade.has(np.array([r.key for r in rows]).view(np.uint64))
    assert [bool(h) for h in has] == [r.id % 7 == 0 for r in rows]


def plain_search(vectors, every, k):
    ok = [(i, np.array(v, float)) for i, v in vectors if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            out[i] = sorted(((-float(sum(q * x)), j) for j, x in ok if j != i))[:k]
    return out


def test_search(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[500:1500] = x[500]  # a crowd of equal vectors
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    got = ads.search(table).collect()
    want = plain_search([(i, v) for i, v in enumerate(x)], 20, 20)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.score, r.vec_id))
        assert abs(r.score - float(x[r.query_id].astype(float) @ x[r.vec_id].astype(float))) < 1e-9
    assert set(found) == set(want)
    assert all(f == sorted(f, key=lambda p: (-p[0], p[1])) for f in found.values())
    hits = sum(len({j for _, j in want[q]} & {j for _, j in found[q]}) for q in want)
    assert hits / sum(len(w) for w in want.values()) >= 0.95


def test_lists_decide_and_every_query_is_filled(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    fit = ads.fit

    def one_list(*args):
        index = fit(*args)
        index.probes = 1
        return index

    monkeypatch.setattr(ads, "fit", one_list)
    got = ads.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    want = plain_search(list(enumerate(x)), 20, 20)
    assert Counter(r.query_id for r in got) == {q: 20 for q in want}
    found = {(r.query_id, r.vec_id): r.score for r in got}
    assert all(abs(score - x[q] @ x[j]) < 1e-9 for (q, j), score in found.items())
    assert sum((q, j) in found for q in want for _, j in want[q]) == 20 * len(want)  # the bound is that of the 20 nearest here, so the scan goes on until it has them


def test_results_come_from_the_scan_and_not_from_the_sample(spark, monkeypatch):
    x, fit = np.random.default_rng(9).normal(size=(1500, 12)), ads.fit

    def renamed(*args):
        index = fit(*args)
        index.sample_ids = index.sample_ids + 1_000_000
        return index

    monkeypatch.setattr(ads, "fit", renamed)
    got = ads.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    assert got and all(r.vec_id < 1500 for r in got)


def test_what_is_sent_grows_with_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(ads, "QUERIES", 40)
    monkeypatch.setattr(ads, "CELL_BYTES", 40 * 8 * 8)  # as many vectors
    sent = {}
    for n in (2000, 8000):
        x = np.random.default_rng(3).normal(size=(n, 8))
        table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        index = ads.fit(ads.usable(table, "embedding"), 8)
        own = index.lists(index.rotated(x, False), 1)[:, 0]
        cell = index.first_cell[own] + np.arange(n) % index.cells[own]
        asked = index.reached(index.rotated(x[::20], True), index.probes).sum(0)
        sent[n] = (-(-asked // 40))[cell].sum() / (n + asked.sum())
        got = ads.search(table).groupBy("query_id").count().collect()
        assert len(got) == n // 20 and all(r["count"] == 20 for r in got)
    assert max(sent.values()) <= 2


def test_search_odd(spark):
    schema = "vec_id long, embedding array<double>, score string"
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, [2.0, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [-1.0, 3.0]), (7, [2.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], schema)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ads.search(table).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 7, 2.0), (0, 3, 20, -1.0), (20, 1, 1, 1.0), (20, 2, 7, 1.0), (20, 3, 0, -1.0)]
    assert ads.search(table.limit(0)).collect() == []


def test_length_of_the_first_vector_does_not_decide(spark):
    rows = [(0, [1.0]), (1, [2.0, 1.0]), (20, [-1.0, 3.0]), (40, [1.0, 1.0])]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ads.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 40, 2.0), (20, 2, 1, 1.0), (40, 1, 1, 3.0), (40, 2, 20, 2.0)]
