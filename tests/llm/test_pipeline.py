"""The pipeline's stages against brute force, and its registration."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import pyarrow as pa
from framewright.llm import gam, tokens, toxicity
from pyspark.sql import functions as F
from tests.llm.test_native import LOWER, plain_mix
from tests.llm.test_text import plain_components
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def plain_copies(rows, max_epochs=3):
    """Every row as often as the mix takes it; the document on the cut stays if at least half of it is taken."""
    took = Counter()
    for (i, n, _, _, taken), times in plain_mix(rows, max_epochs).items():
        took[i] = (taken // n + (2 * (taken % n) >= n > 0 and taken % n > 0) if n else 0) * times
    return Counter({r: took[r[0]] for r in rows if took[r[0]]})


def plain_run(rows, model):
    """The stages on a list of rows: the model's scores, then dictionaries and sets."""
    score = lambda t: float(model.score(*tokens.text_bytes(pa.array([t or ""])))[0])
    clean = [r for r in rows if score(r[1]) < 0.7]
    best = {}
    for i, t, _ in clean:
        best[t.translate(LOWER)] = max(i, best.get(t.translate(LOWER), -1))
    one = [r for r in clean if best[r[1].translate(LOWER)] == r[0]]
    of = plain_components(one)
    near = [r for r in one if of[r[0]] == r[0]]
    library, out = Tokenizer.from_file(corpus_pipeline.TOKENIZER), Counter()
    for (i, t, _), n in plain_copies(near).items():
        ids = library.encode(t, add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += n
    return out


def test_run_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels, gam.fold(F.col("doc_id"), 3) != 1)
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == plain_run(as_rows(docs), model)


def test_stages_on_odd_rows(spark, odd, empty):
    """Nulls, ties, repeated rows, long texts, extra columns with clashing names, and no rows at all."""
    clash = odd.withColumnsRenamed({"lang": "__id", "n_chars": "row"})
    for docs in (clash, empty):
        for name, stage in corpus_pipeline.STAGES:
            made = corpus_pipeline.table(stage(spark, docs, SF), "t")
            assert (made.columns == docs.columns) == (name != "bpe")
            docs = made if name != "bpe" else docs


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    clean = corpus_pipeline.table(stage["toxicity"](spark, docs, SF), "t")
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    good = [i for i, toxic in labels.items() if not toxic]
    assert sum(i in left for i in good) >= 0.97 * len(good)

    one = corpus_pipeline.table(stage["exact_dedup"](spark, clean, SF), "t")
    best = {}
    for i, t, _ in as_rows(clean):
        best[t.translate(LOWER)] = max(i, best.get(t.translate(LOWER), -1))
    assert sorted(r.doc_id for r in one.collect()) == sorted(best.values()) and one.columns == docs.columns

    near = corpus_pipeline.table(stage["near_dedup"](spark, one, SF), "t")
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(plain_components(as_rows(one)).values())) and near.columns == docs.columns

    mixed = corpus_pipeline.table(stage["mixing"](spark, near, SF), "t")
    assert mixed.columns == docs.columns and Counter(as_rows(mixed)) == plain_copies(as_rows(near))

    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    want = Counter((i, hashlib.sha256(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest()) for i, t, _ in as_rows(mixed))
    assert Counter((r.doc_id, r.ids_sha256) for r in stage["bpe"](spark, mixed, SF).collect()) == want


def test_run_and_entry(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert corpus_pipeline.run(spark, SF).count() > 0
