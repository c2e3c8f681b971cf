"""The registered queries opN_<name>, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import ads, bbit, bpe, gam, mixing, pst, slots, toxicity, treemerge, url_cascade
from framewright.session import spread

#: The rules and the listed domains of op1.
RULES = (
    url_cascade.Rule("allow", "org", "/"),
    url_cascade.Rule("block", "example.org", "/es/"),
    url_cascade.Rule("block", "example.org", "/en/1"),
    url_cascade.Rule("allow", "com", "/fr/"),
    url_cascade.Rule("block", "com", "/de/"),
)
LISTED = (
    "ads-track.example.com",
    "ads-track.example.net",
    "ads-track.example.org",
    "adult-x.example.com",
    "adult-x.example.net",
    "adult-x.example.org",
    "casino-win.example.com",
    "casino-win.example.net",
    "casino-win.example.org",
    "cheap-pills.example.com",
    "cheap-pills.example.net",
    "cheap-pills.example.org",
    "free-bets.example.com",
    "free-bets.example.net",
    "free-bets.example.org",
    "spam-farm.example.com",
    "spam-farm.example.net",
    "spam-farm.example.org",
)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents for operators whose work per text is heavy: a few small files are dealt to all cores."""
    return spread(_read(spark, sf_dir, "documents"))


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.createDataFrame([(k,) for k in LISTED], "key string")
    return url_cascade.judge(_read(spark, sf_dir, "pages"), RULES, keys)


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard(_read(spark, sf_dir, "documents"), shards=16)


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), _read(spark, sf_dir, "labels")
    held = gam.fold(F.col("doc_id"), 5) == 0
    scored = gam.score(docs, gam.train(docs, labels, ~held))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_tree_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treemerge.dedup(_read(spark, sf_dir, "documents"))


def op5_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit.near_duplicates(_texts(spark, sf_dir)).drop("class_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), _read(spark, sf_dir, "labels")
    held = gam.fold(F.col("doc_id"), 3) == 1
    scored = toxicity.score(docs, toxicity.train(docs, labels, ~held))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_texts(spark, sf_dir), TOKENIZER)


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    dealt = spread(docs)
    if dealt is not docs:  # read twice, in one order: that of rows out of a shuffle changes
        dealt = dealt.sortWithinPartitions(F.xxhash64("doc_id", "text"))
    scored = pst.score(dealt, gam.fold(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.search(_read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_url_cascade, op2_virtual_slots, op3_quality_gam, op4_tree_merge, op5_bbit_minhash, op6_toxicity, op7_mixing, op8_bpe, op9_suffix_tree, op10_adaptive_scan)
    }


OP1_SQL = f"""
WITH urls AS (
  SELECT page_id,
         coalesce(CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*', 0),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END, '') AS host,
         coalesce(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END, '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, h || p AS rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS n
  FROM urls JOIN rules r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
listed(k) AS (VALUES {", ".join(f"('{k}')" for k in LISTED)}),
hit AS (SELECT page_id, bool_or(k IS NOT NULL) AS listed FROM urls LEFT JOIN listed ON host = k OR ends_with(host, '.' || k) GROUP BY page_id)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, CASE WHEN hit.listed THEN 'block' ELSE 'allow' END) AS verdict, hit.listed
FROM urls u JOIN hit USING (page_id) LEFT JOIN fit f ON u.page_id = f.page_id AND f.n = 1"""

OP4_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM t JOIN g USING (t)"""

OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT d.doc_id, count(s.g) AS n_shingles FROM documents d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * c >= 85 * (i.n_shingles + j.n_shingles - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen),
k AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN k USING (doc_id)"""

_MIX_CTES = r"""
sized AS (SELECT doc_id, coalesce(source, '') AS skey, source IS NULL AS snull,
                 CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                 md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sums AS (SELECT skey, snull, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY ALL),
ranked AS (SELECT *, 3 * source_size AS cap, CAST((row_number() OVER (ORDER BY snull, skey) - 1) % 3 + 1 AS BIGINT) AS weight FROM sums),
filled AS (SELECT *, sum(source_size) OVER () AS total,
                  coalesce(sum(cap) OVER (ORDER BY cap / weight, snull, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                  sum(weight) OVER (ORDER BY cap / weight, snull, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM ranked),
levels AS (SELECT *, CAST(total - capped AS DOUBLE) / CAST(open_weight AS DOUBLE) AS level FROM filled),
marked AS (SELECT *, max(CASE WHEN level * weight <= cap THEN level END) OVER () AS stop FROM levels),
targets AS (SELECT skey, snull, source_size,
                   CASE WHEN level * weight <= cap THEN least(CAST(cap AS DOUBLE), stop * weight) ELSE CAST(cap AS DOUBLE) END AS target FROM marked),
cuts AS (SELECT s.*, t.source_size, t.target,
                CAST(CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS BIGINT) AS epochs,
                coalesce(sum(s.size) OVER (PARTITION BY s.skey, s.snull ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
         FROM sized s JOIN targets t ON s.skey = t.skey AND s.snull = t.snull)"""
OP7_SQL = f"""
WITH {_MIX_CTES}
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - ahead)) AS BIGINT) AS taken FROM cuts"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_cascade": OP1_SQL, "op4_tree_merge": OP4_SQL, "op5_bbit_minhash": OP5_SQL, "op7_mixing": OP7_SQL}
