"""Registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.llm import ann, bpe, lines, merkle, mixing, negatives, quality, secrets, sharding, simhash, spans, topk, warc

#: Target shares of words by language.
SHARES = {"en": 0.52, "de": 0.17, "fr": 0.17, "es": 0.14}
TOKENIZER = "byte_bpe_50k.json"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run):
    REGISTRY[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spec(path: str | None = None) -> str:
    """Content of a tokenizer file, by default that of the byte-level BPE."""
    return bpe.read_spec(path or public_tokenizers.path(TOKENIZER))


def labelled_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and language, as domain, of the documents that ``labels`` lists."""
    ids = table(spark, sf_dir, "labels").select("doc_id").distinct()
    known = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("domain"))
    return known.join(ids, "doc_id", "left_semi")


@query
def op1_substring_dedup(spark, sf_dir):
    found = spans.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op2_multi_index_hashing(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query
def op3_soft_mixing(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"), labelled_languages(spark, sf_dir), SHARES)
    return found.drop("body")


@query
def op4_factorisation_machine(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), spec())


@query
def op7_bit_sliced_topk(spark, sf_dir):
    return topk.highest(table(spark, sf_dir, "embeddings"))


@query
def op8_hilbert_shards(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


@query
def op10_warc(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query
def op11_line_dedup(spark, sf_dir):
    found = lines.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op12_hard_negatives(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", shifted))


@query
def op13_merkle_manifest(spark, sf_dir):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), changed)


SQL["op1_substring_dedup"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
g AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM s),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
c AS (SELECT DISTINCT g.r, unnest(range(g.i, g.i + 13)) AS i FROM g JOIN f ON g.k = f.k WHERE f.first < g.doc_id),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
t AS (
    SELECT x.r, count(*) AS n_words, count(c.i) AS n_removed,
        string_agg(x.word, ' ' ORDER BY x.i) FILTER (c.i IS NULL) AS kept
    FROM x LEFT JOIN c ON x.r = c.r AND x.i = c.i GROUP BY x.r)
SELECT d.doc_id, coalesce(t.n_words, 0) AS n_words, coalesce(t.n_removed, 0) AS n_removed,
    sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON d.r = t.r
"""

SQL["op7_bit_sliced_topk"] = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT r, vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
q AS (SELECT * FROM c WHERE r IN (SELECT min(r) FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id)),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id GROUP BY q.vec_id, c.vec_id, c.r)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

SQL["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS last
    FROM q)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM m
"""

SQL["op11_line_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS every FROM documents),
l AS (SELECT r, doc_id, unnest(every) AS line, generate_subscripts(every, 1) AS pos FROM d),
k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(k.doc_id < c.last, FALSE) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""

SQL["op12_hard_negatives"] = """
WITH u AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, e) = 1),
c AS (SELECT vec_id, label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
    FROM c AS a JOIN c ON a.i = c.i AND a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
    GROUP BY a.vec_id, c.vec_id, a.label, c.label),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

SQL["op13_merkle_manifest"] = """
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, *, list_reduce(range(0, 8 * len(CAST(doc_id AS VARCHAR))),
        lambda c, k: CASE WHEN (CASE WHEN k % 8 = 0 THEN xor(c, ord(CAST(doc_id AS VARCHAR)[k // 8 + 1])) ELSE c END) & 1 = 1
            THEN xor((CASE WHEN k % 8 = 0 THEN xor(c, ord(CAST(doc_id AS VARCHAR)[k // 8 + 1])) ELSE c END) >> 1, 3988292384)
            ELSE (CASE WHEN k % 8 = 0 THEN xor(c, ord(CAST(doc_id AS VARCHAR)[k // 8 + 1])) ELSE c END) >> 1 END,
        CAST(4294967295 AS BIGINT)) AS crc
    FROM documents),
f AS (
    SELECT r, doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
            || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS front,
        n_chars AS n, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m,
        coalesce(strlen(text) || ':' || text, '-') AS back
    FROM d),
leaves AS (
    SELECT r, doc_id, lang, sha256(front || coalesce(strlen(CAST(n AS VARCHAR)) || ':' || CAST(n AS VARCHAR), '-') || back) AS leaf,
        sha256(front || coalesce(strlen(CAST(m AS VARCHAR)) || ':' || CAST(m AS VARCHAR), '-') || back) AS seen
    FROM f),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place FROM leaves),
tree AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    FROM tree WHERE len(nodes) > 1),
subroots AS (
    SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_at
    FROM tree WHERE len(nodes) = 1),
top AS (
    SELECT 0 AS level, list(subroot ORDER BY lang_at) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    FROM top WHERE len(nodes) > 1),
steps AS (
    SELECT p.r, t.level, t.nodes[xor(p.place >> t.level, 1) + 1] AS other, (p.place >> t.level) & 1 AS is_right
    FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang WHERE len(t.nodes) > 1
    UNION ALL
    SELECT p.r, s.height + t.level, t.nodes[xor(s.lang_at >> t.level, 1) + 1], (s.lang_at >> t.level) & 1
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN top t ON len(t.nodes) > 1),
fold AS (
    SELECT r, 0 AS level, seen AS hash FROM placed
    UNION ALL
    SELECT f.r, f.level + 1, sha256(CASE WHEN s.other IS NULL THEN f.hash WHEN s.is_right = 1 THEN s.other || f.hash
        ELSE f.hash || s.other END)
    FROM fold f JOIN steps s ON s.r = f.r AND s.level = f.level),
told AS (SELECT r, arg_max(hash, level) AS folded_root FROM fold GROUP BY r),
proof AS (SELECT r, sha256(coalesce(string_agg(other, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY r),
root AS (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1)
SELECT p.doc_id, p.leaf, s.subroot, root.root, coalesce(proof.proof_sha256, sha256('')) AS proof_sha256, told.folded_root,
    told.folded_root = root.root AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN told ON told.r = p.r LEFT JOIN proof ON proof.r = p.r, root
"""
