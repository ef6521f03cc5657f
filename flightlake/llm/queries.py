"""Queries of this package over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import (bagminhash, bsi, chat, decontam, divergence, jaccardjoin, mixing, quality, sharding, toxicity,
                            trie, urlfilter, warc)
from flightlake.llm.common import table

CHAT_PROBE = r"\### Assistant: </turn> ok"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark 10-gram."""
    found = decontam.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of near-equal bytes; equal texts are adjacent."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.text_bytes().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.md5("text").alias("__text"))
    out = sharding.shard_documents(docs, 40, size=F.col("size"), group=F.col("__text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; labels of ids with crc32 mod 3 = 1 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighed 1, 2, 3 in turn, at most 3 repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL by rule, else by its aliases."""
    pages = table(spark, sf_dir, "pages")
    judged = urlfilter.filter_urls(pages.select("page_id", "url"), urlfilter.page_links(pages, resolve=True))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; labels of ids with crc32 mod 4 = 2 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, read back from their bytes."""
    responses = warc.page_responses(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    records = warc.read_records(warc.build_derivatives(responses))
    return records.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type",
                          "block_digest", "payload_digest", F.length("body").cast("long").alias("content_length"),
                          F.sha2("body", 256).alias("body_sha256"), "error")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the prefix-target examples of all conversations."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CHAT_PROBE).alias("text"))
    return chat.digest_examples(chat.expand_prefix_targets(turns.union(probe)))


def op10_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 10 by integer inner product for every hundredth vector."""
    return bsi.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations with their subtree totals."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices between the sources of a language, and each source's telling terms."""
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 0.8 Jaccard on 5-word shingles."""
    return jaccardjoin.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_quality": op6_quality,
    "op7_bagminhash": op7_bagminhash,
    "op8_warc_derivatives": op8_warc_derivatives,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_bit_sliced_topk": op10_bit_sliced_topk,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLE: dict[str, str] = {}

ORACLE["op1_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
pos AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM d, (SELECT DISTINCT k FROM win) ks WHERE len(w) >= k)),
occ AS (SELECT p.doc_id, p.k, p.i, n.item_id FROM pos p JOIN win n ON p.k = n.k AND p.g = n.g),
hits AS (SELECT doc_id, count(DISTINCT x) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM (SELECT DISTINCT doc_id, i, k FROM occ)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""

ORACLE["op4_mixing"] = r"""
WITH r AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5('mix' || coalesce(doc_id::VARCHAR, '') || coalesce(md5(text), '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT *, 3.0 * source_size AS cap,
             ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM s),
l AS (SELECT *, cap::DOUBLE / weight AS level FROM w),
f AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER e, 0))::DOUBLE
                / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS share
      FROM l WINDOW e AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT arg_min(share, (level, source)) AS common FROM f WHERE share <= level),
t AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, common * weight), cap::DOUBLE) AS target FROM f, c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS epochs FROM t),
o AS (SELECT r.*, e.source_size, e.target, e.epochs,
             CASE WHEN epochs < 3 THEN target - epochs * e.source_size ELSE 0 END AS rest,
             sum(size) OVER (PARTITION BY r.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto
      FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""

ORACLE["op5_url_filter"] = r"""
WITH u AS (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END
           AS rest FROM pages),
p AS (SELECT page_id, url, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rule, rhost, rpath) AS (VALUES ('block', 'net/', 'net', '/'),
  ('allow', 'example.net/en/', 'example.net', '/en/'), ('block', 'example.com/de/', 'example.com', '/de/'),
  ('allow', 'org/fr/', 'org', '/fr/')),
m AS (SELECT page_id, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict FROM p JOIN rules
      ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, host, path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""
# The pages of these tables name no canonical links and no redirects and a
# URL's variants share its host and path, so that SQL needs no components; the
# operator is tested against a brute-force version with links.

ORACLE["op9_chat_formatting"] = r"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, length(replace(replace(replace(text, '\', '\s'), '<turn>', '\o'), '</turn>', '\c'))
             + length(role) + length('<turn>' || chr(10) || '</turn>' || chr(10)) AS n FROM t),
g AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS upto,
             lead(1) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AS ends FROM f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (role = 'assistant' OR ends), 0)::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""

ORACLE["op10_bit_sliced_topk"] = r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q))
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

ORACLE["op11_prefix_trie"] = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  coalesce(text, '')) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n,
             xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                 lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
                 4294967295) % 9 AS h FROM t GROUP BY conv_id),
l AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT l.conv_id, p AS depth, role, text FROM l JOIN t ON t.conv_id = l.base AND p <= taken
      UNION ALL SELECT l.conv_id, taken + p - h, role, text FROM l JOIN t ON t.conv_id = l.conv_id AND p > h),
m AS (SELECT conv_id, depth, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
             strlen(text) AS bytes FROM r UNION ALL SELECT conv_id, 0, '', 0 FROM l),
e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM m),
n AS (SELECT min(conv_id) AS conv_id, depth, path, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM e GROUP BY depth, path),
k AS (SELECT depth - 1 AS depth, left(path, length(path) - 64) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, path)),
s AS (SELECT a.depth, a.path, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens
      FROM f a JOIN f b ON b.depth >= a.depth AND starts_with(b.path, a.path) GROUP BY 1, 2)
SELECT f.conv_id, f.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (depth, path)
LEFT JOIN f u ON f.depth > 0 AND u.depth = f.depth - 1 AND u.path = left(f.path, length(f.path) - 64)
"""

ORACLE["op12_divergence_audit"] = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY 1, 2),
g AS (SELECT a.lang, a.source, coalesce(s.n, 0) + coalesce(v.v, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) a
      LEFT JOIN s USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, k.term, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // g.total AS p, coalesce(c.n, 0) AS n
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
q AS (SELECT k.lang, k.term, 1 + 1000000000 * (k.n + 1) // (v.n + v.v) AS q FROM k JOIN v USING (lang)),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""

ORACLE["op13_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT a AS r, b AS t FROM e UNION SELECT reach.r, e.b FROM reach JOIN e ON e.a = reach.t),
m AS (SELECT reach.r, min(d.doc_id) AS least FROM reach JOIN d ON d.r = reach.t GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, least) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
