"""The operators over their whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import load, remainder
from rowtide.llm.langid import fit_languages, identify_languages
from rowtide.llm.licenses import scan_licenses
from rowtide.llm.linkgraph import LINK, filter_urls, rule_table
from rowtide.llm.mixing import mixing_plan, with_copies, word_count
from rowtide.llm.negatives import mine_negatives
from rowtide.llm.packing import pack
from rowtide.llm.prefixtrie import prefix_trie
from rowtide.llm.quality import score_quality
from rowtide.llm.rangejoin import near_duplicate_vectors
from rowtide.llm.simhash import simhash_duplicates
from rowtide.llm.suffixtree import score_texts
from rowtide.llm.topk import top_k, whole_components
from rowtide.llm.warc import archive_and_read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    teaching = labels.filter(remainder(F.col("doc_id"), 5) != 0)
    scored = score_quality(docs.select("doc_id", "text"), teaching, threshold=0.3)
    return scored.select("doc_id", held_out(5), "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    plan = mixing_plan(docs, size=F.col("size"), max_epochs=3.0, seed=0)
    return with_copies(docs, plan, seed=0).select(
        "d.doc_id", "d.size", "p.source_size", "p.target", (F.col("copies") * F.col("d.size")).alias("taken")
    )


# The level is found among all ways to clamp the sources of smallest limit per weight; the
# running sum over a source replaces the buckets.
OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR))) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sum(3 * source_size) OVER before AS clamped, sum(weight) OVER behind AS open_weight,
         (SELECT sum(source_size) FROM sources) AS budget
  FROM sources
  WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         behind AS (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT (budget - coalesce(clamped, 0)) / open_weight AS level
  FROM ranked
  WHERE 3 * source_size > weight * (budget - coalesce(clamped, 0)) / open_weight
  ORDER BY source_size / weight, source LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * (SELECT level FROM level)) AS target FROM sources),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
sums AS (
  SELECT s.*, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size AS quota,
         sum(size) OVER (PARTITION BY s.source ORDER BY key) - sum(size) OVER (PARTITION BY s.source, key) / 2.0 AS middle
  FROM sized s JOIN wholes w ON s.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN middle <= quota THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sums
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(load(spark, sf_dir, "documents"), shingle=3, max_distance=2)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select(
        "vec_id", whole_components(F.col("embedding"), 256).alias("vector")
    )
    found = top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(50)) == 0), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out(5),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_accepted").alias("accepted"),
    )


def op6_rangejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(load(spark, sf_dir, "embeddings"), least=0.95)


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.w, b.w) >= 0.95),
reach(node, least) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.node WHERE l.b > r.least),
component AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links,
       coalesce(c.component_id, e.vec_id) AS component_id,
       coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN component c ON c.node = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(load(spark, sf_dir, "pages"), least_bytes=0)


# A SHA-1 in hexadecimal is turned into base 32 five digits at a time, which are four signs.
OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)),
           'string_agg', '') AS payload_digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), tokenizer_file(), end=2, window=4096)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, remainder(F.col("doc_id"), 10) != 0)
    return scored.select("*", held_out(10))


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(load(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", *(f"licenses.{n}" for n in names))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = load(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), whole_components(F.col("embedding"), 256).alias("vector")
    )
    return mine_negatives(vectors, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS anchor_id, q.label = c.label AS same, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s
  ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

def op12_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6)).cast("int")
    return prefix_trie(load(spark, sf_dir, "conversations"), base=base, heads=heads, most_heads=5)


# CRC-32 takes a byte and eight shifts at a time.
OP12_SQL = """
WITH o AS (
  SELECT conv_id, list({'id': id, 'size': size} ORDER BY turn NULLS FIRST, id) AS turns
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
         xor(list_reduce(
           list_prepend(4294967295::UBIGINT, flatten(list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
             lambda i: [ord(substr(CAST(conv_id AS VARCHAR), i, 1))::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, x: xor(xor(a, x) >> 1, 3988292384::UBIGINT * (xor(a, x) & 1))), 4294967295::UBIGINT) % 6 AS heads
  FROM o),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.heads], []), h.turns[h.heads + 1:]) AS turns
  FROM h LEFT JOIN o b ON b.conv_id = h.base),
p AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r),
prefixes AS MATERIALIZED (
  SELECT conv_id, depth, len(turns) = depth AS ended, coalesce(turns[depth].size, 0) AS size,
         coalesce(list_aggregate(list_transform(turns[1:depth], lambda t: t.id), 'string_agg', ','), '') AS key,
         coalesce(list_aggregate(list_transform(turns[1:depth - 1], lambda t: t.id), 'string_agg', ','), '') AS parent
  FROM p),
nodes AS MATERIALIZED (
  SELECT key, depth, first(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * first(size) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
subtrees AS (
  SELECT a.key, sum(n.saved) AS saved_tokens, count(*) FILTER (c.n IS NULL) AS n_leaves
  FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  LEFT JOIN children c ON c.parent = n.key
  GROUP BY a.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, CASE WHEN n.depth > 0 THEN u.conv_id END AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.key = n.key JOIN nodes u ON u.key = n.parent
LEFT JOIN children c ON c.parent = n.key
"""

URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op13_linkgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(load(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


# Walks go 30 steps, as the operator's do at most; what is left of them by then is below its digits.
OP13_SQL = """
WITH RECURSIVE rules(verdict, host, path) AS (VALUES %s),
cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT row_number() OVER () AS n, page_id, html,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
links AS MATERIALIZED (
  SELECT DISTINCT host AS source, target
  FROM (SELECT host, translate(unnest(regexp_extract_all(html, '%s', 1)),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM p)
  WHERE host <> '' AND target <> '' AND host <> target),
rows AS (
  SELECT n, host, path FROM p
  UNION ALL
  SELECT DISTINCT NULL, target, '/' FROM links WHERE target NOT IN (SELECT host FROM p)),
judged AS MATERIALIZED (
  SELECT r.n, r.host, r.path,
         first(u.host || u.path ORDER BY length(u.host || u.path) DESC, u.host || u.path, u.verdict DESC) AS rule,
         first(u.verdict ORDER BY length(u.host || u.path) DESC, u.host || u.path, u.verdict DESC) AS rule_verdict
  FROM rows r LEFT JOIN rules u
    ON ends_with('.' || r.host, '.' || u.host) AND starts_with(r.path, u.path)
  GROUP BY ALL),
seeds AS (
  SELECT host, avg(CASE WHEN rule_verdict = 'allow' THEN 1.0 ELSE 0 END) AS trust,
         avg(CASE WHEN rule_verdict = 'block' THEN 1.0 ELSE 0 END) AS distrust
  FROM judged WHERE host <> '' GROUP BY host),
ways AS MATERIALIZED (
  SELECT 'trust' AS kind, source AS host, target AS next, 0.85::DOUBLE / count(*) OVER (PARTITION BY source) AS share
  FROM links
  UNION ALL
  SELECT 'distrust', target, source, 0.85::DOUBLE / count(*) OVER (PARTITION BY target) FROM links),
walks(step, kind, host, mass) AS (
  SELECT 0, 'trust', host, trust::DOUBLE FROM seeds WHERE trust > 0
  UNION ALL
  SELECT 0, 'distrust', host, distrust::DOUBLE FROM seeds WHERE distrust > 0
  UNION ALL
  SELECT step + 1, w.kind, y.next, sum(mass * share) FROM walks w JOIN ways y ON w.kind = y.kind AND w.host = y.host
  WHERE step < 30 GROUP BY step + 1, w.kind, y.next),
scores AS (
  SELECT host, round(sum(CASE WHEN kind = 'trust' THEN mass ELSE 0 END), 9) AS trust,
         round(sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END), 9) AS distrust
  FROM walks GROUP BY host)
SELECT p.page_id, p.host, p.path, j.rule,
       coalesce(j.rule_verdict, CASE WHEN s.distrust > s.trust THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(s.trust, 0), 6) AS trust, round(coalesce(s.distrust, 0), 6) AS distrust
FROM p JOIN judged j ON j.n = p.n LEFT JOIN scores s ON s.host = p.host
""" % (", ".join(map(str, URL_RULES)), LINK.replace("'", "''"))


def held_out(divisor: int):
    """Whether the id's remainder is 0; false for a null id, which teaches nothing either."""
    return F.coalesce(remainder(F.col("doc_id"), divisor) == 0, F.lit(False)).alias("held_out")


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality,
        op2_mixing,
        op3_simhash,
        op4_topk,
        op5_language,
        op6_rangejoin,
        op7_warc,
        op8_packing,
        op9_suffixtree,
        op10_license,
        op11_negatives,
        op12_prefixtrie,
        op13_linkgraph,
    )
}
ORACLES = {
    "op2_mixing": OP2_SQL,
    "op4_topk": OP4_SQL,
    "op6_rangejoin": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op11_negatives": OP11_SQL,
    "op12_prefixtrie": OP12_SQL,
    "op13_linkgraph": OP13_SQL,
}
