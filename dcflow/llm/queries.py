"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, idfiles, linededup, negatives, pii, quality, simhash, spcodec, template, tokcount, trie, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the learned verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn_rules(docs, table(spark, sf_dir, "labels")))


@_query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses as later copies of repeated line runs."""
    out, p = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col(p + "n_lines").alias("n_lines"), F.col(p + "n_deleted").alias("n_deleted"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# Every shortest window of 50 words, spelt out as text: what the ranks stand for.
ORACLE_SQL["op5_line_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs),
worded AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
framed AS (
  SELECT doc_id, i, pos,
         list({'l': line, 'w': words}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS fore,
         list({'l': line, 'w': words}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS aft
  FROM worded),
sized AS (
  SELECT doc_id, i, fore, aft,
         list_min([m FOR m IN range(1, len(fore) + 1) IF list_sum([x.w FOR x IN fore[1:m]]) >= 50]) AS mf,
         list_min([m FOR m IN range(1, len(aft) + 1) IF list_sum([x.w FOR x IN aft[len(aft) - m + 1:]]) >= 50]) AS ma
  FROM framed),
windows AS (
  SELECT doc_id, i AS s, mf AS m, [x.l FOR x IN fore[1:mf]] AS body FROM sized WHERE mf IS NOT NULL
  UNION
  SELECT doc_id, i - ma + 1, ma, [x.l FOR x IN aft[len(aft) - ma + 1:]] FROM sized WHERE ma IS NOT NULL),
placed AS (
  SELECT doc_id, s, m, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS copy FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS i FROM placed WHERE copy > 1),
kept AS (
  SELECT l.doc_id, count(w.i) AS n_lines, count(g.i) AS n_deleted,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.i IS NULL), '') AS text
  FROM lines l LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.pos = w.pos
  LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i
  GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_deleted, sha256(text) AS kept_sha256 FROM kept
"""


@_query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a copy of a test item, edited or not, and the score."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "score")


@_query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, decoded text and piece spans of every document, as digests."""
    return spcodec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokcount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@_query
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the deduplicated archive of all pages holds."""
    return warc.deduplicate(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


ORACLE_SQL["op1_warc_revisits"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
FROM m
"""


@_query
def op9_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation that is no prefix of another, rendered."""
    return chat.collapse(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op9_chat_collapse"] = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (
  SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
whole AS (
  SELECT turns, n, min(conv_id) AS conv_id FROM c GROUP BY turns, n),
inside AS (
  SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n)) AS k FROM c))
SELECT w.conv_id, w.n AS n_turns,
       array_to_string([concat('<|im_start|>', x.r, chr(10), x.t, '<|im_end|>', chr(10)) FOR x IN w.turns], '') AS text
FROM whole w ANTI JOIN inside i ON w.turns = i.turns
"""


@_query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return template.main_text(table(spark, sf_dir, "pages"))


@_query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.search(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    spelt = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(spelt(base), 256).alias("base_sha256"), spelt(F.col("spans")).alias("spans"))


@_query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the id files hold each document, and the checksum of its ids."""
    return idfiles.encode_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of conversations that share openings."""
    return trie.prefix_trie(*trie.branched(table(spark, sf_dir, "conversations"), group=100, most=6))


# crc32 is spelt out: one step a character, eight shifts each
ORACLE_SQL["op12_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, r, t) AS turns FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
         xor(list_reduce([4294967295] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
             lambda s, b: list_reduce([xor(s, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
                 lambda v, z: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 6 AS h
  FROM c),
r AS (
  SELECT h.conv_id, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:] AS turns FROM h LEFT JOIN c b ON b.conv_id = h.base),
p AS (
  SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM p GROUP BY path, d),
k AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
each AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[n.d].t) END AS saved
  FROM n LEFT JOIN k ON n.path = k.path AND n.d = k.d),
under AS (
  SELECT path[1:top] AS path, top AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS top FROM each) GROUP BY 1, 2)
SELECT e.conv_id, CAST(e.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, e.n_convs, CAST(e.n_children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(e.ends) AS ends_sha256
FROM each e JOIN under u ON e.path = u.path AND e.d = u.d LEFT JOIN n up ON e.d > 0 AND up.path = e.path[1:e.d - 1] AND up.d = e.d - 1
"""


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every 50th vector's positives."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


ORACLE_SQL["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(coalesce(list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)]), 0) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""
