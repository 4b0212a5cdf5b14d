"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import decontamination
from .interpolation import score_documents
from .lempel_ziv import fingerprint_pairs
from .licenses import license_rows
from .mixing import mix_sources
from .near_dedup import near_duplicates
from .paragraphs import repeated_paragraphs
from .prefix_trie import prefix_trie
from .quality import classify
from .subvectors import cluster_vectors
from .token_counts import count_tokens
from .tokens import token_output
from .warc import warc_round_trip

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def op1_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rows(table(spark, sf_dir, "documents"))


def op2_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), TOKENIZER, END_ID)


def op3_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("tie")


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op7_paragraph_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


def op8_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))


def op10_warc_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_pre_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


def op13_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_license_rules, op2_token_frames, op3_co_training, op4_prob_minhash, op5_pfair_mix, op6_deleted_interpolation, op7_paragraph_bands, op8_bm25_wand, op9_lempel_ziv, op10_warc_splits,
                                 op11_prefix_trie, op12_pre_token_counts, op13_subvector_clusters)}

OP10_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS hex, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         (((strpos('0123456789abcdef', substr(hex, CAST(1 + i * 5 // 4 AS INT), 1)) - 1) * 16
           + CASE WHEN 2 + i * 5 // 4 <= 40 THEN strpos('0123456789abcdef', substr(hex, CAST(2 + i * 5 // 4 AS INT), 1)) - 1 ELSE 0 END)
          // CAST(pow(2, 3 - (i * 5) % 4) AS INT)) % 32 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM r"""

# crc32, bit by bit, of the decimal id; then prefixes as lists of (role, text)
OP11_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
             xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
               lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))),
               lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda x, unused: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.k <= c.h
      UNION ALL SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
s AS MATERIALIZED (SELECT c.conv_id, coalesce(q.said, []) AS said FROM c
      LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY k) AS said FROM r GROUP BY conv_id) q ON q.conv_id = c.conv_id),
n AS MATERIALIZED (SELECT said[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(said) = d), '')) AS ends_sha256
      FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM s) GROUP BY ALL),
k AS MATERIALIZED (SELECT n.*, coalesce(x.n_children, 0) AS n_children FROM n
      LEFT JOIN (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL) x ON x.p = n.p AND x.d = n.d),
u AS (SELECT p[1:a] AS p, a AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
             sum(CASE WHEN d > 0 THEN (n_convs - 1) * length(p[d].text) ELSE 0 END) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM k) GROUP BY ALL)
SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN u ON u.p = k.p AND u.d = k.d LEFT JOIN n o ON k.d > 0 AND o.d = k.d - 1 AND o.p = k.p[1:k.d - 1]"""


def _clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    assign = """a{r} AS MATERIALIZED (SELECT row, c AS cluster, dist FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY dist, c) AS place
    FROM (SELECT x.row, y.c, CAST(sum((x.x - y.x) * (x.x - y.x)) AS BIGINT) AS dist FROM x JOIN c{r} y ON y.i = x.i GROUP BY 1, 2)) WHERE place = 1)"""
    move = """c{s} AS MATERIALIZED (SELECT c{r}.c, c{r}.i, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT a.cluster AS c, x.i, CAST(floor(sum(x.x) / count(*)) AS BIGINT) AS x FROM a{r} a JOIN x ON x.row = a.row GROUP BY 1, 2) m ON m.c = c{r}.c AND m.i = c{r}.i)"""
    steps = [s for r in range(rounds) for s in (assign.format(r=r), move.format(r=r, s=r + 1))] + [assign.format(r=rounds)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim}),
x AS MATERIALIZED (SELECT row, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT row, embedding, unnest(range(1, {dim + 1})) AS i FROM v)),
s AS MATERIALIZED (SELECT row, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, embedding) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT s.c, x.i, x.x FROM s JOIN x ON x.row = s.row WHERE s.c < {k}),
{", ".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT v.vec_id, CAST(a.cluster AS INT) AS cluster, a.dist AS distance, CAST(sum(a.dist) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN v ON v.row = a.row JOIN h ON h.c = a.cluster"""


ORACLE = {"op10_warc_splits": OP10_SQL, "op11_prefix_trie": OP11_SQL, "op13_subvector_clusters": _clusters_sql()}
