"""Queries of the text operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierline.llm import (bpe, exact_dedup, language, licenses, packing, pii, prefix_trie, secret_scan, simhash, substrings,
                          topk, toxicity, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op9_exact_dedup", r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents")).drop("digest")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                     public_tokenizers.PATTERN, digests=True)
    return ids.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op2_topk", """
WITH vectors AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 10""")
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


_VALUES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))


@query("op10_license_scan", r"""
WITH templates(place, license, notice) AS (VALUES """ + _VALUES + r"""),
files AS (
  SELECT doc_id, coalesce(text, '') AS body, source || '/' || lang || '/' || doc_id || '.txt' AS path,
         source || '/' || lang AS dir FROM documents),
mentioning AS (
  SELECT *, [trim(l) FOR l IN regexp_split_to_array(body, '\r?\n|\r')] AS ls FROM files
  WHERE regexp_matches(body, '""" + licenses.MENTIONS + r"""')),
numbered AS (
  SELECT doc_id, path, dir, unnest(range(len(ls))) AS line, unnest(ls) AS notice, unnest(list_append(ls[2:], '')) AS after
  FROM mentioning),
headers AS (SELECT * FROM numbered WHERE regexp_matches(notice, '""" + licenses.MENTIONS + r"""')),
found AS (
  SELECT doc_id, path, dir, -1 AS line, trim(body) AS notice FROM mentioning
  UNION ALL SELECT doc_id, path, dir, line, CASE WHEN regexp_matches(notice, '""" + licenses.SPDX + r"""')
    THEN regexp_extract(notice, '""" + licenses.SPDX + r"""', 1) ELSE notice END FROM headers
  UNION ALL SELECT doc_id, path, dir, line, notice || ' ' || after FROM headers WHERE after <> ''),
words AS (
  SELECT notice, token, count(*) AS tf FROM (
    SELECT notice, unnest(regexp_split_to_array(lower(notice), '[^a-z0-9]+')) AS token FROM (SELECT DISTINCT notice FROM found))
  WHERE token <> '' GROUP BY notice, token),
known_words AS (
  SELECT place, license, token, count(*) AS tf FROM (
    SELECT place, license, unnest(regexp_split_to_array(lower(notice), '[^a-z0-9]+')) AS token FROM templates)
  WHERE token <> '' GROUP BY place, license, token),
rarity AS (
  SELECT token, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM known_words GROUP BY token),
ours AS (SELECT notice, token, tf, (1 + ln(tf)) * idf AS w FROM words JOIN rarity USING (token)),
known AS (SELECT place, license, token, (1 + ln(tf)) * idf AS w FROM known_words JOIN rarity USING (token)),
sizes AS (SELECT notice, sum(tf) AS size FROM words GROUP BY notice),
our_norms AS (SELECT notice, sqrt(sum(w * w)) AS norm FROM ours GROUP BY notice),
known_norms AS (SELECT place, sqrt(sum(w * w)) AS norm FROM known GROUP BY place),
scores AS (
  SELECT notice, place, license, round(sum((o.w / a.norm) * (k.w / b.norm)), 6) AS similarity, sum(tf) AS held
  FROM ours o JOIN our_norms a USING (notice) JOIN known k USING (token) JOIN known_norms b USING (place)
  GROUP BY notice, place, license),
best AS (
  SELECT notice, license, similarity, held / size AS share FROM scores JOIN sizes USING (notice)
  WHERE held >= CASE WHEN place < 18 THEN 0.5 ELSE 1 END * size
  QUALIFY row_number() OVER (PARTITION BY notice ORDER BY similarity DESC, place) = 1),
matched AS (SELECT doc_id, path, dir, line, license, similarity FROM found JOIN best USING (notice)
  WHERE similarity >= 0.72 AND (line >= 0 OR share >= 0.93)),
own AS (
  SELECT doc_id, path, dir, license, similarity, min(line) OVER (PARTITION BY doc_id) = -1 AS is_license FROM matched
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, line) = 1),
given AS (
  SELECT dir, path AS origin, license AS given FROM own WHERE is_license
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY similarity DESC, path) = 1)
SELECT f.doc_id, f.path, coalesce(own.license, given) AS license,
       CASE WHEN own.license IS NOT NULL THEN CASE WHEN own.is_license THEN 'file' ELSE 'header' END
            WHEN given IS NOT NULL THEN 'inherited' ELSE 'none' END AS found,
       similarity, CASE WHEN own.license IS NULL THEN origin END AS origin
FROM files f LEFT JOIN own USING (doc_id) LEFT JOIN given ON f.dir = given.dir""")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie at source/lang/id.txt."""
    path = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", path)


@query("op8_repeated_substrings")
def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substrings.remove_repeats(table(spark, sf_dir, "documents"), digests=True)
            .withColumnRenamed("kept", "kept_sha256"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs)).withColumn("spans", F.size("spans"))


@query("op13_prefix_trie", """
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i
  FROM given),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
           list_prepend(4294967295, [ascii(c) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda bits, step: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)),
         4294967295) % 6 AS h FROM (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id FROM given)),
turns AS (
  SELECT ids.conv_id, 0 AS part, i, role, text FROM ids JOIN own ON own.conv_id = ids.base AND i <= h
  UNION ALL SELECT ids.conv_id, 1, i, role, text FROM ids JOIN own USING (conv_id) WHERE i > h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, list({'r': role, 't': text}) OVER w AS prefix, text
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, [], '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS turns FROM paths GROUP BY conv_id),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(length(text)) AS chars,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = turns), '') AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY prefix, depth),
children AS (
  SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
below AS (
  SELECT top.prefix, top.depth, sum((n.n_convs - 1) * CASE WHEN n.depth > 0 THEN n.chars ELSE 0 END) AS saved,
         count(*) FILTER (children.n IS NULL) AS leaves
  FROM nodes n JOIN paths top ON top.conv_id = n.conv_id AND top.depth <= n.depth
  LEFT JOIN children ON children.prefix = n.prefix AND children.depth = n.depth GROUP BY top.prefix, top.depth)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(children.n, 0) AS n_children,
       below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below ON below.prefix = n.prefix AND below.depth = n.depth
LEFT JOIN nodes up ON n.depth > 0 AND up.depth = n.depth - 1 AND up.prefix = n.prefix[1:n.depth - 1]
LEFT JOIN children ON children.prefix = n.prefix AND children.depth = n.depth""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(own))
