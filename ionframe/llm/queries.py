"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionframe.plans.tables import table

from . import ann, dialogue, embedding_dedup, exact_dedup, mixing, packing, part_codes, pii, quality, sentencepiece, sharding, simhash, toxicity


#: Key of the pseudonyms in the registered queries; a user keeps their own secret.
PII_KEY = "registered-queries"
#: A public vocabulary on the driver's machine; the compiled model is broadcast.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).drop("text")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 23 of near-equal bytes, equal texts together."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's whole text, and whether decoding them gives the text again."""
    model = sentencepiece.load(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sentencepiece.round_trip(docs, model)
    return back.select("doc_id", "ids", F.size("ids").alias("n_ids"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' byte-level BPE ids packed into rows of 2,048."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.BytePairs(BYTE_PAIRS))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text with personal data replaced by pseudonyms, and how many values were."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count="n_replaced")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 3-word shingles, and components over links of at most 3 bits."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).drop("text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix's words taken from each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of equal labels linked at cosine 0.98 or more, and their components."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and hash of the repaired turns of every damaged conversation."""
    return dialogue.repair_report(dialogue.damage(table(spark, sf_dir, "conversations")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all usable vectors by 16 codebooks of 64 entries, and their errors."""
    return part_codes.coded_with_errors(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts of all documents, and the row of each that stays."""
    return exact_dedup.text_classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_sharding, op3_sentencepiece, op4_packing, op5_pii, op6_simhash, op7_toxicity, op8_mixing, op9_ann, op10_embedding_dedup,
                           op11_conversations, op12_vector_codes, op13_exact_dedup)
}

ORACLE: dict[str, str] = {
    "op8_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
c AS (SELECT *, 3.0::DOUBLE * source_size AS most FROM w),
f AS (SELECT *, (sum(source_size) OVER ()
                 - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY most / weight, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, least(max(level) OVER () * weight, most) AS target,
             ('0x' || substr(md5('0:' || coalesce('s' || source, 'n')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u FROM f),
r AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY floor(sqrt(size) * 4),
        draw % (64 + (SELECT count(*) FROM documents) // 1000000), size, doc_id) AS r FROM d),
x AS (SELECT r.doc_id, r.size, t.source_size, t.target, r.r, t.u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rho
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (least(3, floor(r * rho + u) - floor((r - 1) * rho + u))::BIGINT * size)::BIGINT AS taken FROM x
""",
    "op13_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)
""",
    "op11_conversations": r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS s FROM conversations),
k AS (SELECT *, xor(list_reduce(list_transform(s, lambda z: ascii(z)::BIGINT), lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295), 4294967295) % 20 AS k FROM c),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE k WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM k),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS rn,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time,
             regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last, left(role, 1) AS i FROM d),
f AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN time > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(i) OVER (PARTITION BY conv_id ORDER BY rn) || i AS pair FROM o),
g AS (SELECT conv_id, max(rn) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
w AS (
  SELECT conv_id, n + 1 AS rn, {'c': 0::BIGINT, 'a': '', 'r': ''} AS s0, {'c': 4::BIGINT, 'a': 'II', 'r': E'user:\nassistant:\n'} AS s1,
         {'c': 2::BIGINT, 'a': 'I', 'r': E'assistant:\n'} AS s2, {'c': 0::BIGINT, 'a': '', 'r': ''} AS s3 FROM g
  UNION ALL
  SELECT conv_id, rn, least(b0, {'c': v2.c + 2, 'a': 'I' || v2.a, 'r': E'user:\n' || v2.r}), least(b1, {'c': v2.c + 2, 'a': 'I' || v2.a, 'r': E'user:\n' || v2.r}), v2, v3
  FROM (SELECT *, least(b2, {'c': b3.c + 2, 'a': 'I' || b3.a, 'r': E'assistant:\n' || b3.r}) AS v2,
               least(b3, {'c': b2.c + 2, 'a': 'I' || b2.a, 'r': E'user:\n' || b2.r}) AS v3
        FROM (SELECT conv_id, rn,
                least({'c': s0.c + 3, 'a': 'D' || s0.a, 'r': s0.r}, CASE WHEN ok THEN {'c': s2.c + t + 2, 'a': 'R' || s2.a, 'r': 'user' || line || s2.r} END,
                      CASE WHEN ok AND i = 's' THEN {'c': s1.c + t, 'a': 'K' || s1.a, 'r': role || line || s1.r}
                           WHEN ok AND i = 'u' THEN {'c': s2.c + t, 'a': 'K' || s2.a, 'r': role || line || s2.r} END) AS b0,
                least({'c': s1.c + 3, 'a': 'D' || s1.a, 'r': s1.r}, CASE WHEN ok THEN {'c': s2.c + t + 2, 'a': 'R' || s2.a, 'r': 'user' || line || s2.r} END,
                      CASE WHEN ok AND i = 'u' THEN {'c': s2.c + t, 'a': 'K' || s2.a, 'r': role || line || s2.r} END) AS b1,
                least({'c': s2.c + 3, 'a': 'D' || s2.a, 'r': s2.r}, CASE WHEN ok THEN {'c': s3.c + t + 2, 'a': 'R' || s3.a, 'r': 'assistant' || line || s3.r} END,
                      CASE WHEN ok AND i = 'a' THEN {'c': s3.c + t, 'a': 'K' || s3.a, 'r': role || line || s3.r} END) AS b2,
                least({'c': s3.c + 3, 'a': 'D' || s3.a, 'r': s3.r}, CASE WHEN ok THEN {'c': s2.c + t + 2, 'a': 'R' || s2.a, 'r': 'user' || line || s2.r} END,
                      CASE WHEN ok AND i = 'u' THEN {'c': s2.c + t, 'a': 'K' || s2.a, 'r': role || line || s2.r} END) AS b3
              FROM (SELECT w.*  EXCLUDE (rn), f.rn, f.i, f.role, f.fault NOT IN ('blank', 'duplicate') AS ok, (f.fault = 'truncated')::BIGINT AS t,
                           ':' || f.text || E'\n' AS line FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.rn = w.rn - 1))))
SELECT c.conv_id, coalesce(g.gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(w.s0.c, 0) AS cost, coalesce(w.s0.a, '') AS audit, sha256(coalesce(left(w.s0.r, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM c) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.rn = 1
""",
    "op12_vector_codes": r"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256.0::DOUBLE * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT k.vec_id, p.p, list_slice(k.x, len(k.x) * p.p // 16 + 1, len(k.x) * (p.p + 1) // 16) AS x
      FROM k, (SELECT unnest(range(16)) AS p) p),
e0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM x
       WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
d0 AS (SELECT x.p, x.vec_id, any_value(x.x) AS x,
              min({'d': list_sum(list_transform(list_zip(x.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e.e}) AS b
       FROM x JOIN e0 e ON x.p = e.p GROUP BY x.p, x.vec_id),
m0 AS (SELECT p, e, list(v ORDER BY i) AS x FROM (SELECT p, e, i, floor(sum(c)::HUGEINT / count(*))::BIGINT AS v FROM
         (SELECT p, b.e AS e, unnest(range(len(x))) AS i, unnest(x) AS c FROM d0) GROUP BY p, e, i) GROUP BY p, e),
e1 AS (SELECT e0.p, e0.e, coalesce(m0.x, e0.x) AS x FROM e0 LEFT JOIN m0 USING (p, e)),
d1 AS (SELECT x.p, x.vec_id, any_value(x.x) AS x,
              min({'d': list_sum(list_transform(list_zip(x.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e.e}) AS b
       FROM x JOIN e1 e ON x.p = e.p GROUP BY x.p, x.vec_id),
m1 AS (SELECT p, e, list(v ORDER BY i) AS x FROM (SELECT p, e, i, floor(sum(c)::HUGEINT / count(*))::BIGINT AS v FROM
         (SELECT p, b.e AS e, unnest(range(len(x))) AS i, unnest(x) AS c FROM d1) GROUP BY p, e, i) GROUP BY p, e),
e2 AS (SELECT e1.p, e1.e, coalesce(m1.x, e1.x) AS x FROM e1 LEFT JOIN m1 USING (p, e)),
d2 AS (SELECT x.p, x.vec_id, min({'d': list_sum(list_transform(list_zip(x.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e.e}) AS b
       FROM x JOIN e2 e ON x.p = e.p GROUP BY x.p, x.vec_id),
c AS (SELECT d2.vec_id, k.label, string_agg(printf('%02x', b.e), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error
      FROM d2 JOIN k USING (vec_id) GROUP BY d2.vec_id, k.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM e2) AS codebooks_sha256 FROM c
""",
}
