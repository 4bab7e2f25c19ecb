"""The ``opN_...`` queries over the given tables, with production settings."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import (bpe, hardneg, licenses, linededup, mixing, quality, sharding, simhash, syncmers, topk, toxicity,
                         transducer, whitening)
from ebbflow.llm.common import ORACLES, QUERIES, query, table

__all__ = ["QUERIES", "ORACLES", "vocabulary"]

TOKENIZER = "byte_bpe_50k.json"
#: Scores from here on keep a document.
QUALITY_THRESHOLD = 0.3
TOXIC_THRESHOLD = 0.5
#: Bytes that a shard holds at most.
SHARD_BYTES = 1 << 20


@functools.lru_cache(1)
def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary(public_tokenizers.path(TOKENIZER))


@query("op1_topk_search", oracle="""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS ints FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.ints) = len(q.ints) WHERE q.vec_id % 100 = 0)
SELECT * FROM (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
    FROM pairs)
WHERE rank <= 10
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=2)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op3_bpe_encode_decode")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary(), outputs=("ids_sha256", "decoded_sha256"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_tokens(table(spark, sf_dir, "documents"), vocabulary(), limit=512)


@query("op5_document_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


@query("op6_line_dedup", oracle="""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS no
    FROM documents),
worded AS (
    SELECT row_number() OVER (ORDER BY doc_id, no) AS place, doc_id, no,
           list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
classes AS (
    SELECT min(place) AS first, any_value(words) AS words, len(any_value(words)) AS n FROM worded GROUP BY list_sort(words)),
postings AS (SELECT first, n, unnest(words) AS word FROM classes),
-- similar classes share at least 4/9 of both sizes together
common AS (
    SELECT x.first AS x, any_value(x.n) AS xn, any_value(y.n) AS yn, count(*) AS common
    FROM postings x JOIN postings y ON x.word = y.word AND y.first < x.first AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
    GROUP BY x.first, y.first),
gone AS (SELECT DISTINCT x FROM common WHERE 9 * common >= 4 * (xn + yn)),
firsts AS (SELECT first FROM classes WHERE first NOT IN (SELECT x FROM gone)),
removed AS (SELECT doc_id, no FROM worded WHERE place NOT IN (SELECT first FROM firsts))
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, count(r.no) AS n_removed,
       coalesce(string_agg(r.no, ',' ORDER BY r.no), '') AS removed
FROM documents d LEFT JOIN removed r ON r.doc_id = d.doc_id GROUP BY ALL
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.report(table(spark, sf_dir, "documents"), num=4, den=5)
    return found.withColumn("removed", F.concat_ws(",", F.transform("removed", lambda i: i.cast("string"))))


@query("op7_sharding", oracle=f"""
WITH docs AS (
    SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
           lpad(bin(CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:16] AS UBIGINT)), 64, '0') AS path
    FROM documents),
sums AS (
    SELECT CAST(d.depth AS INT) AS depth, left(path, d.depth) AS shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
    FROM docs, (SELECT CAST(unnest(range(0, 40)) AS INT) AS depth) d GROUP BY ALL)
SELECT doc_id, n_bytes, shard, depth, shard_bytes, shard_bytes > {SHARD_BYTES} AS oversize FROM docs
JOIN sums ON shard = left(path, depth) AND shard_bytes <= {SHARD_BYTES}
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), limit=SHARD_BYTES)


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@query("op10_mixing", oracle="""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
    FROM documents),
ranked AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           list_extract([5.0::DOUBLE, 2.0, 1.0], CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS INT)) AS weight
    FROM docs GROUP BY source),
-- sources in the order in which a rising level caps them; k of them are capped
filled AS (
    SELECT source, source_size, weight, 3.0::DOUBLE * source_size AS cap,
           sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
           row_number() OVER w AS k, sum(3.0::DOUBLE * source_size) OVER w AS caps, sum(weight) OVER w AS capped
    FROM ranked WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, source)),
level AS (
    SELECT min_by(level, k) AS level FROM (
        SELECT k, (total - (caps - cap)) / (weights - (capped - weight)) AS level, weight, cap FROM filled)
    WHERE level * weight <= cap),
goal AS (
    SELECT source, source_size, least(cap, level * weight) AS target,
           CAST(round(least(cap, level * weight)) AS BIGINT) AS budget FROM filled, level),
placed AS (
    SELECT doc_id, size, source_size, target, budget,
           sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before
    FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE size * (budget // source_size)
            + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)


@query("op11_hard_negatives", oracle="""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS ints
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.ints) = len(a.ints) WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label, scale=256,
                        positives=5, negatives=10, low=(3, 10), high=(9, 10))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=8, scale=1024, offset=100_000)


@query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_THRESHOLD).cast("int").alias("predicted"))
