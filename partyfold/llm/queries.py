"""One query per operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyfold.llm import (
    backoff,
    centroids,
    id_files,
    licenses,
    mixing,
    ngram_join,
    sentencepieces,
    tiling,
    topk,
    toxicity,
    vector_codes,
    warc,
    wordpiece,
)
from partyfold.llm.shipping import ship
from partyfold.llm.vector_sql import clustering_sql, compression_sql

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of three words, similarity of 0.9 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_summary(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50 against all others."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", topk.quantised(F.col("embedding")).alias("vector")
    )
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return topk.top_k(queries, vectors, k=5)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxic_spans(docs, model).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, the archives read back."""
    return warc.archived_pages(warc.archive(table(spark, sf_dir, "pages")))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids, and compares with what went in."""
    as_decoded = F.replace("text", F.lit("\u2581"), F.lit(" "))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.xxhash64(as_decoded).alias("given"))
    ids = sentencepieces.encoded(docs, PIECES, checksum="ids_crc32")
    counted = ids.withColumn("n_tokens", F.size("ids").cast("bigint"))
    return sentencepieces.decoded(counted, PIECES).select(
        "doc_id",
        "n_tokens",
        "ids_crc32",
        F.length("text").cast("bigint").alias("n_chars"),
        (F.xxhash64("text") == F.col("given")).alias("round_trip"),
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of words, counted over all documents, those that occur once too; and over all but the scored one, where pairs back off."""
    return backoff.stupid_backoff(table(spark, sf_dir, "documents"), order=2, min_count=1)


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of 5, 2 and 1, half as many words again as there are, blocks of 16 words."""
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compression_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_toxicity": op5_toxicity,
    "op6_warc": op6_warc,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_stupid_backoff": op9_stupid_backoff,
    "op10_token_id_files": op10_token_id_files,
    "op11_source_mix": op11_source_mix,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op4_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
        ), r AS (
            SELECT *, payload_bytes >= 100 AND page_id <> first_id AS again FROM f
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END AS refers_to
        FROM r
    """,
    "op11_source_mix": r"""
        WITH sized AS (
            SELECT CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey, source, doc_id,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents
        ), sources AS (
            SELECT skey, source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY skey) - 1) % 3] AS weight
            FROM sized GROUP BY skey, source
        ), ratios AS (
            SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
                   coalesce(sum(source_size) OVER lower, 0) AS size_below, coalesce(sum(weight) OVER lower, 0) AS weight_below
            FROM sources
            WINDOW lower AS (ORDER BY CAST(source_size AS DOUBLE) / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), bounds AS (
            SELECT *, 2 * source_size * 2 * (all_weight - weight_below) <= (3 * total - 4 * size_below) * weight AS is_full
            FROM ratios
        ), rest AS (
            SELECT coalesce(sum(source_size) FILTER (WHERE is_full), 0) AS full_size,
                   coalesce(sum(weight) FILTER (WHERE is_full), 0) AS full_weight
            FROM bounds
        ), targets AS (
            SELECT skey, source, source_size, n_rows,
                   CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
                        ELSE CAST(3 * total - 4 * full_size AS DOUBLE) * weight / CAST(2 * (all_weight - full_weight) AS DOUBLE)
                   END AS target,
                   CAST((3 * total + 16) // 32 AS BIGINT) AS seats
            FROM bounds, rest
        ), source_seats AS (
            SELECT skey, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, skey, k) AS place, seats
            FROM targets, unnest(range(CAST(target / 16 AS BIGINT) + (SELECT count(*) FROM sources) + 2)) AS t(k)
            WHERE target > 0
        ), source_quotas AS (
            SELECT skey, count(*) AS quota FROM source_seats WHERE place <= seats GROUP BY skey
        ), quotas AS (
            SELECT t.*, least(coalesce(q.quota, 0), (2 * source_size + 15) // 16) AS source_quota, (n_rows + 2047) // 2048 AS shards
            FROM targets t LEFT JOIN source_quotas q USING (skey)
        ), runs AS (
            SELECT skey, doc_id, size, count(*) AS copies FROM sized GROUP BY skey, doc_id, size
        ), copied AS (
            SELECT skey, doc_id, size, c, c // 1024 AS portion FROM runs, unnest(range(copies)) AS t(c)
        ), drawn AS (
            SELECT *, md5('1:' || skey || ':' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || size || ':' || portion) AS draw
            FROM copied
        ), placed AS (
            SELECT d.*, CAST('0x' || substr(draw, 1, 8) AS BIGINT) % shards AS shard
            FROM drawn d JOIN quotas USING (skey)
        ), lined AS (
            SELECT *, CAST(sum(size) OVER (PARTITION BY skey, shard ORDER BY draw, c) AS BIGINT) - size AS start FROM placed
        ), shards AS (
            SELECT skey, shard, CAST(sum(size) AS BIGINT) AS shard_size FROM placed GROUP BY skey, shard
        ), shard_seats AS (
            SELECT skey, shard, row_number() OVER (
                       PARTITION BY skey ORDER BY CAST(shard_size AS DOUBLE) / (2 * k + 1) DESC, shard, k) AS place, source_quota
            FROM shards JOIN quotas USING (skey), unnest(range(CAST(source_quota * (shard_size / source_size) AS BIGINT) + shards + 2)) AS t(k)
            WHERE shard_size > 0
        ), shard_quotas AS (
            SELECT skey, shard, count(*) AS quota FROM shard_seats WHERE place <= source_quota GROUP BY skey, shard
        ), line AS (
            SELECT s.skey, s.shard, shard_size, least(coalesce(quota, 0), (2 * shard_size + 15) // 16) AS quota,
                   (shard_size + 15) // 16 AS blocks_0, (2 * shard_size + 15) // 16 - (shard_size + 15) // 16 AS blocks_1,
                   CAST('0x' || substr(md5('1:' || s.skey || ':' || s.shard), 1, 8) AS BIGINT) AS phase
            FROM shards s LEFT JOIN shard_quotas q ON s.skey = q.skey AND s.shard = q.shard
        ), block AS (
            SELECT *, CASE WHEN b < blocks_0 THEN b ELSE b - blocks_0 END AS place,
                   greatest(1, CASE WHEN b < blocks_0 THEN blocks_0 ELSE blocks_1 END) AS of_lap,
                   CASE WHEN b < blocks_0 THEN least(quota, blocks_0) ELSE greatest(quota - blocks_0, 0) END AS wanted
            FROM line, unnest(range(blocks_0 + blocks_1)) AS t(b)
        ), chosen AS (
            SELECT skey, shard, b * 16 AS lo, least(b * 16 + 16, 2 * shard_size) AS hi
            FROM block
            WHERE ((place + 1) * wanted + phase % of_lap) // of_lap > (place * wanted + phase % of_lap) // of_lap
        ), passages AS (
            SELECT skey, shard, doc_id, size, c, start + lap * shard_size AS a, start + lap * shard_size + size AS z
            FROM lined JOIN line USING (skey, shard), unnest(range(2)) AS t(lap)
        ), covered AS (
            SELECT p.skey, p.doc_id, p.size, p.c, sum(greatest(0, least(hi, z) - greatest(lo, a))) AS taken
            FROM passages p JOIN chosen x ON p.skey = x.skey AND p.shard = x.shard AND lo < z AND hi > a
            GROUP BY p.skey, p.doc_id, p.size, p.c
        )
        SELECT l.doc_id, l.size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
        FROM lined l JOIN quotas USING (skey)
        LEFT JOIN covered x ON l.skey = x.skey AND l.doc_id IS NOT DISTINCT FROM x.doc_id AND l.size = x.size AND l.c = x.c
    """,
    "op12_centroid_clusters": clustering_sql(),
    "op13_vector_codes": compression_sql(),
}
