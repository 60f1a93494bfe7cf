"""Queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import curriculum, hamming_search, host_trust, html_consensus, license_scan, media_archive, ngram_join, pattern_packing, quality_knn, token_counts
from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_trust.judge_urls(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract_main_text(table(spark, sf_dir, "pages"))


def op6_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix_sources(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 50, among all."""
    return hamming_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_archive.media_digests(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_url_filters,
        op3_best_fit_packing,
        op4_license_scans,
        op5_html_extraction,
        op6_mixing_sources,
        op7_token_counts,
        op8_exact_top_k,
        op9_media_columns,
        op10_ngram_jaccard_join,
    )
}
#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op6_mixing_sources": r"""
        WITH sized AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS key
          FROM documents),
        sources AS (
          SELECT *, CASE s % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
          FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM sized GROUP BY source)),
        -- sources fill up in the order of their room by weight; the level is that of the first that doesn't
        filled AS (
          SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 2 * source_size / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
          FROM sources),
        targets AS (
          SELECT source, s, source_size,
                 least((2 * source_size)::DOUBLE, (SELECT min_by(level, 2 * source_size / weight) FROM filled WHERE 2 * source_size >= level * weight) * weight) AS target
          FROM filled),
        placed AS (
          SELECT d.doc_id, d.size, t.source_size, t.target, t.s, floor(t.target + 0.5)::BIGINT AS demand,
                 coalesce(sum(d.size) OVER (PARTITION BY t.s ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
          FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
        taken AS (
          SELECT *, CASE WHEN source_size > 0 THEN demand // source_size ELSE 0 END AS whole,
                 greatest(0, least(size, demand - CASE WHEN source_size > 0 THEN demand // source_size ELSE 0 END * source_size - before)) AS extra
          FROM placed),
        timed AS (
          SELECT *, CASE WHEN whole * size + extra > 0 THEN (before + CASE WHEN whole > 0 THEN size ELSE extra END / 2.0::DOUBLE) / demand END AS y
          FROM taken)
        SELECT doc_id, size, source_size, target, (whole * size + extra)::BIGINT AS taken,
               (CASE WHEN size > 0 THEN (whole * size + extra) // size ELSE 0 END)::INTEGER AS copies,
               round(CASE s % 3 WHEN 0 THEN y WHEN 1 THEN sqrt(0.25::DOUBLE + 2 * y) - 0.5 ELSE 1.5 - sqrt(2.25::DOUBLE - 2 * y) END, 6) AS position
        FROM timed""",
    "op8_exact_top_k": """
        WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
        pairs AS (
          SELECT q.vec_id AS query_id, v.vec_id, len(list_filter(list_zip(q.bits, v.bits), lambda z: z[1] <> z[2]))::INTEGER AS distance
          FROM codes q, codes v WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM pairs)
        SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10""",
    "op10_ngram_jaccard_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
          FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS shingles
          FROM words),
        each AS (SELECT doc_id, len(shingles)::BIGINT AS n, unnest(shingles) AS shingle FROM sets),
        links AS (
          SELECT a.doc_id AS u, b.doc_id AS v FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
          SELECT doc_id AS node, doc_id AS seen FROM documents
          UNION SELECT r.node, l.v FROM reach r JOIN links l ON r.seen = l.u)
        SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, r.component_id
        FROM sets s JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) r ON s.doc_id = r.node""",
}
