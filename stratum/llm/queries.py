"""Registered queries of the training-data operators, one per operator, and their DuckDB SQL where SQL can say it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.llm import (bpe, decontaminate, exact_dedup, fixity, fuzzy_lines, hard_negatives, near_dedup, packing, quality,
                         secret_scan, token_count, toxicity, whitening)
from stratum.llm.common import read


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(read(spark, sf_dir, "documents")))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leaked (doc_id, item_id); clean documents have none."""
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op5_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines linked by edit similarity alone."""
    return fuzzy_lines.fuzzy_line_report(read(spark, sf_dir, "documents"), bits=None)


def op6_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=2)


def op7_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audited replica is ``pages`` with one damaged byte in the body of every page whose number leaves 7 by 500."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rot = F.when((F.col("page_id") % 500 == 7) & (F.length(html) > 0), F.concat(F.lit("#"), F.expr("substring(coalesce(html, ''), 2)"))).otherwise(html)
    pages = read(spark, sf_dir, "pages")
    return fixity.fixity_report(pages, pages.withColumn("html", rot))


def op9_replica_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every 500 pages the replica has one changed in a byte (7), one longer (11), one missing (13) and one copy at
    another address (17)."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    html, of = F.coalesce(F.col("html"), F.lit("")), F.col("page_id") % 500
    body = F.when((of == 7) & (F.length(html) > 0), F.concat(F.lit("#"), F.expr("substring(coalesce(html, ''), 2)"))) \
        .when(of == 11, F.concat(html, F.lit("<!-- -->"))).otherwise(html)
    kept = pages.withColumn("html", body).where(F.coalesce(of != 13, F.lit(True)))
    copies = pages.where(of == 17).withColumn("url", F.concat(F.coalesce(F.col("url"), F.lit("")), F.lit("#copy")))
    return fixity.replica_report(pages, kept.unionByName(copies))


def op10_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"))


def op11_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(read(spark, sf_dir, "documents"))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_kronecker_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are every hundredth vec_id; every seventh has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_benchmark_decontamination, op3_token_counts, op4_exact_dedup, op5_fuzzy_line_dedup,
                            op6_odd_sketch_dedup, op7_swap_packing, op8_toxic_segments, op9_merkle_fixity, op9_replica_audit, op10_weak_label_quality,
                            op11_jacobi_davidson_whitening, op12_transducer_bpe, op13_kronecker_hard_negatives, pipeline)}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op9_merkle_fixity": r"""
        WITH d AS (SELECT CASE WHEN count(*) <= 1000 THEN 0 WHEN count(*) <= 16000 THEN 1 WHEN count(*) <= 256000 THEN 2
                               WHEN count(*) <= 4096000 THEN 3 WHEN count(*) <= 65536000 THEN 4 ELSE 5 END AS digits FROM pages),
        p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
                     CASE WHEN page_id % 500 = 7 AND length(coalesce(html, '')) > 0 THEN '#' || substr(html, 2) ELSE coalesce(html, '') END AS other FROM pages),
        h AS (SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
                     || coalesce(CAST(page_id AS VARCHAR), 'null') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
                     || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS head, chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM p),
        r AS (SELECT page_id, url, substr(md5(coalesce(CAST(page_id AS VARCHAR), 'null') || '|' || url), 1, (SELECT digits FROM d)) AS file,
                     head || strlen(html) || gap || html || gap AS rec, head || strlen(other) || gap || other || gap AS rep FROM h)
        SELECT page_id, file, CAST(coalesce(sum(strlen(rec)) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, url, sha256(rec)
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos, strlen(rec) AS length, sha256(rec) AS sha256,
               rec = rep AS intact, CASE WHEN rec <> rep THEN sha256(rep) END AS replica_sha256
        FROM r""",
    "op13_kronecker_hard_negatives": r"""
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
              FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
        QUALIFY row_number() OVER w <= 5""",
}
