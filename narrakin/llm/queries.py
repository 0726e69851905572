"""Registered queries of the operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.llm import brown, fingerprints, html, langid, negatives, packing, pieces, quality, simhash, urls, vectors, whitening, wordpiece
from narrakin.llm.tables import table

PIECES = "piece_bpe_32k.model"


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(spark, table(spark, sf_dir, "documents"))


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark, table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark, table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_digests(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("_row.doc_id", "_q.*")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark, table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


def op12_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.class_scores(spark, table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(spark, rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_vectors, op3_token_counts, op4_html, op5_packing, op6_pieces, op7_quality, op8_urls, op9_simhash,
                            op10_language, op11_whitening, op12_class_scores, op13_negatives)
}

_OP2_SQL = """
WITH RECURSIVE sound AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(low, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(low, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counted USING (vec_id) LEFT JOIN lowest USING (vec_id)
"""

_OP8_SQL = """
WITH RECURSIVE rules(verdict, h, p) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
canonical AS (
    SELECT url AS a, unnest(regexp_extract_all(html, '(?is)<link[^>]*rel="canonical"[^>]*href="([^"]*://[^"]*)"', 1)) AS b FROM pages),
urls AS (SELECT url FROM pages UNION SELECT b FROM canonical),
parts AS (
    SELECT url, lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)) AS host,
           regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
           regexp_extract(url, '(?s)^[^#]*?://[^?#]*(\\?[^#]*)', 1) AS query FROM urls),
ruled AS (
    SELECT url, any_value(host) AS host, any_value(path) AS path,
           any_value(CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END) AS node,
           arg_max(h || p, length(h || p)) FILTER (h IS NOT NULL) AS rule, arg_max(verdict, length(h || p)) FILTER (h IS NOT NULL) AS verdict
    FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url),
links AS (
    SELECT x.node AS a, y.node AS b FROM canonical c JOIN ruled x ON c.a = x.url JOIN ruled y ON c.b = y.url
    UNION SELECT y.node, x.node FROM canonical c JOIN ruled x ON c.a = x.url JOIN ruled y ON c.b = y.url),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
decided AS (
    SELECT a AS node, max(verdict = 'allow') AS allowed FROM reach JOIN ruled ON reach.b = ruled.node WHERE verdict IS NOT NULL GROUP BY a)
SELECT p.page_id, coalesce(r.host, '') AS host, coalesce(r.path, '') AS path, r.rule,
       coalesce(r.verdict, CASE WHEN NOT d.allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p LEFT JOIN ruled r ON p.url = r.url LEFT JOIN decided d ON r.node = d.node
"""

_OP13_SQL = """
WITH rows_in AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.e, b.e)::BIGINT AS score
    FROM rows_in a JOIN rows_in b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE own = label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND s.own <> s.label
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op2_vectors": _OP2_SQL, "op8_urls": _OP8_SQL, "op13_negatives": _OP13_SQL}
