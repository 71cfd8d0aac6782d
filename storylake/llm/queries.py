"""Registered queries of the operators here and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylake.llm import (
    ann_curves,
    bpe_automaton,
    exact_dedup,
    hard_negatives,
    html_template,
    license_scan,
    mixing,
    near_join,
    norm_search,
    quality,
    sketch_dedup,
    token_counts,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Where the vocabulary lies is a parameter of the operators; these queries name the file.
BYTE_BPE = "byte_bpe_50k.json"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cyclic_weights(sources: list) -> list[int]:
    """Weights 1, 2, 3, repeating."""
    return [i % 3 + 1 for i in range(len(sources))]


@query()
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, sources = mixing.mix(
        table(spark, sf_dir, "documents"),
        "doc_id",
        size=mixing.word_count(F.col("text")),
        sources=F.array("source"),
        weights=cyclic_weights,
    )
    # One row per source; the operator has collected as many already.
    sources = F.broadcast(sources.drop("taken"))
    own = mixed.withColumn("own", F.element_at("sources", 1))
    return own.join(sources, own.own.eqNullSafe(sources.source)).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


URL_RULES = url_filter.parse_rules(
    allow=("com/", "www.example.com/en/"), block=("example.com/en/", "net/es/", "net/fr/")
)


@query(r"""
WITH RECURSIVE parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule, rule_host, rule_path, decision) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), direct AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
    arg_max(decision, length(rule)) AS decision
  FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path
), tags AS (
  SELECT url, unnest(regexp_extract_all(
    regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>', ' ', 'g'),
    '(?i)<(?:link|meta)\b[^>]*>')) AS tag
  FROM pages
), targets AS (
  SELECT url, CASE WHEN regexp_matches(tag, '(?i)\srel\s*=\s*["'']?canonical')
    THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']([^"'']*)["'']', 1)
    WHEN regexp_matches(tag, '(?i)http-equiv\s*=\s*["'']?refresh')
    THEN regexp_extract(tag, '(?i)url\s*=\s*([^"''>\s]*)', 1) END AS target
  FROM tags
), nodes AS (
  SELECT page_id, regexp_replace(url, '^.*?://|#.*$', '', 'g') AS node FROM pages
), links AS (
  SELECT regexp_replace(url, '^.*?://|#.*$', '', 'g') AS a,
    regexp_replace(target, '^.*?://|#.*$', '', 'g') AS b
  FROM targets WHERE target LIKE '%://%'
), reached(node, other) AS (
  SELECT a, a FROM links
  UNION SELECT b, b FROM links
  UNION SELECT r.node, l.b FROM reached r JOIN (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.a
), aliases AS (
  SELECT DISTINCT r.node FROM reached r JOIN nodes n ON r.other = n.node
    JOIN direct d ON d.page_id = n.page_id WHERE d.decision = 'block'
)
SELECT d.page_id, d.host, d.path, d.rule,
  coalesce(d.decision, CASE WHEN a.node IS NOT NULL THEN 'block' END, 'allow') AS verdict,
  CASE WHEN d.decision IS NOT NULL THEN 'rule' WHEN a.node IS NOT NULL THEN 'alias'
    ELSE 'default' END AS via
FROM direct d JOIN nodes n USING (page_id) LEFT JOIN aliases a USING (node)
""")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, URL_RULES, url_filter.page_links(pages))


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


@query()
def op4_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_text(table(spark, sf_dir, "pages"))


@query("""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM texts
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = exact_dedup.duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


@query()
def op6_ann_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann_curves.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


#: Scores from here on count as label 1.
GOOD_QUALITY = 0.3


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out())
    model = quality.fit_quality(docs, labels)
    return quality.score_quality(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= GOOD_QUALITY).cast("int").alias("predicted"),
    )


@query()
def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return bpe_automaton.token_digests(table(spark, sf_dir, "documents"), path)


@query("""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY doc_id) USING (doc_id)
""")
def op9_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


@query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id, d.doc_id = least_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY doc_id) USING (doc_id)
""")
def op11_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query(r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (
  SELECT doc_id, len(w) AS n FROM words WHERE len(w) > 0
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words)
  GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scores AS (
  SELECT item_id, doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
""")
def op12_norm_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50
    )


@query("""
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
    list_dot_product(a.vec, b.vec)::BIGINT AS score
  FROM rows a JOIN rows b ON a.id % 50 = 0 AND a.id <> b.id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", shifted), F.col("vec_id") % 50 == 0)
