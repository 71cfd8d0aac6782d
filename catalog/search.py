"""Predicates, limits and sampling."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.base import ARTICLES, BY_TITLE, articles, dedup_cte, query, sentences_cte, table, text_of, toks
from storylake.operators.dedup import deduplicate
from storylake.operators.search import (
    any_pattern,
    filter_date_range,
    filter_scope,
    mention_mask,
    search_proximity,
    search_proximity_terms,
    search_terms,
)
from storylake.operators.selection import limit_after_dedup, limit_before_dedup, random_sample
from storylake.operators.sentences import sentence_table

_PADDED = f"""
padded AS (
  SELECT *, ' ' || array_to_string({toks('text')}, ' ') || ' ' AS t,
         ' ' || array_to_string({toks('title')}, ' ') || ' ' AS h FROM articles)"""


@query(
    "search_terms",
    f"""WITH {ARTICLES}, {_PADDED}
SELECT id, title FROM padded
WHERE (contains(t, ' the ') OR contains(h, ' the '))
  AND (contains(t, ' mit license ') OR contains(h, ' mit license ')
       OR contains(t, ' token ') OR contains(h, ' token ') OR contains(t, ' that '))
  AND NOT (contains(t, ' der ') OR contains(h, ' der '))""",
)
def _(spark, sf_dir):
    found = search_terms(
        articles(spark, sf_dir),
        all_of=["the"],
        any_of=["MIT License", "token", "that"],
        none_of=["der"],
    )
    return found.select("id", "title")


@query(
    "search_proximity",
    f"""WITH {ARTICLES},
t AS (SELECT id, unnest({toks('text')}) AS tok, unnest(range(len({toks('text')}))) AS pos FROM articles),
gaps AS (SELECT id, pos - lag(pos, 2) OVER (PARTITION BY id ORDER BY pos) AS span
         FROM t WHERE tok = 'that')
SELECT id, title FROM articles WHERE id IN (SELECT id FROM gaps WHERE span <= 20)""",
)
def _(spark, sf_dir):
    return search_proximity(articles(spark, sf_dir), "that", 3, 20).select("id", "title")


@query(
    "search_proximity_terms",
    f"""WITH {ARTICLES},
fields AS (SELECT id, 0 AS field, title AS body FROM articles UNION ALL SELECT id, 1, text FROM articles),
t AS (SELECT id, field, unnest({toks('body')}) AS tok, unnest(range(len({toks('body')}))) AS pos FROM fields),
n AS (SELECT *, lead(tok) OVER (PARTITION BY id, field ORDER BY pos) AS following FROM t),
a AS (SELECT id, field, pos, lead(pos) OVER (PARTITION BY id, field ORDER BY pos) AS again
      FROM n WHERE tok = 'that'),
b AS (SELECT id, field, pos FROM n WHERE tok = 'of' AND following = 'the')
SELECT id, title FROM articles WHERE id IN (
  SELECT a.id FROM a JOIN b ON a.id = b.id AND a.field = b.field
  WHERE again IS NOT NULL AND greatest(again, b.pos) - least(a.pos, b.pos) <= 30)""",
)
def _(spark, sf_dir):
    found = search_proximity_terms(articles(spark, sf_dir), ["that", "of the", "That"], 30)
    return found.select("id", "title")


@query(
    "filter_date_range",
    f"""WITH {ARTICLES}
SELECT id, CAST(publish_date AS VARCHAR) AS publish_date FROM articles
WHERE publish_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'""",
)
def _(spark, sf_dir):
    found = filter_date_range(articles(spark, sf_dir), date(2024, 1, 8), date(2024, 1, 20))
    return found.select("id", *text_of("publish_date"))


@query(
    "filter_sources",
    f"WITH {ARTICLES} SELECT id, media_name FROM articles WHERE media_name IN ('src1', 'src7')",
)
def _(spark, sf_dir):
    return filter_scope(articles(spark, sf_dir), ["src1", "src7"]).select("id", "media_name")


_COLLECTIONS = """
collection_sources AS (
  SELECT DISTINCT CAST(substr(source, 4) AS INTEGER) % 5 AS collection_id, source AS media_name
  FROM documents)"""


@query(
    "filter_collections",
    f"""WITH {ARTICLES}, {_COLLECTIONS}
SELECT id, media_name FROM articles
WHERE media_name = 'src1'
   OR media_name IN (SELECT media_name FROM collection_sources WHERE collection_id IN (2, 3))""",
)
def _(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    members = documents.select(
        (F.substring("source", 4, 9).cast("int") % 5).alias("collection_id"),
        F.col("source").alias("media_name"),
    ).distinct()
    found = filter_scope(articles(spark, sf_dir), ["src1"], [2, 3], members)
    return found.select("id", "media_name")


_PATTERNS = ["licen[sc]e", "^the [a-z]+tion", "token = "]


@query(
    "sentence_regex_filter",
    f"""WITH {ARTICLES}, {sentences_cte()}
SELECT id, sentence_id, sentence_text FROM sentences
WHERE {" OR ".join(f"regexp_matches(sentence_text, '(?i){p}')" for p in _PATTERNS)}""",
)
def _(spark, sf_dir):
    rows = sentence_table(articles(spark, sf_dir))
    return rows.filter(any_pattern(F.col("sentence_text"), _PATTERNS))


@query(
    "mention_mask",
    f"""WITH {ARTICLES}
SELECT id, coalesce(regexp_matches(nullif(title, ''), '(?i)th.?e|é'), false) AS mentioned
FROM articles""",
)
def _(spark, sf_dir):
    title = F.nullif(F.col("title"), F.lit(""))
    return articles(spark, sf_dir).select("id", mention_mask(title, "th.?e|é").alias("mentioned"))


@query(
    "limit_before_dedup",
    f"""WITH {ARTICLES},
head AS (SELECT * FROM articles ORDER BY ingest_seq LIMIT 400),
{dedup_cte("head", BY_TITLE[0], BY_TITLE[1], "ranked")}
SELECT id, title FROM ranked WHERE rn = 1""",
)
def _(spark, sf_dir):
    return deduplicate(limit_before_dedup(articles(spark, sf_dir), 400)).select("id", "title")


@query(
    "limit_after_dedup",
    f"""WITH {ARTICLES}, {dedup_cte("articles", BY_TITLE[0], BY_TITLE[1], "ranked")}
SELECT id, CAST(publish_date AS VARCHAR) AS publish_date FROM ranked WHERE rn = 1
ORDER BY publish_date NULLS LAST, ingest_seq LIMIT 50""",
)
def _(spark, sf_dir):
    first = limit_after_dedup(deduplicate(articles(spark, sf_dir)), 50)
    return first.select("id", *text_of("publish_date"))


@query(
    "random_sample",
    f"""WITH {ARTICLES}
SELECT id, url FROM articles ORDER BY md5('7:' || id), ingest_seq LIMIT 100""",
)
def _(spark, sf_dir):
    return random_sample(articles(spark, sf_dir), 100, seed=7).select("id", "url")
