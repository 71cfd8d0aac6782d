"""Counts, histograms and summary records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.base import ARTICLES, BY_TITLE, articles, dedup_cte, query, table, text_of, toks
from catalog.extract import ENTITY_CTE, GAZETTEER
from storylake.operators import aggregates as G
from storylake.operators.aboutness import score_aboutness
from storylake.operators.entities import extract_entities
from storylake.operators.images import distinct_urls, urls_by_domain
from storylake.params import ArticleQuery, DedupStrategy, SearchTerms
from storylake.sources.articles import scan_articles


@query(
    "top_values_scalar",
    f"""WITH {ARTICLES}
SELECT nullif(title, '') AS value, count(*) AS count FROM articles
WHERE nullif(title, '') IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir).select(F.nullif("title", F.lit("")).alias("title"))
    return G.top_values(df, "title", 10)


@query(
    "top_values_list",
    f"""WITH {ARTICLES},
t AS (SELECT DISTINCT id, unnest({toks('text')}) AS value FROM articles)
SELECT value, count(*) AS count FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""",
)
def _(spark, sf_dir):
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return G.top_values(articles(spark, sf_dir).select(words.alias("words")), "words", 25)


_PER_ENTITY = """
per_type AS (SELECT entity, type, count(*) AS n FROM mentions GROUP BY 1, 2),
modal AS (SELECT entity, arg_min(type, (-n, type)) AS type FROM per_type GROUP BY 1),
per_entity AS (SELECT entity, count(*) AS count, count(DISTINCT id) AS document_count
               FROM mentions GROUP BY 1)"""


def _entities_sql(order: str, limit: str, where: str = "") -> str:
    return f"""
SELECT entity, type, count, round(document_count * 100.0::DOUBLE / (SELECT count(*) FROM articles), 6)
         AS appearance_percent, document_count
FROM per_entity JOIN modal USING (entity) {where} ORDER BY {order} DESC, entity {limit}"""


def _percent(df):
    return df.withColumn("appearance_percent", F.round("appearance_percent", 6))


@query(
    "top_entities_total",
    f"WITH {ARTICLES}, {ENTITY_CTE}, {_PER_ENTITY} {_entities_sql('count', 'LIMIT 20')}",
)
def _(spark, sf_dir):
    return _percent(G.top_entities(extract_entities(articles(spark, sf_dir), GAZETTEER), top_n=20))


@query(
    "top_entities_percent",
    f"WITH {ARTICLES}, {ENTITY_CTE}, {_PER_ENTITY} {_entities_sql('document_count', 'LIMIT 15')}",
)
def _(spark, sf_dir):
    tagged = extract_entities(articles(spark, sf_dir), GAZETTEER)
    return _percent(G.top_entities(tagged, top_n=15, sort_by="percentage"))


@query(
    "entities_filter_type",
    f"""WITH {ARTICLES}, {ENTITY_CTE.replace("mentions AS", "all_mentions AS")},
mentions AS (SELECT * FROM all_mentions WHERE type = 'LAW'), {_PER_ENTITY}
{_entities_sql('count', '')}""",
)
def _(spark, sf_dir):
    tagged = extract_entities(articles(spark, sf_dir), GAZETTEER)
    return _percent(G.top_entities(tagged, top_n=-1, filter_type="LAW"))


@query(
    "entity_modal_type",
    f"""WITH {ARTICLES},
mentions AS (
  SELECT id, unnest(regexp_extract_all(text, '(?:^|[^\\p{{L}}\\p{{N}}])(\\p{{Lu}}[\\p{{L}}\\p{{N}}]*)', 1))
           AS entity, language AS type FROM articles),
{_PER_ENTITY} {_entities_sql('count', 'LIMIT 100')}""",
)
def _(spark, sf_dir):
    words = F.regexp_extract_all(
        "text", F.lit(r"(?:^|[^\p{L}\p{N}])(\p{Lu}[\p{L}\p{N}]*)"), F.lit(1)
    )
    tagged = articles(spark, sf_dir).select(
        F.transform(
            words, lambda w: F.struct(w.alias("text"), F.col("language").alias("type"))
        ).alias("entities")
    )
    return _percent(G.top_entities(tagged, top_n=100))


@query(
    "score_histogram",
    """WITH bins AS (SELECT CAST(i AS INTEGER) AS bin, i / 10.0::DOUBLE AS lower,
                     (i + 1) / 10.0::DOUBLE AS upper FROM range(10) r(i)),
scores AS (SELECT CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 7 = 0 THEN (event_id % 11) / 10.0::DOUBLE
             ELSE value / 100.0::DOUBLE END AS s FROM events)
SELECT bin, lower, upper, count(s) AS count FROM bins
LEFT JOIN scores ON (s > lower AND s <= upper) OR (bin = 0 AND s = 0) GROUP BY ALL""",
)
def _(spark, sf_dir):
    event = F.col("event_id")
    score = (
        F.when(event % 9 == 0, F.lit(None).cast("double"))
        .when(event % 7 == 0, (event % 11) / F.lit(10.0))
        .otherwise(F.col("value") / F.lit(100.0))
    )
    scores = table(spark, sf_dir, "events").select(score.alias("about_score"))
    return G.score_histogram(scores)


@query(
    "usage_cost",
    f"""WITH {ARTICLES},
u AS (SELECT len({toks('text')}) AS p, len({toks('title')}) AS c, id % 6 = 5 AS failed FROM articles),
t AS (SELECT count(*) FILTER (NOT failed) AS total_requests,
             CAST(coalesce(sum(p) FILTER (NOT failed), 0) AS BIGINT) AS total_prompt_tokens,
             CAST(coalesce(sum(c) FILTER (NOT failed), 0) AS BIGINT) AS total_completion_tokens,
             CAST(coalesce(sum(p + c) FILTER (NOT failed), 0) AS BIGINT) AS total_tokens FROM u),
prices AS (SELECT * FROM (VALUES ('openai/gpt-oss-20b', 0.075::DOUBLE, 0.3::DOUBLE),
                                 ('openai/gpt-oss-120b', 0.15::DOUBLE, 0.6::DOUBLE)) v(model, i, o))
SELECT 'groq' AS provider, m.model, t.*, i AS price_per_million_input_usd,
       o AS price_per_million_output_usd,
       round(total_prompt_tokens / 1e6 * i, 9) AS total_input_cost_usd,
       round(total_completion_tokens / 1e6 * o, 9) AS total_output_cost_usd,
       round(total_prompt_tokens / 1e6 * i + total_completion_tokens / 1e6 * o, 9) AS total_cost_usd
FROM t CROSS JOIN (VALUES ('openai/gpt-oss-20b'), ('openai/gpt-oss-120b')) m(model)
LEFT JOIN prices USING (model)""",
)
def _(spark, sf_dir):
    token = F.lit(r"[\p{L}\p{N}]+")
    asked = F.regexp_count("text", token).cast("long")
    answered = F.regexp_count("title", token).cast("long")
    usage = F.when(
        F.col("id") % 6 != 5,
        F.struct(
            asked.alias("prompt_tokens"),
            answered.alias("completion_tokens"),
            (asked + answered).alias("total_tokens"),
        ),
    )
    df = articles(spark, sf_dir).select(usage.alias("usage"))
    both = G.usage_cost(df, model="openai/gpt-oss-20b").unionByName(
        G.usage_cost(df, model="openai/gpt-oss-120b")
    )
    costs = ["total_input_cost_usd", "total_output_cost_usd", "total_cost_usd"]
    return both.withColumns({name: F.round(name, 9) for name in costs})


@query(
    "query_summary",
    f"""WITH {ARTICLES},
hits AS (SELECT * FROM articles WHERE publish_date >= DATE '2024-01-05'
         AND media_name IN ('src1', 'src2', 'src3') AND list_contains({toks('text')}, 'the')),
{dedup_cte("hits", BY_TITLE[0], BY_TITLE[1], "ranked")}
SELECT 'the' AS query, '2024-01-05' AS start_date, '2024-02-29' AS end_date, '' AS collection_ids,
       'src1|src2|src3' AS source_ids, count(*) AS story_count, 'title' AS dedup_strategy
FROM ranked WHERE rn = 1""",
)
def _(spark, sf_dir):
    wanted = ArticleQuery(
        terms=SearchTerms(all_of=("the",)),
        start_date=date(2024, 1, 5),
        end_date=date(2024, 2, 29),
        sources=("src1", "src2", "src3"),
        dedup_strategy=DedupStrategy.TITLE,
    )
    stories, _dedup = scan_articles(articles(spark, sf_dir), wanted)
    return G.query_summary(stories, wanted).select(
        "query",
        *text_of("start_date", "end_date"),
        F.array_join(F.col("collection_ids").cast("array<string>"), "|").alias("collection_ids"),
        F.array_join("source_ids", "|").alias("source_ids"),
        "story_count",
        "dedup_strategy",
    )


@query(
    "urls_by_domain",
    r"""WITH u AS (SELECT DISTINCT url, nullif(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1), '') AS domain
                   FROM pages),
d AS (SELECT domain, CAST((row_number() OVER (ORDER BY md5(domain), domain) - 1) % 4 AS INTEGER) AS batch
      FROM (SELECT DISTINCT domain FROM u WHERE domain IS NOT NULL))
SELECT url, domain, batch FROM u JOIN d USING (domain)""",
)
def _(spark, sf_dir):
    return urls_by_domain(table(spark, sf_dir, "pages"), batches=4)


@query(
    "distinct_urls",
    f"""SELECT url, count(*) AS article_count FROM
(SELECT 'http://' || source || '.example.org/' || (doc_id // 3) AS url FROM documents) GROUP BY 1""",
)
def _(spark, sf_dir):
    shared = F.concat(
        F.lit("http://"), "source", F.lit(".example.org/"), F.floor(F.col("doc_id") / 3)
    )
    return distinct_urls(table(spark, sf_dir, "documents").select(shared.alias("url")))


@query(
    "about_score_distribution",
    f"""WITH {ARTICLES},
m AS (SELECT *, CAST((length(lower(text)) - length(replace(lower(text), 'rewh', ''))) // 4 AS INTEGER) AS k,
             strpos(lower(title), 'rewh') > 0 AS ti,
             strpos(lower(text), 'rewh') AS first_at FROM articles),
s AS (SELECT round(least(1.0::DOUBLE, 0.5::DOUBLE * ti::INT + 0.15::DOUBLE * least(k, 4)
        + 0.35::DOUBLE * (first_at > 0 AND first_at <= length(text) / 2.0)::INT), 4) AS s FROM m),
bins AS (SELECT CAST(i AS INTEGER) AS bin, i / 10.0::DOUBLE AS lower, (i + 1) / 10.0::DOUBLE AS upper
         FROM range(10) r(i))
SELECT bin, lower, upper, count(s) AS count FROM bins
LEFT JOIN s ON (s > lower AND s <= upper) OR (bin = 0 AND s = 0) GROUP BY ALL""",
)
def _(spark, sf_dir):
    return G.score_histogram(score_aboutness(articles(spark, sf_dir), "rewh"))
