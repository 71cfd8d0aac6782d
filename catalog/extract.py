"""Sentences, entities, keywords, quotes and images."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ARTICLES, TOK, articles, query, quoted, sentences_cte, stopwords_cte, table
from storylake.operators import keywords as K
from storylake.operators.entities import extract_entities
from storylake.operators.images import extract_top_images, join_top_images
from storylake.operators.quotes import CLOSED, HEAD, LEADS_ON, QUOTE, REACH, SIDES, quote_table
from storylake.operators.sentences import matching_sentences, sentence_table

GAZETTEER = {
    "Apache License": "LAW",
    "MIT License": "LAW",
    "GNU General Public License": "LAW",
    "CC BY": "LAW",
    "Copyright": "LAW",
    "Stteen Erachtz": "PERSON",
}

_RUN = r"(?:^|[^\p{L}\p{N}])(\p{Lu}[\p{L}\p{N}]*(?: \p{Lu}[\p{L}\p{N}]*)*)"

#: ``mentions(id, pos, entity, type)`` in order of appearance.
ENTITY_CTE = f"""
gazetteer AS (SELECT * FROM (VALUES {", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in GAZETTEER.items())})
              v(entity, known)),
runs AS (SELECT id, unnest(regexp_extract_all(text, '{_RUN}', 1)) AS entity,
                unnest(range(len(regexp_extract_all(text, '{_RUN}', 1)))) AS pos FROM articles),
mentions AS (
  SELECT id, pos, entity, coalesce(known, CASE WHEN contains(entity, ' ') THEN 'MISC' END) AS type
  FROM runs LEFT JOIN gazetteer USING (entity)
  WHERE known IS NOT NULL OR contains(entity, ' '))"""


@query(
    "sentences",
    f"WITH {ARTICLES}, {sentences_cte()} SELECT id, sentence_id, sentence_text FROM sentences",
)
def _(spark, sf_dir):
    return sentence_table(articles(spark, sf_dir))


@query(
    "matching_sentences",
    f"""WITH {ARTICLES}, {sentences_cte()}
SELECT id, media_name, title, CAST(publish_date AS VARCHAR) AS publish_date, url, language,
       sentence_id, sentence_text
FROM sentences WHERE regexp_matches(sentence_text, '(?i)licen[sc]e')
                  OR regexp_matches(sentence_text, '(?i)rewh')""",
)
def _(spark, sf_dir):
    found = matching_sentences(articles(spark, sf_dir), ["licen[sc]e", "REWH"])
    return found.withColumn("publish_date", F.col("publish_date").cast("string"))


_ENTITY_LIST = f"""WITH {ARTICLES}, {ENTITY_CTE},
listed AS (SELECT id, string_agg(entity || '/' || type, '|' ORDER BY pos) AS entities
           FROM mentions GROUP BY 1)
SELECT id, coalesce(entities, '') AS entities FROM articles LEFT JOIN listed USING (id)"""


def _entity_list(df):
    shown = F.transform("entities", lambda e: F.concat(e["text"], F.lit("/"), e["type"]))
    return df.select("id", F.array_join(shown, "|").alias("entities"))


@query("entities", _ENTITY_LIST)
def _(spark, sf_dir):
    return _entity_list(extract_entities(articles(spark, sf_dir), GAZETTEER))


@query("entities_gazetteer_table", _ENTITY_LIST)
def _(spark, sf_dir):
    names = spark.createDataFrame(list(GAZETTEER.items()), "text string, type string")
    return _entity_list(extract_entities(articles(spark, sf_dir), names))


def _said_sql(text: str, side: str) -> str:
    """Struct of name and pronoun found on one side, or null."""
    names, pronouns = (
        "coalesce("
        + ", ".join(f"nullif(regexp_extract({text}, {quoted(p)}, 1), '')" for p in patterns)
        + ")"
        for patterns in SIDES[side]
    )
    name = f"CASE WHEN lower({names}) NOT IN ('he', 'she', 'they') THEN {names} END"
    return (
        f"CASE WHEN coalesce({name}, {pronouns}) IS NOT NULL "
        f"THEN struct_pack(name := {name}, pronoun := lower({pronouns})) END"
    )


def quotes_cte(source: str) -> str:
    """``attributed``: the source's rows with quote_id, quote, speaker and pronoun."""
    return f"""
quoted_parts AS (
  SELECT *, regexp_extract_all(text, {quoted(QUOTE)}, 1) AS quotes,
    regexp_extract_all(text, {quoted(QUOTE)}, 2) AS behind,
    regexp_extract(text, {quoted(HEAD)}, 1) AS head FROM {source}),
quoted_rows AS (
  SELECT *, unnest(quotes) AS quote, CAST(unnest(range(len(quotes))) AS INTEGER) AS quote_id
  FROM quoted_parts),
sides AS (
  SELECT *, right(CASE WHEN quote_id = 0 THEN head ELSE behind[quote_id] END, {REACH}) AS front,
    behind[quote_id + 1] AS after, quote_id + 1 < len(behind) AS more FROM quoted_rows),
heard AS (
  SELECT *, coalesce({_said_sql("front", "joined")},
    CASE WHEN NOT (more AND regexp_matches(quote, {quoted(CLOSED)})
      AND regexp_matches(after, {quoted(LEADS_ON)}))
    THEN {_said_sql(f"left(after, {REACH})", "behind")} END,
    {_said_sql("front", "front")}) AS said FROM sides),
attributed AS (
  SELECT *, coalesce(said.name, 'unspecified') AS speaker,
    coalesce(said.pronoun, 'unspecified') AS pronoun FROM heard)"""


@query(
    "quotes",
    f"""WITH {ARTICLES}, {quotes_cte("articles")}
SELECT id, media_name, quote_id, quote, speaker, pronoun FROM attributed""",
)
def _(spark, sf_dir):
    found = quote_table(articles(spark, sf_dir).select("id", "media_name", "text"))
    return found.select("id", "media_name", "quote_id", "quote", "speaker", "pronoun")


_IMAGE_PAGES = """
image_pages AS (
  SELECT page_id, url, CASE page_id % 3
    WHEN 0 THEN '<meta property="og:image" content="https://img.example.org/' || page_id || '.jpg">' || html
    WHEN 1 THEN html || '<img class="lead" src="https://img.example.org/' || page_id || '.png">'
    ELSE '<div class="ad"><img src="https://ads.example.org/banner.png"></div>' || html END AS html
  FROM pages)"""

_IMAGE_SQL = r"""coalesce(
  nullif(regexp_extract(html, '(?is)<meta\b[^>]*?property="og:image"[^>]*?\bcontent="([^"]+)"', 1), ''),
  nullif(regexp_extract(html, '(?is)<meta\b[^>]*?name="twitter:image"[^>]*?\bcontent="([^"]+)"', 1), ''),
  nullif(regexp_extract(html, '(?is)<link\b[^>]*?\brel="image_src"[^>]*?\bhref="([^"]+)"', 1), ''),
  nullif(regexp_extract(regexp_replace(html, '(?is)<div class="ad">.*?</div>', ' ', 'g'),
                        '(?is)<img\b[^>]*?\bsrc="([^"]+)"', 1), ''))"""


def _image_pages(spark, sf_dir):
    page = F.col("page_id").cast("string")
    html = (
        F.when(
            F.col("page_id") % 3 == 0,
            F.concat(
                F.lit('<meta property="og:image" content="https://img.example.org/'),
                page,
                F.lit('.jpg">'),
                F.col("html"),
            ),
        )
        .when(
            F.col("page_id") % 3 == 1,
            F.concat(
                F.col("html"),
                F.lit('<img class="lead" src="https://img.example.org/'),
                page,
                F.lit('.png">'),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('<div class="ad"><img src="https://ads.example.org/banner.png"></div>'),
                F.col("html"),
            )
        )
    )
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


@query(
    "top_image_extract",
    f"""WITH {_IMAGE_PAGES}
SELECT url, url AS resolved_url, coalesce({_IMAGE_SQL}, 'none') AS top_image_url FROM image_pages""",
)
def _(spark, sf_dir):
    found = extract_top_images(_image_pages(spark, sf_dir))
    return found.withColumn("top_image_url", F.coalesce("top_image_url", F.lit("none")))


#: Two articles share each fetched page; articles beyond the pages keep their own URL.
STORY_URLS = """
stories AS (SELECT a.ingest_seq, a.id, a.title, a.media_name, coalesce(p.url, a.url) AS url
            FROM articles a LEFT JOIN pages p ON a.id // 2 = p.page_id)"""

TOP_IMAGES = f"""
images AS (SELECT url, max(coalesce({_IMAGE_SQL}, '')) AS img FROM image_pages GROUP BY 1)"""


def story_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"))
    df = articles(spark, sf_dir)
    linked = df.join(pages, F.floor(df.id / 2) == pages.page_id, "left")
    return linked.withColumn("url", F.coalesce("page_url", "url")).select(*df.columns)


def image_pages(spark, sf_dir):
    return _image_pages(spark, sf_dir)


@query(
    "top_image_join",
    f"""WITH {ARTICLES}, {STORY_URLS}, {_IMAGE_PAGES}, {TOP_IMAGES}
SELECT id, s.url, coalesce(i.img, '') AS top_image_url,
       CASE WHEN i.url IS NULL THEN '' ELSE s.url END AS resolved_url
FROM stories s LEFT JOIN images i ON s.url = i.url""",
)
def _(spark, sf_dir):
    images = extract_top_images(_image_pages(spark, sf_dir))
    found = join_top_images(story_urls(spark, sf_dir), images)
    return found.select(
        "id",
        "url",
        F.coalesce("top_image_url", F.lit("")).alias("top_image_url"),
        "resolved_url",
    )


IMAGE_PAGES = _IMAGE_PAGES

_TERM_CTE = f"""
{sentences_cte()},
{stopwords_cte()},
word AS (
  SELECT ingest_seq, language, sentence_total, sentence_id,
         unnest(regexp_extract_all(sentence_text, '{TOK}')) AS word,
         unnest(range(len(regexp_extract_all(sentence_text, '{TOK}')))) AS pos FROM sentences),
occurrence AS (
  SELECT *, lower(word) AS term,
    CAST(length(word) > 1 AND word = upper(word) AND regexp_matches(word, '\\p{{L}}') AS INTEGER) AS acronym,
    CAST(pos > 0 AND regexp_matches(word, '^\\p{{Lu}}') AS INTEGER) AS capital,
    lag(lower(word)) OVER w AS l, lead(lower(word)) OVER w AS r
  FROM word WINDOW w AS (PARTITION BY ingest_seq, sentence_id ORDER BY pos)),
feature AS (
  SELECT ingest_seq, language, term, count(*) AS tf, greatest(sum(acronym), sum(capital)) AS cased,
    quantile_cont(sentence_id, 0.5) AS middle, count(DISTINCT sentence_id) AS in_sentences,
    any_value(sentence_total) AS total,
    coalesce(count(DISTINCT l) / nullif(count(l), 0)::DOUBLE, 0) AS dl,
    coalesce(count(DISTINCT r) / nullif(count(r), 0)::DOUBLE, 0) AS dr
  FROM occurrence GROUP BY 1, 2, 3),
marked AS (
  SELECT f.*, s.term IS NOT NULL AS stop FROM feature f
  LEFT JOIN stopwords s ON f.language = s.language AND f.term = s.term),
article AS (
  SELECT ingest_seq, max(tf) AS max_tf, avg(tf) FILTER (NOT stop) AS mean,
    sqrt(greatest(sum(tf * tf) FILTER (NOT stop)::DOUBLE / count(*) FILTER (NOT stop)
         - pow(avg(tf) FILTER (NOT stop), 2), 0)) AS sd FROM marked GROUP BY 1),
relation AS (
  SELECT m.*, mean, sd, 1 + (dl + dr) * tf / max_tf AS rel FROM marked m JOIN article USING (ingest_seq)),
term_score AS (
  SELECT *, rel * ln(ln(3 + middle)) / (cased / (1 + ln(tf)) + coalesce(tf / (mean + sd), 0) / rel
            + in_sentences / total::DOUBLE / rel) AS s FROM relation)"""

_KEYWORD_CTE = f"""{_TERM_CTE},
gram AS (
  SELECT ingest_seq, language, term AS w1, lead(term) OVER w AS w2, lead(term, 2) OVER w AS w3
  FROM occurrence WINDOW w AS (PARTITION BY ingest_seq, sentence_id ORDER BY pos)),
candidate AS (
  SELECT ingest_seq, language, w1, NULL::VARCHAR AS w2, NULL::VARCHAR AS w3, w1 AS tail, w1 AS keyword FROM gram
  UNION ALL SELECT ingest_seq, language, w1, w2, NULL::VARCHAR, w2, w1 || ' ' || w2 FROM gram WHERE w2 IS NOT NULL
  UNION ALL SELECT ingest_seq, language, w1, w2, w3, w3, w1 || ' ' || w2 || ' ' || w3
            FROM gram WHERE w3 IS NOT NULL),
usable AS (
  SELECT ingest_seq, keyword, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, count(*) AS kf
  FROM candidate c
  WHERE NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.language = c.language AND s.term = c.w1)
    AND NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.language = c.language AND s.term = c.tail)
    AND regexp_matches(w1, '\\p{{L}}') AND (w2 IS NULL OR regexp_matches(w2, '\\p{{L}}'))
    AND (w3 IS NULL OR regexp_matches(w3, '\\p{{L}}'))
  GROUP BY 1, 2),
scored AS (
  SELECT u.ingest_seq, keyword, kf,
    round(a.s * coalesce(b.s, 1) * coalesce(c.s, 1) / (kf * (1 + a.s + coalesce(b.s, 0) + coalesce(c.s, 0))), 12)
      AS score
  FROM usable u JOIN term_score a ON a.ingest_seq = u.ingest_seq AND a.term = u.w1
  LEFT JOIN term_score b ON b.ingest_seq = u.ingest_seq AND b.term = u.w2
  LEFT JOIN term_score c ON c.ingest_seq = u.ingest_seq AND c.term = u.w3),
ranked_keywords AS (
  SELECT *, row_number() OVER (PARTITION BY ingest_seq ORDER BY score, keyword) AS rank FROM scored)"""

KEYWORD_CTE = _KEYWORD_CTE


@query(
    "keyword_scores",
    f"""WITH {ARTICLES}, {_TERM_CTE}
SELECT ingest_seq, term, tf, stop AS is_stop, round(s, 6) AS term_score FROM term_score""",
)
def _(spark, sf_dir):
    return K.term_scores(articles(spark, sf_dir)).withColumn(
        "term_score", F.round("term_score", 6)
    )


@query(
    "keywords_top",
    f"""WITH {ARTICLES}, {_KEYWORD_CTE}
SELECT ingest_seq, CAST(rank AS INTEGER) AS rank, keyword, round(score, 6) AS score
FROM ranked_keywords WHERE rank <= 10""",
)
def _(spark, sf_dir):
    return K.top_keywords(articles(spark, sf_dir), 10).withColumn("score", F.round("score", 6))


def _one_byte(expr: str) -> str:
    """Keywords are lower case, so capitals can stand for letters of two bytes: distances are by byte."""
    letters = "àâáäçèéêëíîïñóôöùûüúßœæ"
    return f"translate({expr}, '{letters}', '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'[: len(letters)]}')"


@query(
    "keywords_dedup",
    f"""WITH RECURSIVE {ARTICLES}, {_KEYWORD_CTE},
listed AS MATERIALIZED (SELECT ingest_seq, rank, keyword FROM ranked_keywords),
walk(ingest_seq, rank, kept) AS (
  SELECT ingest_seq, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) FROM articles
  UNION ALL
  SELECT w.ingest_seq, l.rank, CASE WHEN len(list_filter(w.kept, lambda k:
      1 - levenshtein({_one_byte("k")}, {_one_byte("l.keyword")}) / greatest(length(k), length(l.keyword))::DOUBLE >= 0.9)) > 0
    THEN w.kept ELSE list_append(w.kept, l.keyword) END
  FROM walk w JOIN listed l ON l.ingest_seq = w.ingest_seq AND l.rank = w.rank + 1
  WHERE len(w.kept) < 10)
SELECT id, coalesce(array_to_string(arg_max(kept, rank), '|'), '') AS keywords
FROM walk JOIN articles USING (ingest_seq) GROUP BY ingest_seq, id""",
)
def _(spark, sf_dir):
    found = K.extract_keywords(articles(spark, sf_dir), top_n=10)
    return found.select("id", F.array_join("keywords", "|").alias("keywords"))
