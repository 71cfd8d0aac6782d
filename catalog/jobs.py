"""The composed jobs, each with SQL for its main result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.base import ARTICLES, BY_TITLE, BY_TITLE_SOURCE, articles, dedup_cte, query, sentences_cte, toks
from catalog.extract import (
    ENTITY_CTE,
    GAZETTEER,
    IMAGE_PAGES,
    KEYWORD_CTE,
    STORY_URLS,
    TOP_IMAGES,
    image_pages,
    quotes_cte,
    story_urls,
)
from catalog.labels import HYPOTHESES, LABELS, label_cte
from catalog.models import (
    ABOUT_CTE,
    BIN_COUNTS,
    NEGATIVE,
    POSITIVE,
    SENTIMENT_CTE,
    SENTIMENT_TARGET,
    SUMMARY_CTE,
    SUMMARY_SQL,
    TARGET,
    shown_sentiment,
    shown_summary,
)
from storylake.plans import jobs as J
from storylake.params import AboutnessParams, ArticleQuery, LabelParams, SearchTerms

#: All articles of the month, one per normalised title.
MONTH = ArticleQuery(
    start_date=date(2024, 1, 1), end_date=date(2024, 1, 31), dedup_strategy="title"
)
_BY_TITLE = f"""WITH {ARTICLES}, {dedup_cte("articles", *BY_TITLE, "by_title")},
stories AS (SELECT * FROM by_title WHERE rn = 1)"""
_BY_SOURCE = f"""WITH {ARTICLES}, {dedup_cte("articles", *BY_TITLE_SOURCE, "by_source")},
unique_stories AS (SELECT * FROM by_source WHERE rn = 1)"""
_ANY = ArticleQuery()


@query(
    "job_keywords",
    f"""{_BY_TITLE},
{KEYWORD_CTE.replace("FROM articles)", "FROM stories)")}
SELECT keyword AS value, count(*) AS count FROM ranked_keywords WHERE rank <= 10
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
)
def _(spark, sf_dir):
    outputs = J.keywords(articles(spark, sf_dir), MONTH, top_n=10, dedup_limit=1.0)
    return outputs["top_keywords"]


@query(
    "job_entities",
    f"""{_BY_TITLE}, {ENTITY_CTE.replace("FROM articles)", "FROM stories)")},
per_type AS (SELECT entity, type, count(*) AS n FROM mentions GROUP BY 1, 2),
per_entity AS (SELECT entity, count(*) AS count, count(DISTINCT id) AS document_count FROM mentions GROUP BY 1)
SELECT entity, type, count, document_count,
  round(document_count * 100.0::DOUBLE / (SELECT count(*) FROM stories), 6) AS appearance_percent
FROM per_entity JOIN per_type USING (entity) ORDER BY count DESC, entity LIMIT 20""",
)
def _(spark, sf_dir):
    found = J.entities(articles(spark, sf_dir), MONTH, GAZETTEER, top_n=20)["top_entities"]
    return found.withColumn("appearance_percent", F.round("appearance_percent", 6))


@query(
    "job_matching_sentences",
    f"""{_BY_SOURCE}, {sentences_cte("unique_stories")}
SELECT id, media_name, title, CAST(publish_date AS VARCHAR) AS publish_date, url, language,
       sentence_id, sentence_text FROM sentences
WHERE regexp_matches(sentence_text, '(?i)licen[sc]e') OR regexp_matches(sentence_text, '(?i)^the re')""",
)
def _(spark, sf_dir):
    outputs = J.matching_sentences(articles(spark, sf_dir), _ANY, ["licen[sc]e", "^the re"])
    found = outputs["sentences"]
    return found.withColumn("publish_date", F.col("publish_date").cast("string"))


@query(
    "job_targeted_sentiment",
    f"""{_BY_SOURCE}, {sentences_cte("unique_stories")},
mentioned AS (SELECT id, sentence_id, sentence_text FROM sentences
              WHERE regexp_matches(sentence_text, '(?i)tion (of|and|de)')), {SENTIMENT_CTE}
SELECT * FROM sentiment""",
)
def _(spark, sf_dir):
    outputs = J.targeted_sentiment(
        articles(spark, sf_dir), _ANY, SENTIMENT_TARGET, ["tion (of|and|de)"], POSITIVE, NEGATIVE
    )
    return shown_sentiment(outputs["sentences"])


@query(
    "job_top_images",
    f"""{_BY_SOURCE}, {STORY_URLS.replace("FROM articles a", "FROM unique_stories a")}, {IMAGE_PAGES}, {TOP_IMAGES}
SELECT id, title, s.url, coalesce(i.img, '') AS top_image_url,
       CASE WHEN i.url IS NULL THEN '' ELSE s.url END AS resolved_url
FROM stories s LEFT JOIN images i ON s.url = i.url""",
)
def _(spark, sf_dir):
    outputs = J.top_images(story_urls(spark, sf_dir), _ANY, image_pages(spark, sf_dir))
    return outputs["stories"].select(
        "id", "title", "url", F.coalesce("top_image_url", F.lit("")).alias("top_image_url"), "resolved_url"
    )


@query(
    "job_duplicates",
    f"""{_BY_TITLE} SELECT id, kept_id, title, media_name FROM by_title WHERE rn > 1""",
)
def _(spark, sf_dir):
    found = J.quotes(articles(spark, sf_dir), MONTH)["duplicates"]
    return found.select("id", "kept_id", "title", "media_name")


@query(
    "job_query_summary",
    f"""{_BY_TITLE}
SELECT count(*) FILTER (rn = 1) AS story_count, count(*) AS total_stories,
  count(*) FILTER (rn > 1) AS duplicates, 'title' AS strategy FROM by_title""",
)
def _(spark, sf_dir):
    summary = J.quotes(articles(spark, sf_dir), MONTH)["query_summary"]
    return summary.select(
        "story_count",
        "total_stories",
        F.col("dedup_summary.duplicate_story_count").alias("duplicates"),
        F.col("dedup_summary.strategy").alias("strategy"),
    )


@query(
    "job_full_text_all",
    f"""{_BY_SOURCE}
SELECT id, title, text, url, media_name FROM unique_stories""",
)
def _(spark, sf_dir):
    everything = ArticleQuery(dedup_strategy="title_source")
    return J.full_text(articles(spark, sf_dir), everything)["stories"].select(
        "id", "title", "text", "url", "media_name"
    )


@query(
    "job_full_text",
    f"""WITH {ARTICLES},
hits AS (SELECT * FROM articles WHERE list_contains({toks('text')}, 'the') OR list_contains({toks('title')}, 'the')),
sampled AS (SELECT * FROM hits ORDER BY md5('11:' || id), ingest_seq LIMIT 200),
{dedup_cte("sampled", *BY_TITLE_SOURCE, "ranked")}
SELECT id, title, text, url, media_name FROM ranked WHERE rn = 1""",
)
def _(spark, sf_dir):
    wanted = ArticleQuery(
        terms=SearchTerms(all_of=("the",)),
        dedup_strategy="title_source",
        randomized=True,
        seed=11,
        max_articles=200,
    )
    return J.full_text(articles(spark, sf_dir), wanted)["stories"].select(
        "id", "title", "text", "url", "media_name"
    )


@query(
    "job_summaries",
    f"""{_BY_TITLE}, summary_input AS (SELECT ingest_seq, language, text, 'tion' AS focus FROM stories), {SUMMARY_CTE}
SELECT ingest_seq, title, confident AS llm_summary_is_confident, coalesce(summary_text, 'none') AS llm_summary_text
FROM summary JOIN stories USING (ingest_seq)""",
)
def _(spark, sf_dir):
    return J.summaries(articles(spark, sf_dir), MONTH, "tion")["stories"].select(
        "ingest_seq",
        "title",
        "llm_summary_is_confident",
        F.coalesce("llm_summary_text", F.lit("none")).alias("llm_summary_text"),
    )


@query(
    "job_quotes",
    f"""{_BY_TITLE}, {quotes_cte("stories")}
SELECT id, title, media_name, quote, speaker, pronoun FROM attributed""",
)
def _(spark, sf_dir):
    found = J.quotes(articles(spark, sf_dir), MONTH)["quotes"]
    return found.select("id", "title", "media_name", "quote", "speaker", "pronoun")


_ABOUT = AboutnessParams(target=TARGET, kind="topic", threshold=0.5)
_MONTH_ABOUT = f"{_BY_TITLE}, about_input AS (SELECT * FROM stories), {ABOUT_CTE}"


@query(
    "job_aboutness_filter",
    f"""{_MONTH_ABOUT}
SELECT id, title, about_score, about_is_about, about_reason FROM about WHERE about_is_about AND about_score >= 0.5""",
)
def _(spark, sf_dir):
    outputs = J.aboutness_filter(articles(spark, sf_dir), MONTH, _ABOUT)
    return outputs["stories"].select(
        "id", "title", "about_score", "about_is_about", "about_reason"
    )


@query("job_aboutness_filter_summary", f"{_MONTH_ABOUT}, {BIN_COUNTS} {SUMMARY_SQL}")
def _(spark, sf_dir):
    outputs = J.aboutness_filter(articles(spark, sf_dir), MONTH, _ABOUT)
    return shown_summary(outputs["filter_summary"])


@query(
    "job_zeroshot",
    f"""{_BY_TITLE}, {label_cte("stories")},
tagged AS (SELECT ingest_seq, '[' || string_agg('"' || label || '"', ',' ORDER BY rank) || ']' AS labels,
   '[' || coalesce(string_agg('"' || label || '"', ',' ORDER BY pos) FILTER (score >= 0.4), '') || ']' AS passing,
   max(label) FILTER (rank = 1) AS top, max(score) FILTER (rank = 1) AS top_score FROM ranked GROUP BY 1)
SELECT id AS story_id, title, media_name, labels AS zeroshot_labels_json, passing AS zeroshot_labels_selected_json,
       top AS zeroshot_top_label, top_score AS zeroshot_top_score FROM stories JOIN tagged USING (ingest_seq)""",
)
def _(spark, sf_dir):
    labels = LabelParams(labels=LABELS, hypotheses=HYPOTHESES, score_threshold=0.4)
    return J.zero_shot(articles(spark, sf_dir), MONTH, labels)["stories"].select(
        "story_id",
        "title",
        "media_name",
        "zeroshot_labels_json",
        "zeroshot_labels_selected_json",
        "zeroshot_top_label",
        "zeroshot_top_score",
    )


_PASSED = f"""{_MONTH_ABOUT},
passed AS (SELECT * FROM about WHERE about_is_about AND about_score >= 0.5),
{label_cte("passed")},
tagged AS (SELECT ingest_seq, string_agg(label, '; ' ORDER BY rank) FILTER (rank <= 2) AS tags,
   '[' || string_agg('"' || label || '"', ',' ORDER BY rank) FILTER (rank <= 2) || ']' AS tag_json FROM ranked GROUP BY 1)"""


def _tagged(spark, sf_dir):
    labels = LabelParams(labels=LABELS, hypotheses=HYPOTHESES, top_n=2, score_threshold=0.9)
    return J.tagged_summaries(articles(spark, sf_dir), MONTH, _ABOUT, labels)


@query(
    "job_tagged_summaries",
    f"""{_PASSED},
summary_input AS (SELECT ingest_seq, language, text, '{TARGET} ' || tags AS focus FROM passed JOIN tagged USING (ingest_seq)),
{SUMMARY_CTE}
SELECT CAST(id AS VARCHAR) AS story_id, title, url, CAST(publish_date AS VARCHAR) AS publish_date, media_name, language,
  about_score, about_is_about, about_reason, 'none' AS about_error, coalesce(summary_text, 'none') AS llm_summary_text,
  confident AS llm_summary_is_confident, 'none' AS llm_summary_error, tag_json AS "zero-shot-tags", '' AS zeroshot_error
FROM passed JOIN tagged USING (ingest_seq) JOIN summary USING (ingest_seq)""",
)
def _(spark, sf_dir):
    stories = _tagged(spark, sf_dir)["stories"]
    none = F.lit("none")
    return stories.withColumns(
        {
            "publish_date": F.col("publish_date").cast("string"),
            "about_error": F.coalesce("about_error", none),
            "llm_summary_text": F.coalesce("llm_summary_text", none),
            "llm_summary_error": F.coalesce("llm_summary_error", none),
        }
    ).drop("zero-shot-tag-scores")


@query(
    "job_tagged_label_counts",
    f"""{_PASSED}
SELECT count(DISTINCT ingest_seq) AS stories_classified, (SELECT string_agg(CAST(n AS VARCHAR), '|' ORDER BY pos) FROM
  (SELECT label.pos, count(r.ingest_seq) AS n FROM label LEFT JOIN ranked r ON r.pos = label.pos AND r.rank <= 2
   GROUP BY 1)) AS label_counts, 'top_n' AS distribution_mode FROM ranked""",
)
def _(spark, sf_dir):
    found = _tagged(spark, sf_dir)["label_summary"]
    return found.select(
        "stories_classified",
        F.array_join(F.col("label_counts").cast("array<string>"), "|").alias("label_counts"),
        "distribution_mode",
    )
