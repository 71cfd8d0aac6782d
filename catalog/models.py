"""Row functions, model outcomes, aboutness, summaries and sentiment."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import ARTICLES, TOK, articles, query, sentences_cte, stopwords_cte, toks
from storylake.functions.prompts import ABOUTNESS_PROMPT, QUOTES_PROMPT, SUMMARY_PROMPT
from storylake.operators import scoring as S
from storylake.operators.aboutness import aboutness_summary, filter_aboutness, score_aboutness
from storylake.operators.prompted import sentiment_with
from storylake.operators.sentences import matching_sentences, sentence_table, targeted_sentiment
from storylake.operators.summaries import summarize_articles
from storylake.params import AboutnessParams, ArticleQuery
from storylake.plans import jobs as J

_FACTS = T.StructType(
    [T.StructField("text_chars", T.LongType()), T.StructField("opening", T.StringType())]
)
_LINES = T.StructType(
    [T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType())]
)
_SHORT = 400


def _facts(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"text_chars": frame["text"].str.len(), "opening": frame["text"].str.slice(0, 12)}
    )


def _strict_scorer():
    """Fails on short text, so that failures are part of the result."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["text"].str.len()
        if (sizes < _SHORT).any():
            raise ValueError(f"text has {sizes[sizes < _SHORT].iloc[0]} characters")
        return _facts(frame).assign(
            prompt_tokens=sizes, completion_tokens=12, total_tokens=sizes + 12
        )

    return run


def _reporting_scorer():
    """Fails on the same rows, but says so in its result."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["text"].str.len()
        errors = ("ValueError: text has " + sizes.astype(str) + " characters").where(sizes < _SHORT)
        return _facts(frame).assign(
            error=errors, prompt_tokens=sizes, completion_tokens=12, total_tokens=sizes + 12
        )

    return run


def _line_scorer():
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["text"].str.len()
        if (sizes < _SHORT).any():
            raise ValueError("short")
        items = [
            [{"line_no": i, "line": line} for i, line in enumerate(text.split("\n"))]
            for text in frame["text"]
        ]
        return pd.DataFrame({"items": items})

    return run


@query("add_column", f"WITH {ARTICLES} SELECT id, length(text) + length(title) AS chars FROM articles")
def _(spark, sf_dir):
    df = S.add_column(
        articles(spark, sf_dir),
        lambda text, title: text.str.len() + title.str.len(),
        ["text", "title"],
        "chars",
        "long",
    )
    return df.select("id", "chars")


@query(
    "add_columns",
    f"WITH {ARTICLES} SELECT id, length(text) AS text_chars, substr(text, 1, 12) AS opening FROM articles",
)
def _(spark, sf_dir):
    df = S.add_columns(articles(spark, sf_dir), _facts, ["text"], _FACTS)
    return df.select("id", "text_chars", "opening")


@query(
    "model_map_one",
    f"""WITH {ARTICLES}
SELECT id, CASE WHEN length(text) >= {_SHORT} THEN length(text) ELSE -1 END AS text_chars,
  CASE WHEN length(text) >= {_SHORT} THEN substr(text, 1, 12) ELSE 'none' END AS opening,
  CASE WHEN length(text) >= {_SHORT} THEN 'none'
       ELSE 'ValueError: text has ' || length(text) || ' characters' END AS llm_error
FROM articles""",
)
def _(spark, sf_dir):
    df = S.model_map_one(articles(spark, sf_dir), _strict_scorer, ["text"], _FACTS)
    return df.select(
        "id",
        F.coalesce("text_chars", F.lit(-1)).alias("text_chars"),
        F.coalesce("opening", F.lit("none")).alias("opening"),
        F.coalesce("llm_error", F.lit("none")).alias("llm_error"),
    )


@query(
    "model_map_many",
    f"""WITH {ARTICLES}
SELECT id, media_name, CAST(unnest(range(len(string_split(text, chr(10))))) AS BIGINT) AS line_no,
       unnest(string_split(text, chr(10))) AS line
FROM articles WHERE length(text) >= {_SHORT}""",
)
def _(spark, sf_dir):
    df = S.model_map_many(articles(spark, sf_dir), _line_scorer, ["text"], _LINES)
    return df.select("id", "media_name", "line_no", "line")


@query(
    "model_outcomes",
    f"""WITH {ARTICLES}
SELECT id, CASE WHEN length(text) >= {_SHORT} THEN 'success' ELSE 'failure' END AS status,
  CASE WHEN length(text) >= {_SHORT} THEN 'none'
       ELSE 'ValueError: text has ' || length(text) || ' characters' END AS error,
  CASE WHEN length(text) >= {_SHORT} THEN length(text) + 12 ELSE -1 END AS total_tokens
FROM articles""",
)
def _(spark, sf_dir):
    scored = S.model_outcomes(articles(spark, sf_dir), _reporting_scorer, ["text"], _FACTS)
    return S.outcome_table(scored).select(
        "id",
        "status",
        F.coalesce("error", F.lit("none")).alias("error"),
        F.coalesce("total_tokens", F.lit(-1)).alias("total_tokens"),
    )


TARGET = "rewh"

#: ``about``: every article with its aboutness columns, over a relation ``articles``.
ABOUT_CTE = f"""
about_facts AS (
  SELECT *, CAST((length(text) - length(replace(lower(text), '{TARGET}', ''))) // {len(TARGET)} AS INTEGER) AS k,
         contains(lower(title), '{TARGET}') AS ti, strpos(lower(text), '{TARGET}') AS first_at
  FROM about_input),
about_early AS (SELECT *, first_at > 0 AND first_at <= length(text) / 2.0 AS early FROM about_facts),
about AS (
  SELECT *, round(least(1.0::DOUBLE, 0.5::DOUBLE * ti::INT + 0.15::DOUBLE * least(k, 4)
                 + 0.35::DOUBLE * early::INT), 4) AS about_score,
    ti OR k >= 2 OR (k = 1 AND early) AS about_is_about,
    concat_ws('; ', CASE WHEN ti THEN 'named in the title' END,
      CASE WHEN k > 1 THEN k || ' mentions' WHEN k = 1 THEN 'one mention' ELSE 'no mention in the text' END,
      CASE WHEN early THEN 'first mention in the first half'
           WHEN k > 0 THEN 'first mention in the second half' END) AS about_reason
  FROM about_early)"""

_ABOUT = f"WITH {ARTICLES}, about_input AS (SELECT * FROM articles), {ABOUT_CTE}"


@query("aboutness_scores", f"{_ABOUT} SELECT id, about_score, about_is_about, about_reason FROM about")
def _(spark, sf_dir):
    scored = score_aboutness(articles(spark, sf_dir), TARGET)
    return scored.select("id", "about_score", "about_is_about", "about_reason")


@query(
    "aboutness_filter",
    f"{_ABOUT} SELECT id, about_score FROM about WHERE about_is_about AND about_score >= 0.6",
)
def _(spark, sf_dir):
    scored = score_aboutness(articles(spark, sf_dir), TARGET)
    return filter_aboutness(scored, 0.6).select("id", "about_score")


#: ``bin_counts``: the ten histogram counts of ``about`` as one string.
BIN_COUNTS = """
bin_counts AS (
  SELECT string_agg(CAST(n AS VARCHAR), '|' ORDER BY bin) AS score_histogram_counts FROM (
    SELECT bin, count(about_score) AS n FROM range(10) b(bin) LEFT JOIN about
      ON (about_score > bin / 10.0::DOUBLE AND about_score <= (bin + 1) / 10.0::DOUBLE)
      OR (bin = 0 AND about_score = 0) GROUP BY 1))"""


def shown_summary(df):
    return df.select(
        "total_scored",
        "passed_count",
        "discarded_count",
        "threshold",
        "about_target",
        F.array_join(F.col("score_histogram_counts").cast("array<string>"), "|").alias(
            "score_histogram_counts"
        ),
    )


SUMMARY_SQL = f"""
SELECT count(*) AS total_scored, count(*) FILTER (about_is_about AND about_score >= 0.5) AS passed_count,
  count(*) - count(*) FILTER (about_is_about AND about_score >= 0.5) AS discarded_count,
  0.5::DOUBLE AS threshold, '{TARGET}' AS about_target,
  (SELECT score_histogram_counts FROM bin_counts) AS score_histogram_counts FROM about"""


@query("aboutness_summary", f"{_ABOUT}, {BIN_COUNTS} {SUMMARY_SQL}")
def _(spark, sf_dir):
    scored = score_aboutness(articles(spark, sf_dir), TARGET)
    return shown_summary(aboutness_summary(scored, 0.5, TARGET))


#: ``summary``: article summaries, over ``summary_input`` (ingest_seq, language, text, focus).
SUMMARY_CTE = f"""
{sentences_cte("summary_input", "ssent")},
{stopwords_cte()},
sizes AS (
  SELECT ingest_seq, len({toks("text")}) AS n_tokens,
         coalesce((SELECT max(sentence_total) FROM ssent s WHERE s.ingest_seq = i.ingest_seq), 0) AS n_sent
  FROM summary_input i),
stok AS (
  SELECT ingest_seq, language, sentence_id, unnest({toks("sentence_text")}) AS term FROM ssent),
content AS (
  SELECT t.* FROM stok t LEFT JOIN stopwords s ON s.language = t.language AND s.term = t.term
  WHERE s.term IS NULL),
tf AS (SELECT ingest_seq, term, count(*) AS tf FROM content GROUP BY 1, 2),
weight AS (
  SELECT ingest_seq, sentence_id, sum(tf) / count(*)::DOUBLE AS w FROM content JOIN tf USING (ingest_seq, term)
  GROUP BY 1, 2),
focus_token AS (SELECT DISTINCT ingest_seq, unnest({toks("focus")}) AS term FROM summary_input),
hit AS (
  SELECT ingest_seq, sentence_id, count(DISTINCT term) AS h FROM stok JOIN focus_token USING (ingest_seq, term)
  GROUP BY 1, 2),
best AS (
  SELECT s.ingest_seq, s.sentence_id, s.sentence_text,
    row_number() OVER (PARTITION BY s.ingest_seq
      ORDER BY round(coalesce(w, 0) + coalesce(h, 0), 9) DESC, s.sentence_id) AS rank
  FROM ssent s LEFT JOIN weight USING (ingest_seq, sentence_id) LEFT JOIN hit USING (ingest_seq, sentence_id)),
summary AS (
  SELECT z.ingest_seq, bool_and(z.n_tokens >= 50 AND z.n_sent >= 3) AS confident,
    string_agg(sentence_text, ' ' ORDER BY sentence_id)
      FILTER (rank <= 3 AND z.n_tokens >= 50 AND z.n_sent >= 3) AS summary_text,
    string_agg(sentence_text, '|' ORDER BY rank)
      FILTER (rank BETWEEN 4 AND 6 AND z.n_tokens >= 50 AND z.n_sent >= 3) AS key_points
  FROM sizes z LEFT JOIN best USING (ingest_seq) GROUP BY 1)"""


@query(
    "article_summaries",
    f"""WITH {ARTICLES},
summary_input AS (SELECT ingest_seq, language, text, 'rewh tion ' || media_name AS focus FROM articles),
{SUMMARY_CTE}
SELECT ingest_seq, confident AS llm_summary_is_confident, coalesce(summary_text, 'none') AS llm_summary_text,
       coalesce(key_points, '') AS key_points FROM summary""",
)
def _(spark, sf_dir):
    df = summarize_articles(articles(spark, sf_dir), "rewh tion", tags_column="media_name")
    return df.select(
        "ingest_seq",
        "llm_summary_is_confident",
        F.coalesce("llm_summary_text", F.lit("none")).alias("llm_summary_text"),
        F.array_join("key_points", "|").alias("key_points"),
    )


POSITIVE = ["the", "la", "der", "tion", "ment"]
NEGATIVE = ["of", "de", "und", "re", "nd"]

#: ``sentiment``: over ``mentioned`` (id, sentence_id, sentence_text), target ``th.?tion``.
SENTIMENT_TARGET = "th.?tion"
SENTIMENT_CTE = f"""
located AS (
  SELECT *, len({toks(f"regexp_replace(regexp_extract(sentence_text, '(?is)^(.*?)(?:{SENTIMENT_TARGET})', 1), '{TOK}$', '')")})
            AS target_at
  FROM mentioned WHERE regexp_matches(sentence_text, '(?i){SENTIMENT_TARGET}')),
placed AS (
  SELECT id, sentence_id, target_at, unnest({toks("sentence_text")}) AS term,
         unnest(range(len({toks("sentence_text")}))) AS pos FROM located),
summed AS (
  SELECT id, sentence_id, round(coalesce(sum(
      CASE WHEN term IN ({", ".join(f"'{w}'" for w in POSITIVE)}) THEN 1.0::DOUBLE
           WHEN term IN ({", ".join(f"'{w}'" for w in NEGATIVE)}) THEN -1.0::DOUBLE END
      / (1 + abs(pos - target_at))), 0), 9) AS s FROM placed GROUP BY 1, 2),
sentiment AS (
  SELECT id, sentence_id, CASE WHEN s > 0 THEN 'Positive' WHEN s < 0 THEN 'Negative'
         WHEN s = 0 THEN 'Neutral' ELSE 'none' END AS target_sentiment,
         coalesce(round(abs(s) / (abs(s) + 1), 4), -1) AS target_sentiment_score
  FROM mentioned LEFT JOIN summed USING (id, sentence_id))"""


def shown_sentiment(df):
    return df.select(
        "id",
        "sentence_id",
        F.coalesce("target_sentiment", F.lit("none")).alias("target_sentiment"),
        F.coalesce("target_sentiment_score", F.lit(-1.0)).alias("target_sentiment_score"),
    )


@query(
    "targeted_sentiment",
    f"""WITH {ARTICLES}, {sentences_cte()},
mentioned AS (SELECT id, sentence_id, sentence_text FROM sentences), {SENTIMENT_CTE}
SELECT * FROM sentiment""",
)
def _(spark, sf_dir):
    rows = matching_sentences(articles(spark, sf_dir))
    return shown_sentiment(
        targeted_sentiment(rows, SENTIMENT_TARGET, positive=POSITIVE, negative=NEGATIVE)
    )


#: Stand-in models judge by the length of their prompt and fail on every seventh length.
def _failing(answer):
    def factory():
        def run(frame):
            n = frame["prompt"].str.len()
            error = [f"status {x}" if x % 7 == 3 else None for x in n]
            usage = {"prompt_tokens": n, "completion_tokens": 1, "total_tokens": n + 1}
            return pd.DataFrame(answer(n) | usage | {"error": error})

        return run

    return factory


_SCORED = ArticleQuery()
_SUMMARY_LENGTH = f"length(coalesce(title, '')) + length(coalesce(text, '')) + {len(SUMMARY_PROMPT)} - 26"
_QUOTES_LENGTH = f"length(coalesce(text, '')) + {len(QUOTES_PROMPT)} - 6"
_ABOUT_LENGTH = f"length(coalesce(title, '')) + length(coalesce(text, '')) + 4 + {len(ABOUTNESS_PROMPT)} - 30"


@query(
    "job_aboutness_filter_scored",
    f"""WITH {ARTICLES}, asked AS (SELECT *, {_ABOUT_LENGTH} AS n FROM articles)
SELECT id, CASE WHEN n % 7 <> 3 THEN (n % 10) / 10.0::DOUBLE END AS about_score,
  CASE WHEN n % 7 <> 3 THEN n % 2 = 0 END AS about_is_about,
  CASE WHEN n % 7 = 3 THEN 'status ' || n ELSE 'none' END AS about_error FROM asked""",
)
def _(spark, sf_dir):
    scorer = _failing(lambda n: {"score": n % 10 / 10, "is_about": n % 2 == 0, "reason": "length"})
    about = AboutnessParams(target="tion", threshold=0.5)
    found = J.aboutness_filter(articles(spark, sf_dir), _SCORED, about, scorer=scorer)["scored"]
    return found.select(
        "id", "about_score", "about_is_about", F.coalesce("about_error", F.lit("none")).alias("about_error")
    )


@query(
    "job_summaries_scored",
    f"""WITH {ARTICLES}, asked AS (SELECT *, {_SUMMARY_LENGTH} AS n FROM articles)
SELECT id, CASE WHEN n % 7 <> 3 THEN 's' ELSE 'none' END AS llm_summary_text,
  n % 7 <> 3 AS llm_summary_is_confident,
  CASE WHEN n % 7 = 3 THEN 'status ' || n ELSE 'none' END AS llm_summary_error FROM asked""",
)
def _(spark, sf_dir):
    def answer(n):
        facts = {"summary": "s", "is_confident": True, "confidence_reason": "r"}
        return facts | {"key_points": [["k"]] * len(n)}

    found = J.summaries(articles(spark, sf_dir), _SCORED, scorer=_failing(answer))["stories"]
    return found.select(
        "id",
        F.coalesce("llm_summary_text", F.lit("none")).alias("llm_summary_text"),
        "llm_summary_is_confident",
        F.coalesce("llm_summary_error", F.lit("none")).alias("llm_summary_error"),
    )


@query(
    "job_scored_cost",
    f"""WITH {ARTICLES}, asked AS (SELECT *, {_QUOTES_LENGTH} AS n FROM articles)
SELECT count(*) AS total_requests, CAST(sum(n) AS BIGINT) AS total_prompt_tokens FROM asked WHERE n % 7 <> 3""",
)
def _(spark, sf_dir):
    scorer = _failing(lambda n: {"items": [[] for _ in n]})
    cost = J.quotes(articles(spark, sf_dir), _SCORED, scorer=scorer)["cost"]
    return cost.select("total_requests", "total_prompt_tokens")


@query(
    "job_quotes_scored",
    f"""WITH {ARTICLES}, asked AS (SELECT *, {_QUOTES_LENGTH} AS n FROM articles)
SELECT id, CAST(unnest(range(n % 3)) AS INTEGER) AS quote_id, 'q' AS quote, 'unspecified' AS speaker,
  'she' AS pronoun FROM asked WHERE n % 7 <> 3""",
)
def _(spark, sf_dir):
    scorer = _failing(lambda n: {"items": [[{"quote": "q", "speaker": "", "pronoun": "she"}] * (x % 3) for x in n]})
    found = J.quotes(articles(spark, sf_dir), _SCORED, scorer=scorer)["quotes"]
    return found.select("id", "quote_id", "quote", "speaker", "pronoun")


@query(
    "targeted_sentiment_scored",
    f"""WITH {ARTICLES}, {sentences_cte()},
asked AS (SELECT *, CASE WHEN regexp_matches(sentence_text, '(?i)tion') THEN length(sentence_text) END AS n
          FROM sentences)
SELECT id, sentence_id, CASE WHEN n % 7 <> 3 THEN 'Positive' ELSE 'none' END AS target_sentiment,
  CASE WHEN n % 7 <> 3 THEN round(n / 1000.0::DOUBLE, 4) END AS target_sentiment_score FROM asked""",
)
def _(spark, sf_dir):
    scorer = _failing(lambda n: {"label": "Positive", "score": n / 1000})
    rows = sentence_table(articles(spark, sf_dir))
    return sentiment_with(rows, scorer, "tion").select(
        "id", "sentence_id", F.coalesce("target_sentiment", F.lit("none")).alias("target_sentiment"), "target_sentiment_score"
    )
