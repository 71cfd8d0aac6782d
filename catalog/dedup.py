"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ARTICLES, BY_TITLE, BY_TITLE_SOURCE, articles, dedup_cte, norm, query, text_of
from storylake.operators import dedup as D
from storylake.params import DedupStrategy

_HASH = f"CASE WHEN {norm('text')} = '' THEN '' ELSE md5({norm('text')}) END"
_KEEP = "SELECT id, title, CAST(publish_date AS VARCHAR) AS publish_date FROM ranked WHERE rn = 1"


def _ranked(keys: str, order: str) -> str:
    return f"WITH {ARTICLES}, {dedup_cte('articles', keys, order, 'ranked')}"


def _shown(df):
    return df.select("id", "title", *text_of("publish_date"))


@query("dedup_title_source", f"{_ranked(*BY_TITLE_SOURCE)} {_KEEP}")
def _(spark, sf_dir):
    return _shown(D.deduplicate(articles(spark, sf_dir), DedupStrategy.TITLE_SOURCE))


@query("dedup_title", f"{_ranked(*BY_TITLE)} {_KEEP}")
def _(spark, sf_dir):
    return _shown(D.deduplicate(articles(spark, sf_dir), DedupStrategy.TITLE))


@query("dedup_text", f"{_ranked(_HASH, BY_TITLE[1])} {_KEEP}")
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    return _shown(D.keep_first(df, D.article_keys(df, by_title=False, by_text=True)))


@query("dedup_title_text", f"{_ranked(norm('title') + ', ' + _HASH, BY_TITLE[1])} {_KEEP}")
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    return _shown(D.keep_first(df, D.article_keys(df, by_title=True, by_text=True)))


@query("dedup_first_seen", f"{_ranked(norm('title'), 'ingest_seq')} {_KEEP}")
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    return _shown(D.keep_first(df, D.article_keys(df), earliest=False))


@query(
    "dedup_dropped",
    f"{_ranked(*BY_TITLE)} SELECT id, title FROM ranked WHERE rn > 1",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    return D.dropped_rows(df, D.article_keys(df)).select("id", "title")


@query(
    "dedup_mapping",
    f"""{_ranked(*BY_TITLE)}
SELECT id, title, {norm('title')} AS dedup_norm_title, kept_id FROM ranked WHERE rn > 1""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    mapped = D.duplicate_mapping(df, D.article_keys(df))
    return mapped.select("id", "title", "dedup_norm_title", "kept_id")


@query(
    "dedup_mapping_title_text",
    f"""{_ranked(norm('title') + ', ' + _HASH, BY_TITLE[1])}
SELECT id, {_HASH} AS dedup_text_hash, kept_id FROM ranked WHERE rn > 1""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    mapped = D.duplicate_mapping(df, D.article_keys(df, by_title=True, by_text=True))
    return mapped.select("id", "dedup_text_hash", "kept_id")


@query("dedup_strategy_none", f"WITH {ARTICLES} SELECT id, title FROM articles")
def _(spark, sf_dir):
    return D.deduplicate(articles(spark, sf_dir), "none").select("id", "title")


def _summary_sql(strategy: str, keys: str) -> str:
    return f"""SELECT count(*) AS input_story_count,
  count(DISTINCT ({keys})) AS deduplicated_story_count,
  count(*) - count(DISTINCT ({keys})) AS duplicate_story_count, '{strategy}' AS strategy
FROM articles"""


@query(
    "dedup_summary",
    f"""WITH {ARTICLES}
{_summary_sql('title', norm('title'))}
UNION ALL
{_summary_sql('title_source', "title || chr(1) || media_name")}""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    return D.dedup_summary(df, "title").unionByName(D.dedup_summary(df, "title_source"))


@query(
    "side_output_dups",
    f"""{_ranked(*BY_TITLE)},
drops AS (SELECT * FROM ranked WHERE rn > 1)
SELECT strategy, count(*) AS dropped, count(DISTINCT kept_id) AS kept FROM
  (SELECT 'title' AS strategy, kept_id FROM drops) GROUP BY strategy""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    written = _write_and_read(D.duplicate_mapping(df, D.article_keys(df)).select("id", "kept_id"))
    return written.groupBy(F.lit("title").alias("strategy")).agg(
        F.count(F.lit(1)).alias("dropped"), F.countDistinct("kept_id").alias("kept")
    )


def _write_and_read(df):
    """Write a side output as CSV and read it back."""
    from storylake.sources.exports import read_csv, write_csv

    written = write_csv(df, "side-output")
    return read_csv(df.sparkSession, written.path, df.schema)
