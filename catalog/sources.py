"""Scans, batches and sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.base import ARTICLES, BY_TITLE_SOURCE, articles, dedup_cte, query, toks
from storylake.operators.aboutness import score_aboutness
from storylake.params import ArticleQuery, DedupStrategy, SearchTerms
from storylake.sources.articles import batch_union, scan_articles
from storylake.sources.exports import contract_columns, drop_text, read_csv, write_csv


@query(
    "article_scan",
    f"""WITH {ARTICLES},
hits AS (SELECT * FROM articles WHERE publish_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
         AND media_name IN ('src1', 'src2', 'src3', 'src4') AND list_contains({toks('text')}, 'the')),
{dedup_cte("hits", BY_TITLE_SOURCE[0], BY_TITLE_SOURCE[1], "ranked")}
SELECT id, title, text, url, media_name, language, CAST(publish_date AS VARCHAR) AS publish_date
FROM ranked WHERE rn = 1""",
)
def _(spark, sf_dir):
    wanted = ArticleQuery(
        terms=SearchTerms(all_of=("the",)),
        start_date=date(2024, 1, 3),
        end_date=date(2024, 1, 28),
        sources=("src1", "src2", "src3", "src4"),
        dedup_strategy=DedupStrategy.TITLE_SOURCE,
    )
    stories, _dedup = scan_articles(articles(spark, sf_dir), wanted)
    shown = stories.withColumn("publish_date", F.col("publish_date").cast("string"))
    return shown.drop("ingest_seq")


@query(
    "batch_union",
    f"""WITH {ARTICLES},
numbered AS (SELECT *, id % 3 AS b FROM articles)
SELECT row_number() OVER (ORDER BY b, id) - 1 AS ingest_seq, id,
       CASE WHEN b = 1 THEN 'none' ELSE url END AS url, CASE WHEN b = 2 THEN language ELSE 'none' END AS language
FROM numbered""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)

    def batch(b: int, *columns: str):
        part = df.filter(F.col("id") % 3 == b)
        return part.select(F.floor(F.col("id") / 3).alias("position"), "id", *columns)

    union = batch_union([batch(0, "url"), batch(1), batch(2, "url", "language")])
    return union.select(
        "ingest_seq",
        "id",
        F.coalesce("url", F.lit("none")).alias("url"),
        F.coalesce("language", F.lit("none")).alias("language"),
    )


@query(
    "csv_roundtrip",
    f"""WITH {ARTICLES}
SELECT id, title, text, url, CAST(publish_date AS VARCHAR) AS publish_date FROM articles""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir).select("id", "title", "text", "url", "publish_date")
    written = write_csv(df, "/articles/DATE/all.csv")
    back = read_csv(spark, written.path, df.schema)
    return back.withColumn("publish_date", F.col("publish_date").cast("string"))


@query(
    "export_manifest",
    f"""WITH {ARTICLES}
SELECT 'csv' AS file_type, 'id|title|language' AS columns_saved, count(*) AS row_count
FROM articles WHERE language = 'fr'""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir).filter("language = 'fr'").select("id", "title", "language")
    manifest = write_csv(df, "french.csv").manifest
    return manifest.select(
        "file_type", F.array_join("columns_saved", "|").alias("columns_saved"), "row_count"
    )


@query(
    "drop_text",
    f"""WITH {ARTICLES} SELECT ingest_seq, id, title, url, media_name, language,
CAST(publish_date AS VARCHAR) AS publish_date FROM articles""",
)
def _(spark, sf_dir):
    df = drop_text(drop_text(articles(spark, sf_dir)))
    return df.withColumn("publish_date", F.col("publish_date").cast("string"))


@query(
    "export_contract",
    f"""WITH {ARTICLES}
SELECT CAST(id AS VARCHAR) AS story_id, title, url, CAST(publish_date AS VARCHAR) AS publish_date, media_name,
  language, contains(lower(title), 'the') AS named, count(*) OVER () AS n_rows, 16 AS n_columns,
  true AS tags_missing FROM articles""",
)
def _(spark, sf_dir):
    scored = score_aboutness(articles(spark, sf_dir), "the")
    shown = contract_columns(scored)
    count = len(shown.columns)
    total = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    return shown.select(
        "story_id",
        "title",
        "url",
        F.col("publish_date").cast("string").alias("publish_date"),
        "media_name",
        "language",
        F.contains("about_reason", F.lit("named in the title")).alias("named"),
        total.alias("n_rows"),
        F.lit(count).alias("n_columns"),
        F.col("`zero-shot-tags`").isNull().alias("tags_missing"),
    )
