"""Article tables: file scans, ragged batches and the composed query."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylake.functions.text import first_line
from storylake.operators.dedup import (
    dedup_summary,
    deduplicate,
    duplicate_mapping,
    strategy_keys,
)
from storylake.operators.search import apply_search, filter_date_range, filter_scope
from storylake.operators.selection import limit_before_dedup, random_sample
from storylake.params import ArticleQuery
from storylake.schema import ARTICLE_SCHEMA, ROW_KEY, require_columns

FORMATS = ("parquet", "orc", "json", "csv")


def read_articles(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Scan article files under the declared schema; nothing is inferred.

    Parquet is the format for scale; a CSV file with line feeds in values is one task.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    reader = spark.read.schema(ARTICLE_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True)
        reader = reader.option("quote", '"').option("escape", '"')
    return reader.format(fmt).load(path if isinstance(path, str) else list(path))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Article view of a plain document table ``doc_id, text, lang, source``."""
    require_columns(documents, "doc_id", "text", "lang", "source")
    day = F.pmod(F.col("doc_id") * 7, F.lit(31)).cast("int")
    return documents.select(
        F.col("doc_id").alias(ROW_KEY),
        F.col("doc_id").alias("id"),
        first_line(F.col("text")).alias("title"),
        "text",
        F.concat(
            F.lit("http://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")
        ).alias("url"),
        F.col("source").alias("media_name"),
        F.col("lang").alias("language"),
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("publish_date"),
    )


def batch_union(batches: Sequence[DataFrame], position: str = "position") -> DataFrame:
    """Concatenate ragged batches; missing columns become null and rows are renumbered.

    Each batch numbers its own rows from 0 in ``position``.  The new ``ingest_seq`` is that
    number plus the sizes of the earlier batches, so only one count per batch is moved and
    no row is sorted.
    """
    if not batches:
        raise ValueError("batch_union needs at least one batch")
    tagged = []
    for ordinal, batch in enumerate(batches):
        require_columns(batch, position)
        tagged.append(batch.withColumn("_batch", F.lit(ordinal)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    sizes = [
        batch.agg(F.count(F.lit(1)).alias("size")).withColumn("_sized", F.lit(ordinal))
        for ordinal, batch in enumerate(batches)
    ]
    # One row per batch, and batches are listed by the caller: always small.
    size_table = reduce(DataFrame.unionAll, sizes)
    later = size_table.withColumn(
        "_batch", F.explode(F.sequence(F.col("_sized"), F.lit(len(batches) - 1)))
    )
    offsets = later.groupBy("_batch").agg(
        F.sum(F.when(F.col("_sized") < F.col("_batch"), F.col("size")).otherwise(0)).alias("_start")
    )
    kept = [name for name in rows.columns if name not in ("_batch", position, ROW_KEY)]
    return rows.join(F.broadcast(offsets), "_batch").select(
        (F.col("_start") + F.col(position)).alias(ROW_KEY), *kept
    )


def query_articles(
    articles: DataFrame, query: ArticleQuery, collection_sources: DataFrame | None = None
) -> DataFrame:
    """Articles that match a query before duplicates are removed: predicates, then the cap.

    Cheap column predicates come first, so they reach the file scan before any text test.
    """
    rows = filter_date_range(articles, query.start_date, query.end_date)
    rows = filter_scope(rows, query.sources, query.collection_ids, collection_sources)
    rows = apply_search(rows, query.terms)
    if query.max_articles and query.randomized:
        return random_sample(rows, query.max_articles, query.seed)
    return limit_before_dedup(rows, query.max_articles)


def scan_duplicates(
    articles: DataFrame,
    query: ArticleQuery,
    collection_sources: DataFrame | None = None,
    matched: DataFrame | None = None,
) -> DataFrame:
    """Rows that the query's strategy drops, without their text, with the id kept instead.

    ``matched`` is what :func:`query_articles` gives for the same arguments, if the caller has it.
    """
    if matched is None:
        matched = query_articles(articles, query, collection_sources)
    keys, earliest = strategy_keys(matched, query.dedup_strategy)
    return duplicate_mapping(matched.drop("text"), keys, earliest)


def scan_articles(
    articles: DataFrame,
    query: ArticleQuery,
    collection_sources: DataFrame | None = None,
    matched: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The story table of a query and its one-row deduplication summary; ``matched`` as above."""
    if matched is None:
        matched = query_articles(articles, query, collection_sources)
    return (
        deduplicate(matched, query.dedup_strategy),
        dedup_summary(matched, query.dedup_strategy),
    )
