"""Counting, histograms and one-row summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.constants import DEFAULT_MODEL, MODEL_PRICES, SCORE_BINS
from storylake.params import ArticleQuery
from storylake.schema import require_columns


def top_values(df: DataFrame, column: str, top_n: int = 10) -> DataFrame:
    """Most frequent values; a list counts each of its distinct elements once per row.

    Ties are broken by value.  ``top_n`` below 1 gives an empty table.
    """
    require_columns(df, column)
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.ArrayType):
        value = F.explode(F.array_distinct(value))
    counts = (
        df.select(value.alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if dict(counts.dtypes)["value"] in ("double", "float"):
        counts = counts.filter(~F.isnan("value"))
    return counts.orderBy(F.desc("count"), F.asc("value")).limit(max(top_n, 0))


def top_entities(
    df: DataFrame,
    entities_column: str = "entities",
    top_n: int = 10,
    filter_type: str | None = None,
    sort_by: str = "total",
) -> DataFrame:
    """Most frequent entities by total mentions or by share of articles.

    The share is taken over all rows, also those without entities.  ``top_n`` below 1 gives
    every entity.  The type is the most frequent one of the entity (ties: alphabetical).
    """
    require_columns(df, entities_column)
    if sort_by not in ("total", "percentage"):
        raise ValueError(f"sort_by must be 'total' or 'percentage', got {sort_by!r}")
    entities = F.filter(F.col(entities_column), lambda e: e["text"].isNotNull())
    if filter_type:
        entities = F.filter(entities, lambda e: e["type"] == filter_type)
    # Sorted, equal names are neighbours, so an entity's first mention in its article is told by
    # the one before it.  One aggregation then counts mentions and articles, and article ids
    # are never shuffled.
    pairs = F.transform(
        entities, lambda e: F.struct(e["text"].alias("entity"), e["type"].alias("type"))
    )
    mentions = df.select(F.array_sort(pairs).alias("_pairs")).select(
        F.explode(
            F.transform(
                "_pairs",
                lambda e, at: F.struct(
                    e["entity"].alias("entity"),
                    e["type"].alias("type"),
                    (
                        (at == 0) | (e["entity"] != F.get("_pairs", at - 1)["entity"])
                    ).cast("long").alias("first"),
                ),
            )
        ).alias("m")
    )
    by_type = mentions.groupBy("m.entity", "m.type").agg(
        F.count(F.lit(1)).alias("mentions"), F.sum("m.first").alias("articles")
    )
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = (
        by_type.groupBy("entity")
        .agg(
            F.min(F.struct((-F.col("mentions")).alias("rank"), "type"))["type"].alias("type"),
            F.sum("mentions").alias("count"),
            F.sum("articles").alias("document_count"),
        )
        .select(
            "entity",
            "type",
            "count",
            (F.col("document_count") / total * 100).alias("appearance_percent"),
            "document_count",
        )
    )
    measure = "count" if sort_by == "total" else "document_count"
    ranked = ranked.orderBy(F.desc(measure), F.asc("entity"))
    return ranked.limit(top_n) if top_n > 0 else ranked


def score_bin(score: Column) -> Column:
    """Index of the bin ``(i/10, (i+1)/10]`` that holds a score; 0 falls in bin 0.

    Scores outside 0..1 and null have no bin.
    """
    bin_index = F.lit(None).cast("int")
    for i in reversed(range(SCORE_BINS)):
        bin_index = F.when(score <= F.lit((i + 1) / SCORE_BINS), F.lit(i)).otherwise(bin_index)
    return F.when(score >= 0, bin_index)


def score_histogram(df: DataFrame, score_column: str = "about_score") -> DataFrame:
    """Ten rows ``bin, lower, upper, count``, zero bins included."""
    require_columns(df, score_column)
    counts = (
        df.select(score_bin(F.col(score_column)).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bins = df.sparkSession.range(SCORE_BINS).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("bin") / SCORE_BINS).alias("lower"),
        ((F.col("bin") + 1) / SCORE_BINS).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def price_table(df: DataFrame) -> DataFrame:
    rows = [(name, i, o) for name, (i, o) in MODEL_PRICES.items()]
    return df.sparkSession.createDataFrame(rows, "model string, price_in double, price_out double")


def usage_cost(
    df: DataFrame,
    usage_column: str = "usage",
    model: str = DEFAULT_MODEL,
    provider: str = "groq",
) -> DataFrame:
    """One row of request, token and cost totals.

    Rows without a usage record (failed calls) do not count; a model without a known price
    has null costs.
    """
    require_columns(df, usage_column)
    usage = F.col(usage_column)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(usage[f"{name}_tokens"]), F.lit(0).cast("long"))

    totals = df.agg(
        F.count(usage).alias("total_requests"),
        total("prompt").alias("total_prompt_tokens"),
        total("completion").alias("total_completion_tokens"),
        total("total").alias("total_tokens"),
    ).withColumn("model", F.lit(model))
    cost_in = F.col("total_prompt_tokens") / 1_000_000.0 * F.col("price_in")
    cost_out = F.col("total_completion_tokens") / 1_000_000.0 * F.col("price_out")
    return totals.join(F.broadcast(price_table(df)), "model", "left").select(
        F.lit(provider).alias("provider"),
        "model",
        "total_requests",
        "total_prompt_tokens",
        "total_completion_tokens",
        "total_tokens",
        F.col("price_in").alias("price_per_million_input_usd"),
        F.col("price_out").alias("price_per_million_output_usd"),
        cost_in.alias("total_input_cost_usd"),
        cost_out.alias("total_output_cost_usd"),
        (cost_in + cost_out).alias("total_cost_usd"),
    )


def query_summary(
    articles: DataFrame, query: ArticleQuery, dedup: DataFrame | None = None
) -> DataFrame:
    """One row describing a query; ``story_count`` is taken after deduplication.

    With the query's deduplication record the counts come from that, ``total_stories`` is the
    count before, and the record itself is ``dedup_summary``.
    """
    if dedup is None:
        counts = articles.agg(F.count(F.lit(1)).alias("story_count"))
        more: list[Column] = []
    else:
        counts = dedup.select(
            F.col("deduplicated_story_count").alias("story_count"),
            F.col("input_story_count").alias("total_stories"),
            F.struct(*dedup.columns).alias("dedup_summary"),
        )
        more = [F.col("total_stories"), F.col("dedup_summary")]
    return counts.select(
        F.lit(query.terms.describe()).alias("query"),
        F.lit(query.start_date).cast("date").alias("start_date"),
        F.lit(query.end_date).cast("date").alias("end_date"),
        F.array(*[F.lit(i) for i in query.collection_ids]).cast("array<int>").alias(
            "collection_ids"
        ),
        F.array(*[F.lit(s) for s in query.sources]).cast("array<string>").alias("source_ids"),
        "story_count",
        F.lit(query.dedup_strategy.value).alias("dedup_strategy"),
        *more,
    )
