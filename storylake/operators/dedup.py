"""Duplicate removal.

A group of copies may hold a large part of the table, so rows are never collected by group.
Keeping the first row of each group is a rank filter, which the planner applies in every map
task before the shuffle: one scan, one shuffle, and at most one row per group and task moves.
Everything about dropped rows starts from an aggregation over narrow columns, which combines on
the map side as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storylake.functions.text import hash_text, normalize_text
from storylake.operators.skew import HOT_GROUP_ROWS, attach_group_facts
from storylake.params import DedupStrategy
from storylake.schema import ROW_KEY, require_columns

TITLE_KEY = "dedup_norm_title"
TEXT_KEY = "dedup_text_hash"


def article_keys(
    df: DataFrame,
    by_title: bool = True,
    by_text: bool = False,
    title_column: str = "title",
    text_column: str = "text",
) -> dict[str, Column]:
    """Key columns of normalised deduplication; null stays a group of its own."""
    keys: dict[str, Column] = {}
    if by_title and title_column in df.columns:
        title = F.col(title_column)
        keys[TITLE_KEY] = F.when(title.isNotNull(), normalize_text(title))
    if by_text and text_column in df.columns:
        text = F.col(text_column)
        keys[TEXT_KEY] = F.when(text.isNotNull(), hash_text(text))
    return keys


def exact_keys(*columns: str) -> dict[str, Column]:
    return {name: F.col(name) for name in columns}


def strategy_keys(df: DataFrame, strategy: DedupStrategy) -> tuple[dict[str, Column], bool]:
    """Key columns of a strategy and whether the earliest date wins."""
    if strategy is DedupStrategy.TITLE:
        return article_keys(df), True
    if strategy is DedupStrategy.TITLE_SOURCE:
        require_columns(df, "title", "media_name")
        return exact_keys("title", "media_name"), False
    return {}, False


def duplicate_groups(
    df: DataFrame,
    keys: dict[str, Column],
    earliest: bool = True,
    date_column: str = "publish_date",
    id_column: str = "id",
) -> DataFrame:
    """One row per group: its keys, its size, and the key and id of the row that is kept."""
    require_columns(df, ROW_KEY)
    order: list[Column] = []
    if earliest and date_column in df.columns:
        order = [F.col(date_column).isNull().alias("undated"), F.col(date_column).alias("date")]
    order.append(F.col(ROW_KEY).alias("seq"))
    kept_id = F.col(id_column) if id_column in df.columns else F.lit(None).cast("string")
    narrow = df.select(
        *[column.alias(name) for name, column in keys.items()],
        F.struct(*order, kept_id.alias("id")).alias("_row"),
    )
    return (
        narrow.groupBy(*keys)
        .agg(F.min("_row").alias("_kept"), F.count(F.lit(1)).alias("group_size"))
        .select(
            *keys,
            F.col("_kept.seq").alias("kept_seq"),
            F.col("_kept.id").alias("kept_id"),
            "group_size",
        )
    )


def keep_first(
    df: DataFrame,
    keys: dict[str, Column],
    earliest: bool = True,
    date_column: str = "publish_date",
) -> DataFrame:
    """The kept row of every group, with the input columns."""
    if not keys:
        return df
    require_columns(df, ROW_KEY)
    order = [F.col(ROW_KEY)]
    if earliest and date_column in df.columns:
        order.insert(0, F.col(date_column).asc_nulls_last())
    first = F.row_number().over(Window.partitionBy(*keys.values()).orderBy(*order))
    return df.withColumn("_rank", first).filter(F.col("_rank") == 1).select(*df.columns)


def dropped_rows(df: DataFrame, keys: dict[str, Column], earliest: bool = True) -> DataFrame:
    """The rows that :func:`keep_first` leaves out."""
    if not keys:
        return df.limit(0)
    return duplicate_mapping(df, keys, earliest).select(*df.columns)


def duplicate_mapping(
    df: DataFrame,
    keys: dict[str, Column],
    earliest: bool = True,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Dropped rows with their key columns and the id of the row kept in their place."""
    if not keys:
        return df.limit(0).withColumn("kept_id", F.lit(None).cast("string"))
    groups = duplicate_groups(df, keys, earliest).filter("group_size > 1")
    rows = df.withColumns(keys)
    mapped = attach_group_facts(
        rows, groups, list(keys), ["kept_seq", "kept_id"], "group_size", ROW_KEY, hot_rows
    )
    mapped = mapped.filter(F.col("kept_seq") != F.col(ROW_KEY)).drop("kept_seq")
    return mapped if "id" in df.columns else mapped.drop("kept_id")


def deduplicate(
    df: DataFrame, strategy: DedupStrategy | str = DedupStrategy.TITLE
) -> DataFrame:
    """Apply a named strategy: none, title, or title and source."""
    keys, earliest = strategy_keys(df, DedupStrategy(strategy))
    return keep_first(df, keys, earliest)


def dedup_summary(df: DataFrame, strategy: DedupStrategy | str) -> DataFrame:
    """One row: input, kept and dropped counts.  Reads key columns only."""
    strategy = DedupStrategy(strategy)
    keys, _ = strategy_keys(df, strategy)
    if keys:
        sizes = df.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(
            F.count(F.lit(1)).alias("group_size")
        )
        counts = sizes.agg(
            F.coalesce(F.sum("group_size"), F.lit(0)).alias("input_story_count"),
            F.count(F.lit(1)).alias("deduplicated_story_count"),
        )
    else:
        counts = df.agg(F.count(F.lit(1)).alias("input_story_count")).withColumn(
            "deduplicated_story_count", F.col("input_story_count")
        )
    return counts.select(
        "input_story_count",
        "deduplicated_story_count",
        (F.col("input_story_count") - F.col("deduplicated_story_count")).alias(
            "duplicate_story_count"
        ),
        F.lit(strategy.value).alias("strategy"),
    )
