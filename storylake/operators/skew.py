"""Placing rows: by article for per-article work, and joins that survive very large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.schema import ROW_KEY


def place_by_article(df: DataFrame) -> DataFrame:
    """Hash-place articles by their unique key for work that explodes their text.

    No partition count is stated: AQE sizes the partitions.  Aggregations, windows and joins
    keyed by article (and more) need no further exchange.
    """
    return df.repartition(ROW_KEY)


#: A group above this size is "hot".  There can be at most (all rows / HOT_GROUP_ROWS) hot
#: groups, each with a key of 128 bits and its facts: 30 000 groups for 30 billion rows.
HOT_GROUP_ROWS = 1_000_000

#: Hot rows need no partner in the shuffle join, so they are spread over this many salts.
SPREAD = 4096


def attach_group_facts(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    facts: Sequence[str],
    size: str,
    spread_by: str,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Left join ``groups`` (one row per key, with its row count in ``size``) to ``rows``.

    Keys are compared null-safe.  Facts of hot groups travel by broadcast; their rows then
    pass through the shuffle join under salts that match nothing, so that no task receives
    a hot group whole.  All other rows meet their group in an ordinary shuffle join, where
    AQE splits what skew is left.
    """
    def digest(names: Sequence[str]) -> Column:
        # Null differs from every text, and a key cannot run into the next one.
        parts = [F.to_json(F.struct(F.col(n).alias("k")), {"ignoreNullFields": "false"}) for n in names]
        return F.md5(F.concat(*parts))

    keyed = groups.select(digest(keys).alias("_group"), F.struct(*facts).alias("_facts"), F.col(size).alias("_size"))
    hot = keyed.filter(F.col("_size") > hot_rows).select(
        F.col("_group").alias("_hot_group"), F.col("_facts").alias("_hot_facts")
    )
    cold = keyed.filter(F.col("_size") <= hot_rows).select(
        F.col("_group").alias("_cold_group"), F.col("_facts").alias("_cold_facts")
    )
    marked = rows.withColumn("_group", digest(keys)).join(
        F.broadcast(hot), F.col("_group") == F.col("_hot_group"), "left"
    )
    # A hot row needs no partner any more: it goes by a salt that no group has.
    salt = F.concat(F.lit("hot "), F.pmod(F.hash(spread_by), F.lit(SPREAD)).cast("string"))
    marked = marked.withColumn(
        "_group", F.when(F.col("_hot_group").isNotNull(), salt).otherwise(F.col("_group"))
    )
    joined = marked.join(cold, F.col("_group") == F.col("_cold_group"), "left")
    return joined.select(
        *rows.columns,
        *[
            F.coalesce(F.col(f"_hot_facts.{fact}"), F.col(f"_cold_facts.{fact}")).alias(fact)
            for fact in facts
        ],
    )
