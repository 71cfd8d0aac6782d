"""Limits and sampling under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storylake.schema import ROW_KEY, require_columns
from storylake.session import materialize

def first_by(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows under ``order``, which must be total.

    The sort columns alone are written, so that what finds the range bounds does not read the
    input again, then dealt out by range and written once more; ranges before the cut are taken
    whole, and only rows of the range that holds the cut are ranked.  Neither text nor all keys
    pass through one task, whatever ``n`` is.  The keys that are taken are a table too: Spark
    knows its size, and moves the input only where it is too large for a broadcast.
    """
    names = [f"_o{i}" for i in range(len(order))]
    in_order = [F.col(name).asc_nulls_last() for name in names]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = materialize(
        df.select(ROW_KEY, *[term.alias(name) for name, term in zip(names, order)]), "sort-keys"
    )
    dealt = materialize(
        keys.repartitionByRange(ranges, *in_order).withColumn("_range", F.spark_partition_id()),
        "ordered-keys",
    )
    # One row per range.
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("size")).collect()
    cut, left = 0, n
    for part in sorted(sizes):
        cut = part["_range"]
        if part["size"] > left:
            break
        cut, left = cut + 1, left - part["size"]
    whole = dealt.filter(F.col("_range") < cut).select(ROW_KEY)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*in_order))
    some = (
        dealt.filter(F.col("_range") == cut)
        .withColumn("_rank", inside)
        .filter(F.col("_rank") <= left)
        .select(ROW_KEY)
    )
    taken = materialize(whole.union(some), "taken-keys")
    return df.join(taken, ROW_KEY, "left_semi").select(*df.columns)


def limit_before_dedup(df: DataFrame, max_articles: int) -> DataFrame:
    """First articles in input order; 0 means no limit."""
    require_columns(df, ROW_KEY)
    if max_articles <= 0:
        return df
    return first_by(df, [F.col(ROW_KEY)], max_articles)


def limit_after_dedup(df: DataFrame, max_stories: int | None) -> DataFrame:
    """Earliest articles: publish date (nulls last), then input order; None or <= 0: all."""
    require_columns(df, ROW_KEY)
    if max_stories is None or max_stories <= 0:
        return df
    order = [F.col("publish_date")] if "publish_date" in df.columns else []
    return first_by(df, [*order, F.col(ROW_KEY)], max_stories)


def random_sample(df: DataFrame, n: int, seed: int = 0, id_column: str = "id") -> DataFrame:
    """Random articles that are the same on every run and every engine for one seed."""
    require_columns(df, ROW_KEY, id_column)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    if n <= 0:
        return df
    return first_by(df, [key, F.col(ROW_KEY)], n)
