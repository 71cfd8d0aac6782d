"""Article table: declared schema, name resolution and column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: One row per article.  ``ingest_seq`` is the explicit input order; it breaks every tie
#: that row position would break in an in-memory table.
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("ingest_seq", T.LongType(), False),
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("media_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("publish_date", T.DateType()),
    ]
)

#: Key that identifies one input row in every operator.
ROW_KEY = "ingest_seq"

ID_ALIASES = ("story_id", "stories_id")


def canonical_id(df: DataFrame) -> DataFrame:
    """Resolve the three names in use for the article id to ``id``."""
    if "id" in df.columns:
        return df
    for alias in ID_ALIASES:
        if alias in df.columns:
            return df.withColumnRenamed(alias, "id")
    raise ValueError(f"no id column among {df.columns}")


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available columns: {df.columns}")
