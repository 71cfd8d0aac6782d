"""Export shapes, CSV output and the record of what was written."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.constants import TAGGED_SUMMARY_COLUMNS
from storylake.session import new_output_path

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("object_key", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("columns_saved", T.ArrayType(T.StringType())),
        T.StructField("row_count", T.LongType()),
    ]
)


def drop_text(df: DataFrame, text_column: str = "text") -> DataFrame:
    """The table without the article text; a table that has none is left as it is."""
    return df.drop(text_column)


def contract_columns(
    df: DataFrame, contract: list[tuple[str, str]] = TAGGED_SUMMARY_COLUMNS
) -> DataFrame:
    """Exactly the contract's columns in its order; missing ones are null."""
    if "story_id" not in df.columns and "id" in df.columns:
        df = df.withColumnRenamed("id", "story_id")
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{name}`") if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in contract
        ]
    )


def object_key(name: str, today: date | None = None) -> str:
    """Key of an export: ``DATE`` becomes the ISO date and leading slashes go."""
    return name.replace("DATE", (today or date.today()).isoformat()).lstrip("/")


@dataclass(frozen=True)
class Written:
    """Where an export went and its one-row manifest."""

    path: str
    manifest: DataFrame


def _csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV has no nested values."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(f"`{field.name}`").alias(field.name)
            if isinstance(field.dataType, nested)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, name: str, root: str | None = None) -> Written:
    """Write CSV part files with a header and count the rows in the same job.

    Each run writes below a fresh path, so nothing has to be probed or overwritten.
    """
    spark = df.sparkSession
    key = object_key(name)
    base = f"{root.rstrip('/')}/{key}" if root else new_output_path(spark, key.replace("/", "_"))
    seen = Observation()
    ready = _csv_ready(df).observe(seen, F.count(F.lit(1)).alias("row_count"))
    (
        ready.write.mode("errorifexists")
        .option("header", True)
        .option("lineSep", "\n")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("emptyValue", '""')
        # White space at the ends of a value is part of the value.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(base)
    )
    row = (base, key, "csv", df.columns, int(seen.get["row_count"]))
    return Written(base, spark.createDataFrame([row], MANIFEST_SCHEMA))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back under a declared schema."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("lineSep", "\n")
        .option("quote", '"')
        .option("escape", '"')
        # An unquoted empty field is null, a quoted one is the empty string.
        .option("nullValue", "\x00")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
