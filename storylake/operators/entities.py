"""Named entities from capitalised runs, typed by a gazetteer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.schema import ROW_KEY, require_columns

#: One or more capitalised words in a row, not starting inside a word.
ENTITY_RUN = (
    r"(?:^|[^\p{L}\p{N}])(\p{Lu}[\p{L}\p{N}]*(?: \p{Lu}[\p{L}\p{N}]*)*)"
)
OTHER_TYPE = "MISC"

#: A mapping up to this size is an expression, a larger one a table; the result is the same.
INLINE_ENTRIES = 500

#: Copies of each gazetteer entry, so that one very frequent name is joined in many tasks.
NAME_SALTS = 16


def entity_runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY_RUN), F.lit(1))


def _typed(run: Column, known: Column) -> Column:
    """A known run has its type, an unknown run of several words is other, a word is dropped."""
    return F.coalesce(known, F.when(F.instr(run, " ") > 0, F.lit(OTHER_TYPE)))


def extract_entities(
    df: DataFrame, gazetteer: Mapping[str, str] | DataFrame, text_column: str = "text"
) -> DataFrame:
    """Add ``entities array<struct<text,type>>`` in order of appearance, repeats kept.

    A mapping or a gazetteer table (columns ``text``, ``type``) may have any size, and articles
    need no key.  A table is joined: the distinct names of an article meet it, and the planner
    broadcasts it only when its measured size allows.
    """
    require_columns(df, text_column)
    if isinstance(gazetteer, Mapping):
        if len(gazetteer) <= INLINE_ENTRIES:
            return df.withColumn("entities", _inline_entities(F.col(text_column), gazetteer))
        entries = list(gazetteer.items())
        gazetteer = df.sparkSession.createDataFrame(entries, "text string, type string")
    return _joined_entities(df, gazetteer, text_column)


def _inline_entities(text: Column, gazetteer: Mapping[str, str]) -> Column:
    runs = F.coalesce(entity_runs(text), F.array().cast("array<string>"))
    if gazetteer:
        pairs = [F.lit(part) for entry in gazetteer.items() for part in entry]
        table = F.create_map(*pairs)

        def known(run: Column) -> Column:
            return F.try_element_at(table, run)

    else:

        def known(run: Column) -> Column:
            return F.lit(None).cast("string")

    typed = F.transform(
        runs, lambda run: F.struct(run.alias("text"), _typed(run, known(run)).alias("type"))
    )
    return F.filter(typed, lambda entity: entity["type"].isNotNull())


def _joined_entities(df: DataFrame, gazetteer: DataFrame, text_column: str) -> DataFrame:
    require_columns(gazetteer, "text", "type")
    # Entities depend on the text alone, so a digest of it serves where articles have no key.
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.col(ROW_KEY).cast("string") if ROW_KEY in df.columns else F.md5(text)
    df, given = df.withColumn("_article", key), df.columns
    # A name may be listed with several types; one lookup row per name keeps counts right.
    lookup = gazetteer.groupBy(F.col("text").alias("run")).agg(F.min("type").alias("known"))
    salted = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(NAME_SALTS - 1))))
    runs = F.coalesce(entity_runs(F.col(text_column)), F.array().cast("array<string>"))
    # A name meets the table once per article, however often it is mentioned there.
    names = df.select(
        "_article",
        F.pmod(F.hash("_article"), F.lit(NAME_SALTS)).alias("salt"),
        F.explode(F.array_distinct(runs)).alias("run"),
    )
    known = (
        names.join(salted, ["run", "salt"])
        .groupBy("_article")
        .agg(F.map_from_entries(F.collect_set(F.struct("run", "known"))).alias("_known"))
    )
    typed = F.transform(
        runs,
        lambda run: F.struct(
            run.alias("text"), _typed(run, F.try_element_at("_known", run)).alias("type")
        ),
    )
    entities = F.filter(typed, lambda entity: entity["type"].isNotNull())
    return df.join(known, "_article", "left").select(*given, entities.alias("entities"))
