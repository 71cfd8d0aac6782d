"""Exact duplicates by skew-safe combining.

Rows are combined within each map task, then by salted digest, then the winners of the salts
globally.  Every stage groups by the whole normalised text next to its digest, so two texts
with one digest never merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.llm.support import WORD_GAP, free_name, shared_table

#: Salts of a digest group; they fit the bits of a long.
SALTS = 32


def normalised(text: Column) -> Column:
    """White space runs as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_GAP, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _by_salt(classes: DataFrame, salts: int) -> DataFrame:
    """One row per class and salt in which it has rows."""
    all_salts = F.array(*[F.lit(s) for s in range(salts)])
    used = F.filter(all_salts, lambda s: F.getbit(F.col("salts"), s) == 1)
    return classes.withColumn("salt", F.explode(used)).drop("salts")


def duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept.

    Of equal texts the row with the smallest id stays.  A null id is larger than any other; a
    group of null ids only has keep_id null.  Repeated rows with the kept id are all marked
    (:func:`drop_duplicates` keeps one of them).  An empty table gives no rows, further
    columns are ignored.  The digest only steers placement: texts that share one are told
    apart by their content, also when rows are given their class.
    """
    if not 1 <= salts <= 63:
        raise ValueError("salts must be between 1 and 63")
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("body"))
    rows = rows.select(
        "id",
        "body",
        digest(F.col("body")).alias("digest"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
    )
    # The partial aggregate in each map task is the local combining.
    salted = rows.groupBy("digest", "body", "salt").agg(
        F.min("id").alias("keep_id"), F.count("*").alias("size")
    )
    classes = salted.groupBy("digest", "body").agg(
        F.min("keep_id").alias("keep_id"),
        F.sum("size").alias("group_size"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"),
    )
    narrow = shared_table(classes.drop("body"), "exact-classes")
    if narrow.groupBy("digest").count().filter("count > 1").isEmpty():
        # A third of all rows may have one digest; the salt spreads them over this join too.
        joined = rows.drop("body").join(_by_salt(narrow, salts), ["digest", "salt"])
    else:
        joined = rows.join(_by_salt(classes, salts), ["digest", "body", "salt"])
    return joined.select(
        "id",
        "digest",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and no repeated row."""
    key, digest = free_name(docs, "_key"), free_name(docs, "_digest")
    stay = (
        duplicate_classes(docs, id_col, text_col)
        .filter("kept")
        .select(F.xxhash64("id").alias(key), F.col("digest").alias(digest))
        .distinct()
    )
    marked = docs.withColumns(
        {key: F.xxhash64(id_col), digest: sha256(normalised(F.col(text_col)))}
    )
    # Both steps need the rows of a key together, so the second one moves nothing.
    kept = marked.join(stay, [key, digest]).dropDuplicates([key, digest])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
