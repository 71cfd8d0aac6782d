"""Direct quotes with their speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.schema import require_columns

#: Quoted text, and the text behind it up to the next quotation mark.
QUOTE = '["“]([^"“”]+)["”]([^"“”]*)'
#: Text in front of the first quotation mark.
HEAD = '^([^"“”]*)'
#: Attributions stand within so many characters of the quote.
REACH = 80
_VERB = r"(?:said|says|added|told|asked)"
#: Capitalised words or initials; a full stop ends the name unless it follows an initial.
_PART = r"\p{Lu}(?:[\p{L}'-]+|\.)"
_NAME = rf"({_PART}(?: {_PART})*)"
_PRONOUN = "(he|she|they)"
_END = r"(?:[^\p{L}]|\z)"
#: Name and pronoun patterns of each side: in front and joined by a comma or colon, behind, in
#: front and not joined.
SIDES = {
    "joined": (
        (rf"{_NAME} {_VERB}[,:]\s*\z", rf"{_VERB} {_NAME}[,:]\s*\z"),
        (
            rf"(?i)(?:^|[^\p{{L}}]){_PRONOUN} {_VERB}[,:]\s*\z",
            rf"(?i)(?:^|[^\p{{L}}]){_VERB} {_PRONOUN}[,:]\s*\z",
        ),
    ),
    "behind": (
        (rf"^[\s,]*{_VERB} {_NAME}", rf"^[\s,]*{_NAME} {_VERB}{_END}"),
        (rf"(?i)^[\s,]*{_PRONOUN} {_VERB}{_END}", rf"(?i)^[\s,]*{_VERB} {_PRONOUN}{_END}"),
    ),
    "front": (
        (rf"{_NAME} {_VERB}\s*\z", rf"{_VERB} {_NAME}\s*\z"),
        (
            rf"(?i)(?:^|[^\p{{L}}]){_PRONOUN} {_VERB}\s*\z",
            rf"(?i)(?:^|[^\p{{L}}]){_VERB} {_PRONOUN}\s*\z",
        ),
    ),
}
#: A sentence that begins behind a closed quote and leads to the next one, and not back.
CLOSED, LEADS_ON = r"[.!?]\s*\z", r"^\s*\p{Lu}[\s\S]*[,:]\s*\z"
PRONOUNS = ("he", "she", "they")
UNSPECIFIED = "unspecified"


def _first(text: Column, patterns: tuple[str, ...]) -> Column:
    found = [F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")) for pattern in patterns]
    return F.coalesce(*found)


def _attribution(text: Column, side: str) -> Column:
    """Struct of name and pronoun, or null when the side names neither."""
    names, pronouns = SIDES[side]
    name, pronoun = _first(text, names), F.lower(_first(text, pronouns))
    # A capitalised pronoun in front of the verb is not a name.
    name = F.when(~F.lower(name).isin(*PRONOUNS), name)
    return F.when(
        name.isNotNull() | pronoun.isNotNull(),
        F.struct(name.alias("name"), pronoun.alias("pronoun")),
    )


def quote_table(df: DataFrame, text_column: str = "text") -> DataFrame:
    """One row per quote with the article's columns except the text.

    The speaker is looked for on both sides: in front, if the verb is joined to the quote by a
    comma or colon; else behind, unless a new sentence there leads to the next quote; else in
    front.  ``speaker`` and ``pronoun`` are ``unspecified`` when neither side names one;
    articles without quotes give no rows.
    """
    require_columns(df, text_column)
    text = F.col(text_column)
    parents = [name for name in df.columns if name != text_column]
    found = df.select(
        *parents,
        F.regexp_extract_all(text, F.lit(QUOTE), F.lit(1)).alias("_quotes"),
        F.regexp_extract_all(text, F.lit(QUOTE), F.lit(2)).alias("_behind"),
        F.regexp_extract(text, HEAD, 1).alias("_head"),
    )
    rows = found.select(*parents, "_behind", "_head", F.posexplode("_quotes").alias("quote_id", "quote"))
    front = F.coalesce(F.get("_behind", F.col("quote_id") - 1), "_head")
    rows = rows.select(
        *parents,
        "quote_id",
        "quote",
        F.right(front, F.lit(REACH)).alias("_front"),
        F.get("_behind", F.col("quote_id")).alias("_after"),
        (F.col("quote_id") + 1 < F.size("_behind")).alias("_more"),
    )
    opener = F.col("_more") & F.col("quote").rlike(CLOSED) & F.col("_after").rlike(LEADS_ON)
    behind = F.left("_after", F.lit(REACH))
    said = F.coalesce(
        _attribution(F.col("_front"), "joined"),
        F.when(~opener, _attribution(behind, "behind")),
        _attribution(F.col("_front"), "front"),
    )
    return rows.withColumn("_said", said).select(
        *parents,
        "quote_id",
        "quote",
        F.coalesce("_said.name", F.lit(UNSPECIFIED)).alias("speaker"),
        F.coalesce("_said.pronoun", F.lit(UNSPECIFIED)).alias("pronoun"),
        F.lit(None).cast("string").alias("llm_error"),
    )
