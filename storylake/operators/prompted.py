"""Aboutness, summaries, quotes and sentiment by a model instead of column expressions.

Each function has the columns of its column-only counterpart.  The scorer (see ``scoring``) gets
the column ``prompt`` and may report token usage and errors; a failed row keeps null results
and its error, and has no usage, so costs count answered calls only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.functions.prompts import (
    ABOUTNESS_PROMPT,
    QUOTES_PROMPT,
    SUMMARY_PROMPT,
    build_prompt,
)
from storylake.functions.text import quote_regex
from storylake.operators.quotes import UNSPECIFIED
from storylake.operators.scoring import SUCCESS, ScorerFactory, model_outcomes
from storylake.operators.search import mention_mask
from storylake.operators.selection import limit_after_dedup
from storylake.schema import require_columns

_STRING, _DOUBLE, _BOOLEAN = T.StringType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: What a scorer returns beside token usage and ``error``.
ABOUTNESS_OUTPUT = _struct(score=_DOUBLE, is_about=_BOOLEAN, reason=_STRING)
SUMMARY_OUTPUT = _struct(
    summary=_STRING,
    is_confident=_BOOLEAN,
    confidence_reason=_STRING,
    key_points=T.ArrayType(_STRING),
)
QUOTE_OUTPUT = _struct(quote=_STRING, speaker=_STRING, pronoun=_STRING)
SENTIMENT_OUTPUT = _struct(label=_STRING, score=_DOUBLE)


def _asked(
    df: DataFrame, prompt: Column, factory: ScorerFactory, output: T.StructType, many: bool = False
) -> DataFrame:
    """``df`` with the outcome of every row; the model is called once per row."""
    asked = df.withColumn("prompt", prompt)
    return model_outcomes(asked, factory, ["prompt"], output, many=many).drop("prompt")


def _usage() -> Column:
    return F.when(F.col("outcome.status") == SUCCESS, F.col("outcome.usage"))


def aboutness_with(
    df: DataFrame,
    factory: ScorerFactory,
    target: str,
    context: str | None = None,
    max_rows: int | None = None,
    text_column: str = "text",
    title_column: str = "title",
) -> DataFrame:
    """``about_score``, ``about_is_about``, ``about_reason``, ``about_error`` and ``usage``."""
    require_columns(df, text_column, title_column)
    outputs = ("about_score", "about_is_about", "about_reason", "about_error", "usage")
    df = limit_after_dedup(df, max_rows).drop(*outputs)
    prompt = build_prompt(
        ABOUTNESS_PROMPT,
        target=F.lit(target),
        context=F.lit(context),
        title=F.col(title_column),
        text=F.col(text_column),
    )
    scored = _asked(df, prompt, factory, ABOUTNESS_OUTPUT)
    return scored.select(
        *df.columns,
        F.col("outcome.output.score").alias("about_score"),
        F.col("outcome.output.is_about").alias("about_is_about"),
        F.col("outcome.output.reason").alias("about_reason"),
        F.col("outcome.error").alias("about_error"),
        _usage().alias("usage"),
    )


def summaries_with(
    df: DataFrame,
    factory: ScorerFactory,
    focus: str | None = None,
    tags_column: str | None = None,
    text_column: str = "text",
    title_column: str = "title",
) -> DataFrame:
    """The columns of ``summarize_articles``; a failed row is not confident and has no points."""
    require_columns(df, text_column, title_column)
    prompt = build_prompt(
        SUMMARY_PROMPT,
        focus=F.lit(focus),
        tags=F.col(tags_column) if tags_column else F.lit(None),
        title=F.col(title_column),
        text=F.col(text_column),
    )
    scored = _asked(df, prompt, factory, SUMMARY_OUTPUT)
    answer = F.col("outcome.output")
    return scored.select(
        *df.columns,
        answer["summary"].alias("llm_summary_text"),
        F.coalesce(answer["is_confident"], F.lit(False)).alias("llm_summary_is_confident"),
        F.col("outcome.error").alias("llm_summary_error"),
        answer["confidence_reason"].alias("confidence_reason"),
        F.coalesce(answer["key_points"], F.array().cast("array<string>")).alias("key_points"),
        _usage().alias("usage"),
    )


def quotes_with(
    df: DataFrame, factory: ScorerFactory, text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(one row per quote as in ``quote_table``, one row per article: usage and error)."""
    require_columns(df, text_column)
    scored = _asked(
        df, build_prompt(QUOTES_PROMPT, text=F.col(text_column)), factory, QUOTE_OUTPUT, many=True
    )
    parents = [name for name in df.columns if name != text_column]

    def named(field: str) -> Column:
        return F.coalesce(F.nullif(F.col(f"_q.{field}"), F.lit("")), F.lit(UNSPECIFIED)).alias(field)

    quotes = scored.select(*parents, F.posexplode("outcome.output").alias("quote_id", "_q")).select(
        *parents,
        "quote_id",
        F.col("_q.quote").alias("quote"),
        named("speaker"),
        named("pronoun"),
        F.lit(None).cast("string").alias("llm_error"),
    )
    calls = scored.select(*parents, _usage().alias("usage"), F.col("outcome.error").alias("llm_error"))
    return quotes, calls


def sentiment_with(
    df: DataFrame,
    factory: ScorerFactory,
    target: str,
    literal: bool = False,
    text_column: str = "sentence_text",
) -> DataFrame:
    """``target_sentiment`` and its score; the scorer sees only sentences with the target."""
    require_columns(df, text_column)
    pattern = quote_regex(target) if literal else target
    text = F.col(text_column)
    asked = df.withColumn("prompt", F.when(mention_mask(text, pattern), text))
    scored = model_outcomes(
        asked, factory, ["prompt"], SENTIMENT_OUTPUT, reuse=False, skip_blank="prompt"
    )
    return scored.select(
        *df.columns,
        F.col("outcome.output.label").alias("target_sentiment"),
        F.round("outcome.output.score", 4).alias("target_sentiment_score"),
    )
