"""Sentence tables and targeted sentiment of sentences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.constants import NEGATIVE_WORDS, POSITIVE_WORDS
from storylake.functions.text import sentences, tokens
from storylake.operators.search import any_pattern, mention_mask
from storylake.schema import require_columns

SENTENCE_PARENTS = ["id", "media_name", "title", "publish_date", "url", "language"]


def sentence_table(
    df: DataFrame, text_column: str = "text", parents: Sequence[str] = ("id",)
) -> DataFrame:
    """One row per sentence, numbered from 0 over all sentences of the article."""
    require_columns(df, text_column, *parents)
    return df.select(
        *parents, F.posexplode(sentences(F.col(text_column))).alias("sentence_id", "sentence_text")
    )


def matching_sentences(
    df: DataFrame, patterns: Sequence[str] | None = None, text_column: str = "text"
) -> DataFrame:
    """Sentences in which any pattern is found; ``sentence_id`` counts unfiltered sentences."""
    table = sentence_table(df, text_column, SENTENCE_PARENTS)
    return table.filter(any_pattern(F.col("sentence_text"), patterns))


def _target_place(text: Column, target: str) -> Column:
    """Number of tokens in front of the first mention of the target."""
    before = F.regexp_extract(text, f"(?isu)^(.*?)(?:{target})", 1)
    # A mention inside a word belongs to that word, so its first half is not counted.
    return F.size(tokens(F.regexp_replace(before, r"[\p{L}\p{N}]+$", "")))


def _sentiment_sum(
    text: Column, target_at: Column, positive: Iterable[str], negative: Iterable[str]
) -> Column:
    """Polarity words weighted by their token distance to the first mention of the target."""
    words = F.transform(
        tokens(text),
        lambda word, at: F.when(
            word.isin(list(positive)), 1.0 / (1 + F.abs(at - target_at))
        ).when(word.isin(list(negative)), -1.0 / (1 + F.abs(at - target_at))),
    )
    weights = F.filter(words, lambda weight: weight.isNotNull())
    # Rounding keeps sums that cancel out from turning into a stray sign.
    return F.round(F.aggregate(weights, F.lit(0.0), lambda total, weight: total + weight), 9)


def targeted_sentiment(
    df: DataFrame,
    target: str,
    literal: bool = False,
    positive: Iterable[str] = tuple(POSITIVE_WORDS),
    negative: Iterable[str] = tuple(NEGATIVE_WORDS),
    text_column: str = "sentence_text",
) -> DataFrame:
    """Add ``target_sentiment`` and ``target_sentiment_score`` to every sentence.

    Sentences that do not mention the target keep null in both columns.  This is the
    Column-only scorer; :func:`storylake.operators.scoring.model_map_one` runs a model.
    """
    require_columns(df, text_column)
    from storylake.functions.text import quote_regex

    pattern = quote_regex(target) if literal else target
    text = F.col(text_column)
    total = _sentiment_sum(text, F.col("_at"), tuple(positive), tuple(negative))
    # The place is a column of its own, so that it is found once and not for every word.
    placed = df.withColumn("_at", F.when(mention_mask(text, pattern), _target_place(text, pattern)))
    scored = placed.withColumn("_sum", F.when(F.col("_at").isNotNull(), total))
    label = (
        F.when(F.col("_sum") > 0, "Positive")
        .when(F.col("_sum") < 0, "Negative")
        .when(F.col("_sum") == 0, "Neutral")
    )
    size = F.abs("_sum")
    return scored.select(
        *df.columns,
        label.alias("target_sentiment"),
        F.round(size / (size + 1), 4).alias("target_sentiment_score"),
    )
