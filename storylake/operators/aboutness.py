"""How far an article deals with a subject: score, filter and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.constants import SCORE_BINS
from storylake.functions.prompts import ABOUTNESS_PROMPT, build_prompt
from storylake.functions.text import token_count
from storylake.operators.aggregates import score_bin
from storylake.operators.scoring import USAGE_FIELDS
from storylake.operators.selection import limit_after_dedup
from storylake.schema import require_columns


def literal_count(text: Column, target: str) -> Column:
    """Occurrences of a literal, counted from the length that its removal takes away."""
    rest = F.replace(text, F.lit(target), F.lit(""))
    return F.floor((F.length(text) - F.length(rest)) / len(target)).cast("int")


def prompt_usage(prompt: Column, answer: Column) -> Column:
    """Token usage of a Column-only scorer: tokens of the prompt and of its answer."""
    asked, answered = token_count(prompt).cast("long"), token_count(answer).cast("long")
    return F.struct(
        *[
            value.alias(name)
            for name, value in zip(USAGE_FIELDS, (asked, answered, asked + answered), strict=True)
        ]
    )


def score_aboutness(
    df: DataFrame,
    target: str,
    context: str | None = None,
    text_column: str = "text",
    title_column: str = "title",
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``about_score``, ``about_is_about``, ``about_reason``, ``about_error`` and ``usage``.

    Column-only judge: an article is about the subject when the title names it, when it is
    mentioned more than once, or when its only mention lies in the first half of the text.
    """
    require_columns(df, text_column, title_column)
    subject = target.strip().lower()
    if not subject:
        raise ValueError("target must not be blank")
    outputs = ("about_score", "about_is_about", "about_reason", "about_error", "usage")
    df = limit_after_dedup(df, max_rows).drop(*outputs)
    text = F.lower(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    title = F.lower(F.coalesce(F.col(title_column).cast("string"), F.lit("")))
    facts = df.withColumns(
        {
            "_mentions": literal_count(text, subject),
            "_in_title": F.instr(title, subject) > 0,
            "_early": (F.instr(text, subject) > 0)
            & (F.instr(text, subject) <= F.length(text) / 2),
        }
    )
    mentions, in_title, early = F.col("_mentions"), F.col("_in_title"), F.col("_early")
    score = F.least(
        F.lit(1.0),
        0.5 * in_title.cast("int")
        + 0.15 * F.least(mentions, F.lit(4))
        + 0.35 * early.cast("int"),
    )
    reason = F.concat_ws(
        "; ",
        F.when(in_title, "named in the title"),
        F.when(mentions > 1, F.concat(mentions.cast("string"), F.lit(" mentions"))),
        F.when(mentions == 1, "one mention"),
        F.when(mentions == 0, "no mention in the text"),
        F.when(early, "first mention in the first half"),
        F.when((mentions > 0) & ~early, "first mention in the second half"),
    )
    prompt = build_prompt(
        ABOUTNESS_PROMPT,
        target=F.lit(target),
        context=F.lit(context),
        title=F.col(title_column),
        text=F.col(text_column),
    )
    return facts.select(
        *df.columns,
        F.round(score, 4).alias("about_score"),
        (in_title | (mentions >= 2) | ((mentions == 1) & early)).alias("about_is_about"),
        reason.alias("about_reason"),
        F.lit(None).cast("string").alias("about_error"),
        prompt_usage(prompt, reason).alias("usage"),
    )


def passes_aboutness(threshold: float) -> Column:
    """True for kept rows; a failed row (null) is never kept."""
    return F.coalesce(
        F.col("about_is_about") & (F.col("about_score") >= threshold), F.lit(False)
    )


def filter_aboutness(df: DataFrame, threshold: float) -> DataFrame:
    require_columns(df, "about_is_about", "about_score")
    return df.filter(F.col("about_is_about") & (F.col("about_score") >= threshold))


def aboutness_summary(
    df: DataFrame, threshold: float, target: str, target_kind: str = "generic"
) -> DataFrame:
    """One row: scored, passed and discarded counts and the ten-bin histogram.

    Everything is counted in one pass over the scored rows.
    """
    require_columns(df, "about_is_about", "about_score")
    bin_index = score_bin(F.col("about_score"))
    totals = df.select(passes_aboutness(threshold).alias("passed"), bin_index.alias("bin")).agg(
        F.count(F.lit(1)).alias("total_scored"),
        F.count_if("passed").alias("passed_count"),
        *[F.count_if(F.col("bin") == i).alias(f"bin{i}") for i in range(SCORE_BINS)],
    )
    return totals.select(
        "total_scored",
        "passed_count",
        (F.col("total_scored") - F.col("passed_count")).alias("discarded_count"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(target_kind).alias("target_kind"),
        F.lit(target).alias("about_target"),
        F.array(*[F.col(f"bin{i}") for i in range(SCORE_BINS)]).alias("score_histogram_counts"),
        F.array(*[F.lit(i / SCORE_BINS) for i in range(SCORE_BINS + 1)]).alias(
            "score_histogram_edges"
        ),
    )
