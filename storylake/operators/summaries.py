"""Extractive article summaries.

All word statistics are per article and taken in arrays of its own words (see ``functions/runs``),
so a task holds one article at a time.  Articles are dealt out once; nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.functions.prompts import SUMMARY_PROMPT, build_prompt
from storylake.functions.runs import run, run_starts, with_value
from storylake.functions.text import is_stopword, sentences, token_count, tokens
from storylake.operators.selection import limit_after_dedup
from storylake.operators.skew import place_by_article
from storylake.schema import ROW_KEY, require_columns

SUMMARY_SENTENCES = 3
KEY_POINTS = 3
MIN_TOKENS = 50
MIN_SENTENCES = 3
OUTPUTS = [
    "llm_summary_text",
    "llm_summary_is_confident",
    "llm_summary_error",
    "confidence_reason",
    "key_points",
    "usage",
]


def _rated_words(own: Column, language: Column, focus: Column) -> Column:
    """The occurrences of one term: sentence, whether a word, its weight, and first focus word there."""
    term = own[0]["term"]
    facts = F.struct(
        own["place"].alias("places"),
        F.when(~is_stopword(term, language), F.size(own).cast("long")).alias("weight"),
        F.coalesce(F.array_contains(focus, term), F.lit(False)).alias("focus"),
    )

    def rated(fact: Column) -> Column:
        places = fact["places"]
        return F.transform(
            places,
            lambda place, at: F.struct(
                place.alias("place"),
                F.lit(True).alias("word"),
                fact["weight"].alias("weight"),
                (fact["focus"] & ((at == 0) | (F.get(places, at - 1) != place))).alias("focus"),
            ),
        )

    return F.flatten(F.transform(F.array(facts), rated))


def _sentence_score(own: Column) -> Column:
    """Mean frequency of the content words of a sentence, plus its distinct focus words."""
    weights = F.filter(own["weight"], lambda weight: weight.isNotNull())
    total = F.aggregate(weights, F.lit(0).cast("long"), lambda state, weight: state + weight)
    mean = F.coalesce(total / F.nullif(F.size(weights), F.lit(0)), F.lit(0.0))
    return F.round(mean + F.size(F.filter(own, lambda word: word["focus"])), 9)


def _with_best_sentences(articles: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, ``_prompt_tokens, _parts, _best``: the best sentences by number, best first.

    Null for articles that are too short.
    """
    kept = [*carried, "_prompt_tokens", "_parts"]
    none = F.array().cast("array<string>")
    steps = with_value(
        articles, "_parts", F.coalesce(sentences(F.col("_text")), none), *kept[:-1], "_language", "_focus"
    )

    def located(part: Column, place: Column) -> Column:
        return F.transform(tokens(part), lambda term: F.struct(term.alias("term"), place.alias("place")))

    words = F.sort_array(F.flatten(F.transform("_parts", located)))
    steps = with_value(steps, "_words", words, *kept, "_language", "_focus")
    found, starts = F.col("_words"), F.col("_starts")
    steps = with_value(steps, "_starts", run_starts(found, "term"), "*")
    terms = F.transform(starts, lambda start, number: run(found, starts, start, number))
    rated = F.transform(terms, lambda own: _rated_words(own, F.col("_language"), F.col("_focus")))
    # Sentences without words are scored too.
    blank = F.transform(
        "_parts",
        lambda part, place: F.struct(
            place.alias("place"),
            F.lit(False).alias("word"),
            F.lit(None).cast("long").alias("weight"),
            F.lit(False).alias("focus"),
        ),
    )
    steps = with_value(
        steps, "_rated", F.sort_array(F.concat(blank, F.flatten(rated))), *kept, F.size(found).alias("_total")
    )
    found = F.col("_rated")
    steps = with_value(steps, "_starts", run_starts(found, "place"), "*")
    own_words = F.transform(starts, lambda start, number: run(found, starts, start, number))
    ranked = F.sort_array(
        F.transform(
            own_words,
            lambda own: F.struct((-_sentence_score(own)).alias("score"), own[0]["place"].alias("place")),
        )
    )
    best = F.slice(ranked, 1, SUMMARY_SENTENCES + KEY_POINTS)["place"]
    long_enough = (F.col("_total") >= MIN_TOKENS) & (F.size("_parts") >= MIN_SENTENCES)
    return with_value(steps, "_best", F.when(long_enough, best), *kept)


def summarize_articles(
    df: DataFrame,
    focus: str | None = None,
    tags_column: str | None = None,
    max_rows: int | None = None,
    text_column: str = "text",
    title_column: str = "title",
) -> DataFrame:
    """Add summary text, confidence, key points, error and usage to every article.

    A sentence scores by the mean frequency of its content words in the article plus one
    per distinct word of the run focus or of the article's tags.  Articles that are too
    short get no summary and are not confident.
    """
    require_columns(df, ROW_KEY, "language", text_column, title_column)
    df = limit_after_dedup(df, max_rows)
    tags = F.col(tags_column) if tags_column else F.lit(None).cast("string")
    wanted = F.array_distinct(
        tokens(F.concat_ws(" ", F.lit(focus).cast("string"), F.col("_tags")))
    )
    kept = [name for name in df.columns if name not in OUTPUTS]
    placed = place_by_article(df.select(*kept, tags.alias("_tags")))
    prompt = build_prompt(
        SUMMARY_PROMPT,
        focus=F.lit(focus),
        tags=F.col("_tags"),
        title=F.col(title_column),
        text=F.col(text_column),
    )
    scored = _with_best_sentences(
        placed.select(
            *kept,
            F.col("language").alias("_language"),
            F.col(text_column).alias("_text"),
            wanted.alias("_focus"),
            token_count(prompt).cast("long").alias("_prompt_tokens"),
        ),
        kept,
    )

    def cut(numbers: Column) -> Column:
        return F.transform(numbers, lambda number: F.get("_parts", number))

    in_order = F.array_sort(F.slice("_best", 1, SUMMARY_SENTENCES))
    summary = F.array_join(cut(in_order), " ")
    key_points = cut(F.slice("_best", SUMMARY_SENTENCES + 1, KEY_POINTS))
    answered = F.coalesce(token_count(F.col("_summary")), F.lit(0)).cast("long")
    confident = F.col("_best").isNotNull()
    return (
        scored.withColumn("_summary", summary)
        .withColumn("_answer_tokens", answered)
        .select(
            *kept,
            F.col("_summary").alias("llm_summary_text"),
            confident.alias("llm_summary_is_confident"),
            F.lit(None).cast("string").alias("llm_summary_error"),
            F.when(confident, "long enough").otherwise("too short to summarise").alias("confidence_reason"),
            F.coalesce(key_points, F.array().cast("array<string>")).alias("key_points"),
            F.struct(
                F.col("_prompt_tokens").alias("prompt_tokens"),
                F.col("_answer_tokens").alias("completion_tokens"),
                (F.col("_prompt_tokens") + F.col("_answer_tokens")).alias("total_tokens"),
            ).alias("usage"),
        )
    )
