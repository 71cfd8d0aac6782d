"""Keyword extraction with the statistical term features of Campos et al. (2020).

All features are local to an article, and so is the work.  Articles are dealt out once, the only
exchange; sentences and their words are found by Spark expressions, and the words of a batch of
articles are counted, scored and ranked together in arrays of numbers (``keyword_batches``), which
costs a word about as much as finding it does.  No word becomes a row, so nothing is sorted,
gathered or spilled across articles, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.constants import STOPWORDS
from storylake.functions.text import sentence_words
from storylake.operators.keyword_batches import (
    Terms,
    candidate_lists,
    keyword_lists,
    over_batches,
    term_lists,
)
from storylake.operators.skew import place_by_article
from storylake.schema import ROW_KEY, require_columns
from storylake.session import keep_batches_small

NGRAM_MAX = 3
TOP_N = 50
DEDUP_LIMIT = 0.9

Stopwords = Mapping[str, Sequence[str]]

_TERMS = "array<struct<term: string, tf: bigint, is_stop: boolean, term_score: double>>"
_CANDIDATES = "array<struct<score: double, keyword: string, kf: bigint>>"


def _found(
    df: DataFrame,
    kept: Sequence[str],
    finish: Callable[[Terms], pa.Array],
    result: str,
    text_column: str,
    language_column: str,
    stopwords: Stopwords,
) -> DataFrame:
    """The kept columns, and ``_kw_found``: what is made of the scored terms of every article."""
    require_columns(df, ROW_KEY, text_column, language_column)
    keep_batches_small(df.sparkSession)
    listed = {code: list(words) for code, words in stopwords.items()}
    # Else a filter on what is found would compute it again.
    call = F.arrow_udf(over_batches(finish, listed), result).asNondeterministic()
    placed = place_by_article(df.select(*dict.fromkeys([*kept, text_column, language_column])))
    return placed.select(*kept, call(sentence_words(F.col(text_column)), F.col(language_column)).alias("_kw_found"))


def term_scores(
    df: DataFrame,
    text_column: str = "text",
    language_column: str = "language",
    stopwords: Stopwords = STOPWORDS,
) -> DataFrame:
    """``ingest_seq, term, tf, is_stop, term_score`` of every article; a low score marks an important term."""
    found = _found(df, [ROW_KEY], term_lists, _TERMS, text_column, language_column, stopwords)
    rows = found.select(ROW_KEY, F.explode("_kw_found").alias("_term"))
    return rows.select(ROW_KEY, *[f"_term.{name}" for name in ("term", "tf", "is_stop", "term_score")])


def keyword_scores(
    df: DataFrame,
    ngram_max: int = NGRAM_MAX,
    text_column: str = "text",
    language_column: str = "language",
    stopwords: Stopwords = STOPWORDS,
) -> DataFrame:
    """``ingest_seq, keyword, kf, score`` of every candidate; lower scores are better."""
    every = partial(candidate_lists, ngram_max=ngram_max)
    found = _found(df, [ROW_KEY], every, _CANDIDATES, text_column, language_column, stopwords)
    rows = found.select(ROW_KEY, F.explode("_kw_found").alias("_gram"))
    return rows.select(ROW_KEY, *[f"_gram.{name}" for name in ("keyword", "kf", "score")])


def top_keywords(
    df: DataFrame,
    top_n: int = TOP_N,
    ngram_max: int = NGRAM_MAX,
    text_column: str = "text",
    language_column: str = "language",
    stopwords: Stopwords = STOPWORDS,
) -> DataFrame:
    """``ingest_seq, rank, keyword, score``: the best candidates, near-duplicates included."""
    best = partial(candidate_lists, ngram_max=ngram_max, top_n=top_n)
    found = _found(df, [ROW_KEY], best, _CANDIDATES, text_column, language_column, stopwords)
    return found.select(ROW_KEY, F.posexplode("_kw_found").alias("at", "best")).select(
        ROW_KEY,
        (F.col("at") + 1).alias("rank"),
        F.col("best.keyword").alias("keyword"),
        F.col("best.score").alias("score"),
    )


def _similar(a: Column, b: Column, limit: float) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return 1 - F.levenshtein(a, b) / longest >= limit


#: Of the candidates of an article, so many times the wanted keywords are walked first.
_HEAD = 4


def _selected(df: DataFrame, kept: Sequence[str], top_n: int, dedup_limit: float) -> DataFrame:
    """The kept columns, and ``keywords``: best first, near-duplicates of a kept one left out."""
    if dedup_limit >= 1:
        return df.select(*kept, F.slice("_kw_found", 1, top_n).alias("keywords"))

    def step(chosen: Column, keyword: Column) -> Column:
        repeated = F.exists(chosen, lambda other: _similar(other, keyword, dedup_limit))
        full = F.size(chosen) >= top_n
        return F.when(full | repeated, chosen).otherwise(F.concat(chosen, F.array(keyword)))

    # A step copies what is chosen so far, so the rest is walked only where it can add something.
    head = max(top_n, 1) * _HEAD
    rest = F.slice("_kw_found", head + 1, F.greatest(F.size("_kw_found") - head, F.lit(0)))
    first = F.aggregate(F.slice("_kw_found", 1, head), F.array().cast("array<string>"), step)
    chosen = F.col("_kw_chosen")
    walked = F.when(F.size(chosen) >= top_n, chosen).otherwise(F.aggregate(rest, chosen, step))
    return df.select(*kept, "_kw_found", first.alias("_kw_chosen")).select(*kept, walked.alias("keywords"))


def extract_keywords(
    df: DataFrame,
    top_n: int = TOP_N,
    ngram_max: int = NGRAM_MAX,
    dedup_limit: float = DEDUP_LIMIT,
    text_column: str = "text",
    language_column: str = "language",
    stopwords: Stopwords = STOPWORDS,
) -> DataFrame:
    """Add ``keywords array<string>`` to every article; articles without any get an empty array.

    All candidates of an article take part; the walk only stops adding once ``top_n`` are
    kept.  ``dedup_limit=1`` keeps near-duplicates.  ``stopwords`` maps language codes to
    function words; a language that it lacks has none.
    """
    kept = [name for name in df.columns if name != "keywords"]
    # Any candidate may come up where better ones are near-duplicates.
    ordered = partial(keyword_lists, ngram_max=ngram_max, top_n=top_n if dedup_limit >= 1 else None)
    found = _found(df, kept, ordered, "array<string>", text_column, language_column, stopwords)
    return _selected(found, kept, top_n, dedup_limit)


def article_keywords(
    df: DataFrame,
    top_n: int = TOP_N,
    ngram_max: int = NGRAM_MAX,
    dedup_limit: float = DEDUP_LIMIT,
    text_column: str = "text",
    language_column: str = "language",
    stopwords: Stopwords = STOPWORDS,
) -> DataFrame:
    """``ingest_seq, keywords`` of every article, as :func:`extract_keywords` finds them.

    The rest of the articles stays where it is; only their text and language move.
    """
    require_columns(df, ROW_KEY, text_column, language_column)
    narrow = df.select(*dict.fromkeys([ROW_KEY, text_column, language_column]))
    found = extract_keywords(narrow, top_n, ngram_max, dedup_limit, text_column, language_column, stopwords)
    return found.select(ROW_KEY, "keywords")
