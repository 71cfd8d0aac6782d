"""Predicates that narrow an article table."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.functions.text import contains_regex, contains_tokens, quote_regex, tokens
from storylake.params import SearchTerms
from storylake.schema import require_columns

_TOKEN = re.compile(r"[^\W_]+")


#: Copies of a scope's sources where it is too large for a broadcast.
SCOPE_SALTS = 32


def _mentions(df_columns: Sequence[str], phrase: str, fields: Sequence[str]) -> Column:
    words = _TOKEN.findall(phrase.lower())
    if not words:
        raise ValueError(f"search term {phrase!r} holds no letter or digit")
    hit = F.lit(False)
    for name in fields:
        if name in df_columns:
            hit = hit | contains_tokens(F.col(name), words)
    return hit


def search_terms(
    df: DataFrame,
    all_of: Iterable[str] = (),
    any_of: Iterable[str] = (),
    none_of: Iterable[str] = (),
    fields: Sequence[str] = ("title", "text"),
) -> DataFrame:
    """Keep articles by whole-token, case-insensitive terms or phrases in any of the fields."""
    condition = F.lit(True)
    for phrase in all_of:
        condition = condition & _mentions(df.columns, phrase, fields)
    wanted = [_mentions(df.columns, phrase, fields) for phrase in any_of]
    if wanted:
        either = wanted[0]
        for hit in wanted[1:]:
            either = either | hit
        condition = condition & either
    for phrase in none_of:
        condition = condition & ~_mentions(df.columns, phrase, fields)
    return df.filter(condition)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is referred to.

    An expression inside a lambda is computed for every entry; a lambda's variable is not.
    """
    return F.get(F.transform(F.array(value), use), 0)


def _positions(words: Column, phrase: Sequence[str]) -> Column:
    """Positions in an array of tokens at which a phrase starts, ascending."""

    def here(token: Column, at: Column) -> Column:
        hit = token == phrase[0]
        for i, word in enumerate(phrase[1:], 1):
            hit = hit & (F.get(words, at + i) == word)
        return F.when(hit, at)

    return F.filter(F.transform(words, here), lambda at: at.isNotNull())


def _words(term: str) -> list[str]:
    words = _TOKEN.findall(term.lower())
    if not words:
        raise ValueError(f"search term {term!r} holds no letter or digit")
    return words


def repeated_within(text: Column, term: str, mentions: int, slop: int) -> Column:
    """Whether ``mentions`` occurrences of a word or phrase start within ``slop`` token positions."""
    if mentions < 1 or slop < 0:
        raise ValueError("mentions must be at least 1 and slop must not be negative")
    phrase = _words(term)

    def close(positions: Column) -> Column:
        # Both arrays start aligned: entry i of the second is the (i + mentions - 1)-th hit.
        spans = F.zip_with(
            positions,
            F.slice(positions, mentions, F.greatest(F.size(positions), F.lit(1))),
            lambda first, last: last - first,
        )
        return F.coalesce(F.exists(spans, lambda span: span <= slop), F.lit(False))

    return _once(tokens(text), lambda words: _once(_positions(words, phrase), close))


def near_each_other(text: Column, terms: Sequence[str], slop: int) -> Column:
    """Whether all words or phrases start within ``slop`` token positions, in any order.

    A term that is listed several times needs as many mentions.  One walk over the positions of
    all terms keeps the latest mentions of each; where all are there, their span is the smallest
    that ends here.
    """
    if not terms or slop < 0:
        raise ValueError("terms must not be empty and slop must not be negative")
    wanted = Counter(tuple(_words(term)) for term in terms)

    def marked(words: Column) -> Column:
        found = [
            F.transform(
                _positions(words, phrase),
                lambda at: F.struct(at.cast("int").alias("at"), F.lit(i).alias("term")),
            )
            for i, phrase in enumerate(wanted)
        ]
        return F.array_sort(F.concat(*found))

    events = _once(tokens(text), marked)
    numbers = list(wanted.values())
    nothing = F.array(*[F.array_repeat(F.lit(-1), n) for n in numbers])

    def step(state: Column, event: Column) -> Column:
        # -1 stands for a mention that has not come yet.
        latest = [
            F.when(
                event["term"] == i,
                F.concat(F.slice(state["latest"][i], 2, n - 1), F.array(event["at"])),
            ).otherwise(state["latest"][i])
            for i, n in enumerate(numbers)
        ]
        oldest = F.array_min(F.array(*[F.get(places, 0) for places in latest]))
        near = (oldest >= 0) & (event["at"] - oldest <= slop)
        return F.struct(F.array(*latest).alias("latest"), (state["found"] | near).alias("found"))

    start = F.struct(nothing.alias("latest"), F.lit(False).alias("found"))
    return F.coalesce(F.aggregate(events, start, step, lambda state: state["found"]), F.lit(False))


def search_proximity(
    df: DataFrame, term: str, mentions: int, slop: int, text_column: str = "text"
) -> DataFrame:
    """Keep articles that repeat a word or phrase within a window of tokens; no shuffle is needed."""
    require_columns(df, text_column)
    # The plain token test is cheap and drops most articles before positions are listed.
    text = F.col(text_column)
    return df.filter(contains_tokens(text, _words(term))).filter(
        repeated_within(text, term, mentions, slop)
    )


def search_proximity_terms(
    df: DataFrame, terms: Sequence[str], slop: int, fields: Sequence[str] = ("title", "text")
) -> DataFrame:
    """Keep articles with all words or phrases within a window of tokens of one of the fields."""
    near = F.lit(False)
    for name in fields:
        if name in df.columns:
            # The cheap test of every term comes first.
            there = F.lit(True)
            for term in dict.fromkeys(terms):
                there = there & contains_tokens(F.col(name), _words(term))
            near = near | F.when(there, near_each_other(F.col(name), terms, slop)).otherwise(F.lit(False))
    return df.filter(near)


def filter_date_range(
    df: DataFrame, start: date | None, end: date | None, column: str = "publish_date"
) -> DataFrame:
    """Inclusive date range, written so that it reaches the file scan."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df


def filter_scope(
    df: DataFrame,
    sources: Sequence[str] = (),
    collection_ids: Sequence[int] = (),
    collection_sources: DataFrame | None = None,
) -> DataFrame:
    """Articles of the named sources or of any source in the named collections.

    Both lists empty means every source.  ``collection_sources`` has the columns
    ``collection_id`` and ``media_name``.
    """
    if not sources and not collection_ids:
        return df
    if not collection_ids:
        return df.filter(F.col("media_name").isin(list(sources)))
    if collection_sources is None:
        raise ValueError("collection_ids need a collection_sources table")
    scope = collection_sources.filter(
        F.col("collection_id").isin(list(collection_ids))
    ).select("media_name")
    if sources:
        named = df.sparkSession.createDataFrame([(name,) for name in sources], "media_name string")
        scope = scope.union(named)
    # A source may have a third of all articles: its rows meet the scope under many salts.
    salts = F.array(*[F.lit(i) for i in range(SCOPE_SALTS)])
    salted = scope.distinct().withColumn("_salt", F.explode(salts))
    marked = df.withColumn("_salt", F.pmod(F.hash("id", "url"), F.lit(SCOPE_SALTS)))
    return marked.join(salted, ["media_name", "_salt"], "left_semi").select(*df.columns)


def any_pattern(text: Column, patterns: Sequence[str] | None) -> Column:
    """True when any pattern is found, ignoring case; no patterns means no restriction."""
    if not patterns:
        return F.lit(True)
    condition = contains_regex(text, patterns[0])
    for pattern in patterns[1:]:
        condition = condition | contains_regex(text, pattern)
    return condition


def mention_mask(text: Column, target: str, literal: bool = False) -> Column:
    """Whether the target pattern occurs; ``literal=True`` takes it as plain text."""
    return contains_regex(text, quote_regex(target) if literal else target)


def apply_search(df: DataFrame, terms: SearchTerms) -> DataFrame:
    df = search_terms(df, terms.all_of, terms.any_of, terms.none_of)
    for term, mentions, slop in terms.near:
        df = search_proximity(df, term, mentions, slop)
    return df
