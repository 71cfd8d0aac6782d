"""Registry, table access and SQL building blocks shared by the query groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storylake.constants import (
    ABBREVIATIONS,
    CLOSERS,
    SENTENCE_OPENERS,
    STOPWORDS,
    TITLES,
    UNSPACED_STOPS,
)
from storylake.sources.articles import articles_from_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(function):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(table(spark, sf_dir, "documents"))


def text_of(*names: str) -> list[Column]:
    """Dates and other scalars as text, so both engines hand over the same value."""
    return [F.col(name).cast("string").alias(name) for name in names]


def joined(name: str) -> Column:
    """An array of strings as one string."""
    return F.array_join(F.col(name), "|").alias(name)


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WS = r"[\s\p{Z}\x{b}\x{85}\x{1c}-\x{1f}]"
TOK = r"[\p{L}\p{N}]+"

ARTICLES = """
articles AS (
  SELECT doc_id AS ingest_seq, doc_id AS id, split_part(text, chr(10), 1) AS title, text,
         'http://' || source || '.example.org/' || doc_id AS url, source AS media_name,
         lang AS language,
         DATE '2024-01-01' + CAST((doc_id * 7) % 31 AS INTEGER) AS publish_date
  FROM documents)"""


def norm(expr: str) -> str:
    return f"lower(trim(regexp_replace({expr}, '{WS}+', ' ', 'g')))"


def toks(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '{TOK}')"


def _alternatives(*tables: dict[str, list[str]]) -> str:
    return "|".join(sorted({word for table in tables for words in table.values() for word in words}))


def _sentence_parts(body: str) -> str:
    """The sentences of a stripped text: stops that may not end one get a mark, then the rest split."""
    never, maybe, initial = "chr(64977)", "chr(64978)", "chr(64979)"
    no_word = r"(^|[^\p{L}\p{N}])"
    short = rf"(?:\p{{L}}(?:\.\p{{L}})+|{_alternatives(ABBREVIATIONS)})"
    opener = rf"{WS}+(?:{'|'.join(SENTENCE_OPENERS)})(?:[^\p{{L}}\p{{N}}]|$)"
    marks = [
        (f"'{no_word}((?:{_alternatives(TITLES)})\\.)'", rf"'\1\2' || {never}"),
        (f"'{no_word}({short}\\.)'", rf"'\1\2' || {maybe}"),
    ]
    steps = [
        # Twice: of words that follow each other without a space, a match takes every other one.
        *marks,
        *marks,
        (f"'{no_word}(\\p{{Lu}}\\.)'", rf"'\1\2' || {initial}"),
        (f"'[' || {maybe} || {initial} || ']+({opener})'", r"'\1'"),
        # Initials before a name, from the last one to the third before it.
        (f"{initial} || '({WS}+[\\p{{L}}\\p{{N}}]{{2}})'", rf"{never} || '\1'"),
        (f"{initial} || '({WS}+\\p{{Lu}}\\.' || {never} || ')'", rf"{never} || '\1'"),
        (f"{initial} || '({WS}+\\p{{Lu}}\\.' || {never} || ')'", rf"{never} || '\1'"),
        (initial, "''"),
        (f"'([.!?]){WS}+|([{UNSPACED_STOPS}]+[{CLOSERS}]*){WS}*'", r"'\1\2' || chr(1)"),
        (f"'[' || {never} || {maybe} || ']'", "''"),
    ]
    for pattern, replacement in steps:
        body = f"regexp_replace({body}, {pattern}, {replacement}, 'g')"
    return f"[part FOR part IN string_split({body}, chr(1)) IF part <> '']"


def sentences_cte(source: str = "articles", name: str = "sentences") -> str:
    """One row per sentence with every column of the source."""
    return f"""
{name}_parts AS (
  SELECT *, {_sentence_parts("body")} AS parts
  FROM (SELECT *, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS body FROM {source})
  WHERE body <> ''),
{name} AS (
  SELECT * EXCLUDE (body, parts), len(parts) AS sentence_total, unnest(parts) AS sentence_text,
         CAST(unnest(range(len(parts))) AS INTEGER) AS sentence_id
  FROM {name}_parts)"""


def stopwords_cte() -> str:
    rows = ", ".join(
        f"({quoted(code)}, {quoted(word)})" for code, words in STOPWORDS.items() for word in words
    )
    return f"stopwords AS (SELECT * FROM (VALUES {rows}) v(language, term))"


def dedup_cte(source: str, keys: str, order: str, name: str) -> str:
    """Rows with their rank in the group of equal keys."""
    return f"""
{name} AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn,
         first_value(id) OVER (PARTITION BY {keys} ORDER BY {order}) AS kept_id
  FROM {source})"""


BY_TITLE = norm("title"), "publish_date NULLS LAST, ingest_seq"
BY_TITLE_SOURCE = "title, media_name", "ingest_seq"
