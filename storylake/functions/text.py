"""Column functions on text.  Everything here stays inside the JVM and needs no shuffle."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from storylake.constants import (
    ABBREVIATIONS,
    CLOSERS,
    SENTENCE_OPENERS,
    STOPWORDS,
    TITLES,
    UNSPACED_STOPS,
)

#: Unicode white space, wider than the ASCII-only ``\s`` of the regex engine.
WHITESPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
TOKEN = r"[\p{L}\p{N}]+"

#: The characters of WHITESPACE; none is beyond the first plane.
_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85" + "".join(
    char for char in map(chr, range(1 << 16)) if unicodedata.category(char)[0] == "Z"
)

SENTENCE_MARK = "\x01"
_DIGEST_OF_NOTHING = hashlib.md5(b"").hexdigest()


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE + "+", " "))


def normalize_text(text: Column) -> Column:
    """White space collapsed, ends stripped, lower case; null becomes the empty string."""
    return F.coalesce(F.lower(collapse_whitespace(text)), F.lit(""))


def hash_text(text: Column) -> Column:
    """MD5 hex digest of the normalised text; blank text has the empty key."""
    # Replacing the digest of nothing reads the text once; a condition would read it twice.
    return F.replace(F.md5(normalize_text(text)), F.lit(_DIGEST_OF_NOTHING), F.lit(""))


def truncate(text: Column, max_chars: int | None) -> Column:
    """First ``max_chars`` characters; None or a value below 1 leaves the text as it is."""
    if max_chars is None or max_chars <= 0:
        return text
    return F.substring(F.coalesce(text, F.lit("")), 1, max_chars)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def is_blank(text: Column) -> Column:
    return normalize_text(text) == ""


def null_if_blank(text: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(
        F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", ""), F.lit("")
    )


def _accent_folding() -> tuple[str, str, dict[str, str]]:
    """Lower-case Latin letters whose compatibility decomposition has an ASCII base."""
    source, target, longer = [], [], {}
    for code in [*range(0xAA, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07)]:
        char = chr(code)
        if char != char.lower():
            continue
        base = "".join(
            part for part in unicodedata.normalize("NFKD", char) if not unicodedata.combining(part)
        )
        if base == char or not base.isascii() or not base.isalnum():
            continue
        if len(base) == 1:
            source.append(char)
            target.append(base)
        else:
            longer[char] = base
    return "".join(source), "".join(target), longer


_FOLD_FROM, _FOLD_TO, _FOLD_LONGER = _accent_folding()


def strip_accents(text: Column) -> Column:
    folded = F.translate(text, _FOLD_FROM, _FOLD_TO)
    for char, base in _FOLD_LONGER.items():
        folded = F.replace(folded, F.lit(char), F.lit(base))
    return F.regexp_replace(folded, r"\p{M}+", "")


def url_slug(text: Column, max_length: int = 16) -> Column:
    """URL-safe slug; a cut moves back to a hyphen that lies beyond half of the length."""
    slug = strip_accents(F.lower(F.coalesce(text, F.lit(""))))
    slug = F.regexp_replace(slug, f"(?:{WHITESPACE}|_)+", "-")
    slug = F.regexp_replace(slug, "[^a-z0-9-]", "")
    slug = F.regexp_replace(F.regexp_replace(slug, "-+", "-"), "^-|-$", "")
    cut = F.substring(slug, 1, max_length)
    hyphen = F.length(cut) - F.instr(F.reverse(cut), "-")
    at_hyphen = F.when(
        (F.instr(cut, "-") > 0) & (hyphen > max_length * 0.5),
        F.substring(cut, F.lit(1), hyphen),
    ).otherwise(cut)
    return F.regexp_replace(
        F.when(F.length(slug) > max_length, at_hyphen).otherwise(slug), "-+$", ""
    )


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def _one_of(table: dict[str, Sequence[str]]) -> str:
    words = sorted({word for words in table.values() for word in words})
    return "(?:" + "|".join(quote_regex(word) for word in words) + ")"


def sentence_end_pattern(
    titles: dict[str, Sequence[str]] = TITLES,
    abbreviations: dict[str, Sequence[str]] = ABBREVIATIONS,
) -> str:
    """Pattern of a sentence end with the white space behind it.

    Group 1 holds the stop, group 2 what belongs to it in scripts without spaces.  Every character
    of a text meets one class, of few ranges; only at a stop does the pattern look back.
    """
    no_word = r"(?<![\p{L}\p{N}])"
    opener = rf"{WHITESPACE}+(?:{'|'.join(SENTENCE_OPENERS)})(?![\p{{L}}\p{{N}}])"
    name = rf"(?:{WHITESPACE}+\p{{Lu}}\.){{0,2}}(?!{opener}){WHITESPACE}+[\p{{L}}\p{{N}}]{{2}}"
    never = rf"(?<!{no_word}{_one_of(titles)}\.)" if any(titles.values()) else ""
    short = rf"(?<!{no_word}\p{{L}}\.\p{{L}}\.)"
    if any(abbreviations.values()):
        short += rf"(?<!{no_word}{_one_of(abbreviations)}\.)"
    initial = rf"(?:(?<!{no_word}\p{{Lu}}\.)|(?!{name}))"
    return (
        rf"[.!?{min(UNSPACED_STOPS)}-{max(UNSPACED_STOPS)}](?<=([.!?{UNSPACED_STOPS}]))"
        rf"(?:(?<=[.!?]){never}(?:{short}{initial}|(?={opener})){WHITESPACE}+"
        rf"|(?<=[{UNSPACED_STOPS}])([{UNSPACED_STOPS}]*[{CLOSERS}]*){WHITESPACE}*)"
    )


def marked_sentences(text: Column, ends: str | None = None) -> Column:
    """Stripped text with a mark between sentences; empty pieces are none."""
    # The ends are stripped once and a break consumes its white space, so pieces are trimmed;
    # blank text, or an end without white space at the end of a text, leaves an empty piece.
    stripped = F.btrim(text, F.lit(_BLANKS))
    return F.regexp_replace(stripped, ends or _SENTENCE_END, "$1$2" + SENTENCE_MARK)


def sentences(text: Column, ends: str | None = None) -> Column:
    """Array of trimmed, non-empty sentences.

    A sentence ends at ``. ! ?`` plus white space, and at the stops of scripts without spaces.
    The stop of a title (``Dr.``) is no end; that of dotted letters (``U.S.``) or of another
    abbreviation is one only before a word that opens sentences (``The``); that of a single
    capital also where no name follows, after up to two further initials.  The abbreviations of
    all languages count in every text, by case; ``ends`` takes another ``sentence_end_pattern``.
    """
    return F.array_remove(F.split(marked_sentences(text, ends), SENTENCE_MARK), "")


def sentence_words(text: Column) -> Column:
    """The words of all sentences in order, and ``SENTENCE_MARK`` in front of each sentence."""
    # What is not empty starts behind a mark, the last one of several in a row.
    marked = F.concat(F.lit(SENTENCE_MARK), marked_sentences(F.coalesce(text, F.lit(""))))
    pattern = f"{TOKEN}|{SENTENCE_MARK}(?=[^{SENTENCE_MARK}])"
    return F.regexp_extract_all(marked, F.lit(pattern), F.lit(0))


def is_stopword(
    term: Column, language: Column, stopwords: dict[str, Sequence[str]] = STOPWORDS
) -> Column:
    """Whether a lower-case term is a function word of the article's language."""
    test = F.lit(False)
    for code, words in stopwords.items():
        test = F.when(language == code, term.isin(list(words))).otherwise(test)
    return F.coalesce(test, F.lit(False))


def quote_regex(literal: str) -> str:
    """Escape a literal so that both Java and RE2 read it as plain text."""
    return "".join(
        char if char.isalnum() or char == "_" or char.isspace() or ord(char) > 127 else "\\" + char
        for char in literal
    )


_SENTENCE_END = sentence_end_pattern()


def contains_tokens(text: Column, phrase_tokens: Sequence[str]) -> Column:
    """Whether lower-case whole tokens follow each other, whatever separates them.

    The first token is matched before what precedes it is looked at, which is much cheaper
    than a look-behind at every position of the text.
    """
    first, *rest = [quote_regex(token) for token in phrase_tokens]
    pattern = rf"{first}(?<![\p{{L}}\p{{N}}]{first})"
    pattern += "".join(r"[^\p{L}\p{N}]+" + token for token in rest)
    pattern += r"(?![\p{L}\p{N}])"
    return F.coalesce(F.rlike(F.lower(text), F.lit(pattern)), F.lit(False))


def contains_regex(text: Column, pattern: str) -> Column:
    """Case-insensitive search anywhere in the text; null text is no match."""
    return F.coalesce(F.rlike(text, F.lit("(?iu)" + pattern)), F.lit(False))
