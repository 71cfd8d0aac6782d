"""Term features, keyword candidates and their ranks for many articles at once, in numpy arrays.

What a batch of articles holds becomes numbers first: a word is the number of its term, a term of
an article is the number of the two, an n-gram that of a shorter one and its last word.  Equal
things are found by hashing those numbers, over all articles together, so Python looks at each
different word of a batch and at the keywords that it returns, and at nothing else one by one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from storylake.functions.text import SENTENCE_MARK

#: Words that are held as arrays at once, so that these stay in the processor's cache; an article
#: with more words stands alone.
CHUNK_WORDS = 50_000

#: Scores are ranked after rounding, so that equal keywords tie on every engine.
RANK_DIGITS = 12

#: From here on, doubles are further apart than the last digit that ranks.
_COARSE = 4096.0


class Terms(NamedTuple):
    """The words of some articles, and the terms of each article in order of appearance."""

    articles: int
    vocabulary: pa.Array  # all terms, sorted
    lettered: np.ndarray  # by vocabulary
    term: np.ndarray  # of every word: its number among the terms of its article
    inner: np.ndarray  # of every word: whether it is not the first of its sentence
    article: np.ndarray  # of every term, like all that follow
    name: np.ndarray  # its place in the vocabulary
    tf: np.ndarray
    is_stop: np.ndarray
    score: np.ndarray


class Candidates(NamedTuple):
    """The n-grams of some articles, best first in each."""

    offsets: np.ndarray  # where the candidates of each article start, and the end
    names: list[np.ndarray]  # by word: its place in the vocabulary, -1 behind the last
    score: np.ndarray
    kf: np.ndarray


def _numbered(values: np.ndarray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Equal values by one number, in order of appearance, and where each appears first."""
    found = (pa.array(values) if isinstance(values, np.ndarray) else values).dictionary_encode()
    numbers = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return numbers, np.flatnonzero(np.diff(np.maximum.accumulate(numbers), prepend=-1))


def _has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


class Spellings(NamedTuple):
    """What different words show: their terms in order, and by word its term and its capitals."""

    vocabulary: pa.Array
    lettered: np.ndarray  # by vocabulary
    term: np.ndarray
    acronym: np.ndarray
    capital: np.ndarray


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _spellings(words: pa.Array) -> Spellings:
    terms, capitals = pc.ascii_lower(words), _flags(pc.match_substring_regex(words, "^[A-Z]"))
    acronym = _flags(pc.ascii_is_upper(words)) & (pc.binary_length(words).to_numpy() > 1)
    other = ~_flags(pc.string_is_ascii(words))
    if other.any():
        texts = words.filter(pa.array(other)).to_pylist()
        terms = pc.replace_with_mask(terms, pa.array(other), pa.array([text.lower() for text in texts], pa.string()))
        acronym[other] = [len(text) > 1 and text == text.upper() and _has_letter(text) for text in texts]
        capitals[other] = [unicodedata.category(text[0]) == "Lu" for text in texts]
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    vocabulary = coded.dictionary.take(pa.array(order))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lettered = ~_flags(pc.ascii_is_decimal(vocabulary))
    other = ~_flags(pc.string_is_ascii(vocabulary))
    lettered[other] = [_has_letter(text) for text in vocabulary.filter(pa.array(other)).to_pylist()]
    return Spellings(vocabulary, lettered, place[coded.indices.to_numpy()], acronym, capitals)


def _shares(distinct: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Distinct neighbours as a share of all neighbours on one side, 0 without any."""
    every = np.bincount(of, minlength=size)
    return np.bincount(distinct, minlength=size) / np.maximum(every, 1)


def _stop_terms(
    article: np.ndarray,
    name: np.ndarray,
    vocabulary: pa.Array,
    languages: Sequence[str | None],
    stopwords: Mapping[str, Sequence[str]],
) -> np.ndarray:
    """Whether the terms, by article and name, are function words of the article's language."""
    found = np.zeros(len(name), bool)
    for code, words in stopwords.items():
        listed = _flags(pc.is_in(vocabulary, value_set=pa.array(words, pa.string())))
        found |= listed[name] & np.array([language == code for language in languages], bool)[article]
    return found


def scored_terms(words: pa.Array, languages: Sequence[str | None], stopwords: Mapping[str, Sequence[str]]) -> Terms:
    """The terms of articles, given as lists of words with a mark in front of each sentence."""
    flat = words.flatten()
    mark = _flags(pc.equal(flat, SENTENCE_MARK))
    is_word = ~mark
    article = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    totals = np.bincount(article[mark], minlength=len(words))
    article, flat, n = article[is_word], flat.filter(pa.array(is_word)), int(is_word.sum())
    sentence = np.cumsum(mark)[is_word] - 1 - (np.cumsum(totals) - totals)[article]
    inner = np.diff(np.flatnonzero(is_word), prepend=-1) == 1
    word, first_seen = _numbered(flat)
    spelled = _spellings(flat.take(pa.array(first_seen)))
    name_of = spelled.term[word]
    term, firsts = _numbered(article * max(len(spelled.vocabulary), 1) + name_of)
    size = len(firsts)
    own, name = article[firsts], name_of[firsts]
    tf = np.bincount(term, minlength=size)
    starts = np.cumsum(tf) - tf
    # The sentences of each term, in order.
    seen = sentence[np.sort(term * max(n, 1) + np.arange(n)) % max(n, 1)]
    median = (seen[starts + (tf - 1) // 2] + seen[starts + tf // 2]) / 2
    another = np.diff(seen, prepend=-1) != 0
    another[starts] = True
    different = np.bincount(np.repeat(np.arange(size), tf), another, size)
    capital = spelled.capital[word] & inner
    cased = np.maximum(np.bincount(term, spelled.acronym[word], size), np.bincount(term, capital, size))
    after = np.flatnonzero(inner)
    left, right = term[after - 1], term[after]
    _, pairs = _numbered(left * size + right)
    variety = _shares(right[pairs], right, size) + _shares(left[pairs], left, size)

    is_stop = _stop_terms(own, name, spelled.vocabulary, languages, stopwords)
    most = np.zeros(len(totals), np.int64)
    np.maximum.at(most, own, tf)
    content = np.where(is_stop, 0, 1)
    several, total, squares = (np.bincount(own, content * x, len(totals)) for x in (1, tf, tf * tf))
    mean, square = (x / np.maximum(several, 1) for x in (total, squares))
    level = (mean + np.sqrt(np.maximum(square - mean * mean, 0.0)))[own]
    norm = np.where(level > 0, tf / np.where(level > 0, level, 1), 0.0)
    related = 1 + variety * tf / most[own]
    position = np.log(np.log(3 + median))
    case = cased / (1 + np.log(tf))
    score = related * position / (case + norm / related + different / totals[own] / related)
    return Terms(
        len(totals), spelled.vocabulary, spelled.lettered, term, inner, own, name, tf, is_stop, score
    )


def _ranks(values: np.ndarray) -> np.ndarray:
    """Places of the values among the different ones, from 0."""
    order = np.argsort(values)
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.cumsum(np.diff(values[order], prepend=values[order[:1]]) != 0)
    return ranks


#: Whole numbers below this one can be added without leaving 64 bits.
_ROOM = 1 << 62


def _best_first(article: np.ndarray, score: np.ndarray, names: Sequence[np.ndarray], size: int) -> np.ndarray:
    """The order by article, score and keyword; names are places in a vocabulary of that size.

    Terms sort before whatever they are the beginning of, as keywords do.  Ranks of what is compared
    first make one number of all, and sorting such numbers costs a fraction of sorting by several.
    """
    n = max(len(score), 1)
    key, bound = names[0], size
    for name in names[1:]:
        if bound * (size + 1) >= _ROOM:
            key, bound = _ranks(key), n
        key, bound = key * (size + 1) + name + 1, bound * (size + 1)
    by_name = np.argsort(key)
    place = np.empty(len(score), np.int64)
    place[by_name] = np.arange(len(score))
    # Far below 64 bits: one article, or as many as a batch has and no more words than CHUNK_WORDS.
    return by_name[np.sort((article * n + _ranks(score)) * n + place) % n]


def _rounded(score: np.ndarray) -> np.ndarray:
    scale = 10.0**RANK_DIGITS
    return np.where(score < _COARSE, np.floor(score * scale + 0.5) / scale, score)


def candidates(terms: Terms, ngram_max: int) -> Candidates:
    """n-grams with content words at both ends and letters in all words, equal ones once."""
    lettered = terms.lettered[terms.name]
    content = lettered & ~terms.is_stop
    lettered = lettered[terms.term]
    at = np.flatnonzero(content[terms.term])
    gram = terms.term[at]
    found = []
    for i in range(ngram_max):
        if i:
            # Of the grams so far, those that the sentence goes on behind.
            more = at + i < len(terms.term)
            at, gram = at[more], gram[more]
            more = terms.inner[at + i] & lettered[at + i]
            at, gram = at[more], gram[more] * max(len(terms.tf), 1) + terms.term[at[more] + i]
        gram, firsts = _numbered(gram)
        kf, firsts = np.bincount(gram, minlength=len(firsts)), at[firsts]
        whole = content[terms.term[firsts + i]]
        kf, firsts = kf[whole], firsts[whole]
        own = [terms.term[firsts + j] for j in range(i + 1)]
        # The words of a keyword fix its product and sum.
        product = total = terms.score[own[0]]
        for one in own[1:]:
            product, total = product * terms.score[one], total + terms.score[one]
        names = [terms.name[one] for one in own] + [np.full(len(kf), -1)] * (ngram_max - 1 - i)
        found.append((terms.article[own[0]], product / (kf * (1 + total)), kf, *names))
    article, score, kf, *names = (np.concatenate(part) for part in zip(*found, strict=True))
    score = _rounded(score)
    order = _best_first(article, score, names, len(terms.vocabulary))
    counts = np.bincount(article, minlength=terms.articles)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return Candidates(offsets, [name[order] for name in names], score[order], kf[order])


def _texts(found: Candidates, vocabulary: pa.Array, chosen: np.ndarray) -> pa.Array:
    """The keywords at the given places."""
    columns = [name[chosen] for name in found.names]
    words = [vocabulary.take(pa.array(column, mask=column < 0)) for column in columns]
    return pc.binary_join_element_wise(*words, " ", null_handling="skip")


def _lists(offsets: np.ndarray, **columns: pa.Array | np.ndarray) -> pa.Array:
    entries = pa.StructArray.from_arrays([pa.array(each) for each in columns.values()], [*columns])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def term_lists(terms: Terms) -> pa.Array:
    """``term, tf, is_stop, term_score`` of the terms of every article."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(terms.article, minlength=terms.articles))])
    names = terms.vocabulary.take(pa.array(terms.name))
    return _lists(offsets, term=names, tf=terms.tf, is_stop=terms.is_stop, term_score=terms.score)


def _best(found: Candidates, top_n: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Where the first candidates of each article are, and the offsets of lists of them."""
    counts = np.diff(found.offsets)
    chosen = np.arange(len(found.score))
    if top_n is not None:
        chosen = chosen[chosen - np.repeat(found.offsets[:-1], counts) < top_n]
        counts = np.minimum(counts, max(top_n, 0))
    return chosen, np.concatenate([[0], np.cumsum(counts)])


def candidate_lists(terms: Terms, ngram_max: int, top_n: int | None = None) -> pa.Array:
    """``score, keyword, kf`` of the candidates of every article, best first: all, or the first."""
    found = candidates(terms, ngram_max)
    chosen, offsets = _best(found, top_n)
    keywords = _texts(found, terms.vocabulary, chosen)
    return _lists(offsets, score=found.score[chosen], keyword=keywords, kf=found.kf[chosen])


def keyword_lists(terms: Terms, ngram_max: int, top_n: int | None = None) -> pa.Array:
    """The candidates of every article alone, best first: all, or the first."""
    found = candidates(terms, ngram_max)
    chosen, offsets = _best(found, top_n)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _texts(found, terms.vocabulary, chosen))


def _chunks(words: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of articles with a bounded number of words, or one article."""
    ends, start = words.offsets.to_numpy(), 0
    while start < len(words):
        end = max(int(np.searchsorted(ends, ends[start] + CHUNK_WORDS, "right")) - 1, start + 1)
        yield start, end
        start = end


def over_batches(
    finish: Callable[[Terms], pa.Array], stopwords: Mapping[str, Sequence[str]]
) -> Callable[[Iterator[tuple[pa.Array, pa.Array]]], Iterator[pa.Array]]:
    """A function on Arrow batches of words and languages, for ``arrow_udf``."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for words, languages in batches:
            yield pa.concat_arrays(
                finish(scored_terms(words[a:b], languages[a:b].to_pylist(), stopwords)) for a, b in _chunks(words)
            )

    return run
