"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is merged from its bytes; those that end as their own single
token need no merging when they stand alone as a pre-token.  Counting looks pre-tokens up in
that proven set and merges only the rest.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Remembered pre-tokens that had to be merged, per task.
REMEMBERED = 200_000


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in vocabularies of byte-level encodings.

    Printable Latin-1 bytes stand for themselves, the others follow from code point 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    symbols = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(plain))
    return symbols


# Fixed value: the pattern that splits text before merging, as the byte-level format states it.
SPLIT_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@dataclass(frozen=True)
class Vocabulary:
    """Content of a byte-level vocabulary file."""

    ids: dict[bytes, int]
    ranks: dict[tuple[bytes, bytes], int]
    specials: dict[str, int]

    def splitter(self):
        """Finds special strings and pre-tokens; specials are never part of a pre-token."""
        names = sorted(self.specials, key=len, reverse=True)
        special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        return special, regex.compile(SPLIT_PATTERN)


def read_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file in the ``.json`` format of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte_of = {symbol: b for b, symbol in byte_symbols().items()}

    def raw(token: str) -> bytes:
        return bytes(byte_of[c] for c in token)

    ids = {raw(token): i for token, i in content["model"]["vocab"].items()}
    ranks = {}
    for rank, merge in enumerate(content["model"]["merges"]):
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        ranks[raw(left), raw(right)] = rank
    specials = {t["content"]: t["id"] for t in content["added_tokens"]}
    return Vocabulary(ids, ranks, specials)


def merged(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The pieces of ``word`` after all merges, lowest rank first, then leftmost.

    A heap of candidate pairs over a linked list keeps very long words near-linear.
    """
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    heap = []
    for i in range(len(word) - 1):
        rank = ranks.get((pieces[i], pieces[i + 1]))
        if rank is not None:
            heap.append((rank, i, pieces[i], pieces[i + 1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if pieces[i] != left or j >= len(word) or pieces[j] != right:
            continue
        pieces[i], pieces[j] = left + right, None
        after[i] = after[j]
        if after[i] < len(word):
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(word):
                rank = ranks.get((pieces[a], pieces[b]))
                if rank is not None:
                    heapq.heappush(heap, (rank, a, pieces[a], pieces[b]))
    return [piece for piece in pieces if piece is not None]


def proven_whole(vocabulary: Vocabulary) -> frozenset[str]:
    """Vocabulary strings that encode alone as exactly one token, shown by merging each."""
    proven = []
    for token in vocabulary.ids:
        if merged(token, vocabulary.ranks) == [token]:
            try:
                proven.append(token.decode("utf-8"))
            except UnicodeDecodeError:
                continue  # no text has it as a pre-token
    return frozenset(proven)


class _Counts(dict):
    """Tokens per pre-token: proven strings count one, others are merged and remembered."""

    def __init__(self, whole: frozenset[str], ranks: dict[tuple[bytes, bytes], int]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.ranks = whole, ranks

    def __missing__(self, word: str) -> int:
        n = len(merged(word.encode("utf-8"), self.ranks))
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        if len(word) < 64:
            self[word] = n
        return n


def count_tokens(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """One row per input row: the id, n_bytes, n_tokens, over_limit.

    A null text counts as empty: no bytes, no tokens.  Null ids and repeated rows are kept as
    they are; further columns are ignored.  Strings of added tokens inside a text are one
    token each.  Nothing is shuffled; the vocabulary (its size is that of the file) travels as
    a broadcast variable.
    """
    vocabulary = read_vocabulary(vocabulary_path)
    shared = docs.sparkSession.sparkContext.broadcast(
        (proven_whole(vocabulary), vocabulary.ranks, vocabulary)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, ranks, vocab = shared.value
        special, words = vocab.splitter()
        known = _Counts(whole, ranks)
        look_up, find = known.__getitem__, words.findall

        def of(text: str) -> int:
            if special is None or not special.search(text):
                return sum(map(look_up, find(text)))
            parts = special.split(text)
            return len(parts) // 2 + sum(sum(map(look_up, find(p))) for p in parts[::2])

        for batch in batches:
            counts = [of(text.as_py() or "") for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n_bytes"], pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
