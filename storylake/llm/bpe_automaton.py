"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton reads tokens, not bytes: it accepts exactly the token sequences that the merges
can leave behind.  It starts as one state with a loop for every byte and is rebuilt by one
gadget per merge ``u v -> w`` (Berglund, Martens and van der Merwe, 2024; Cognetta and Okazaki,
2024).  All arcs of one label lead to one state, so a gadget adds one state at most: a copy of
the state after ``u`` without its arc ``v``, to which all ``u`` arcs are turned; ``w`` arcs
stand beside every ``u`` arc and lead where ``v`` led.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import replace
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from storylake.llm.support import releasing
from storylake.llm.token_counts import Vocabulary, read_vocabulary

#: Remembered words per task and generation.
REMEMBERED = 150_000

#: Remembered transitions, likewise; only words that are not remembered ask for them.
REMEMBERED_ARCS = 20_000

#: Longer pre-tokens are encoded each time.
LONGEST_REMEMBERED = 64

#: Rows whose ids a task holds at once.
SLICE_ROWS = 100


class Automaton:
    """States with arcs labelled by tokens.

    A copy of a state has all arcs of the original but one.  The copies made for one label ``u``
    form a chain, so they are stored by their owner u, with the copy in which u lost each label.
    Arcs added later belong to the states that had an arc ``u`` at that moment;
    since states are numbered in the order of their making, that is looked up from the label.
    """

    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        self.label: dict[int, bytes] = {i: token for token, i in ids.items()}
        # Every worker has its automaton, so what has a value per state or label is an array.
        labels = max(ids.values(), default=-1) + 1
        self.original = array("i", [-1])  # of each state, what it was copied from
        self.owner = array("i", [-1])  # of each state, the label whose arcs lead to it or led before
        self.copies: dict[int, array] = {}  # of each owner, after the state they were made of
        self.loss: dict[int, int] = {}  # of (label, lost label), the copy in which it is lost
        self.target = array("i", [-1]) * labels  # of the arcs of each label, -1 without arcs
        self.left = array("i", [-1]) * labels  # u of each merged label, -1 for others
        self.states_then = array("i", [1]) * labels  # states there were when its arcs were added
        for b in range(256):
            if bytes([b]) in ids:
                self.target[ids[bytes([b])]] = 0
        for (u, v), _ in sorted(vocabulary.ranks.items(), key=lambda x: x[1]):
            self._gadget(ids[u], ids[v], ids[u + v])
        #: A trie of the tokens: a node maps bytes to [token ending there or -1, next node or None].
        self.trie: dict[int, list] = {}
        self.longest = max(map(len, ids), default=0)
        for token, i in ids.items():
            if self.target[i] >= 0:
                entry = [-1, self.trie]
                for b in token:
                    if entry[1] is None:
                        entry[1] = {}
                    entry = entry[1].setdefault(b, [-1, None])
                entry[0] = i

    def _gadget(self, u: int, v: int, w: int) -> None:
        after_u, after_v = self.target[u], self.target[v]
        self.original.append(after_u)
        self.owner.append(u)
        self.target[u] = len(self.owner) - 1
        self.copies.setdefault(u, array("i", [after_u])).append(self.target[u])
        self.loss.setdefault(u << 32 | v, self.target[u])
        if self.target[w] < 0:
            # The copy counts as there already: with u = v it has no arc u, so none for w.
            self.target[w] = after_v
            self.left[w] = u
            self.states_then[w] = len(self.owner)

    def has_arc(self, state: int, label: int) -> bool:
        """Whether ``state`` has an arc with ``label``."""
        while True:
            then = self.states_then[label]
            while state >= then:  # copies made after the arcs were added
                owner = self.owner[state]
                if then <= self.loss.get(owner << 32 | label, -1) <= state:
                    return False
                # All copies of one owner made since are passed at once.
                made = self.copies[owner]
                state = made[bisect_left(made, then, 1) - 1]
            if self.left[label] < 0:
                return True
            label = self.left[label]  # its arcs were put beside those of u


class Recent(dict):
    """Values by key, made when first asked for; of the others the latest are kept.

    Two generations of ``limit`` keys: what is asked for again moves to the younger one, and the
    older one goes when the younger is full.
    """

    def __init__(self, make, limit: int = REMEMBERED, keep=None):
        super().__init__()
        self.make, self.limit, self.keep, self.old = make, limit, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if self.keep is not None and not self.keep(key):
            return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Table-driven runs of an automaton over pre-split words."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.arcs = Recent(lambda key: automaton.has_arc(key >> 32, key & 0xFFFFFFFF), REMEMBERED_ARCS)

    def encode(self, word: bytes) -> tuple[int, ...]:
        """The one accepted token sequence that spells ``word``.

        Every prefix of a word has one accepted sequence at most, so a position has one state.
        Longer tokens are tried first; a position from which the run cannot go on is not tried
        again, so a word costs at most one step per token that starts at each of its bytes.
        """
        longest = self.automaton.longest
        arcs, target, trie = self.arcs, self.automaton.target, self.automaton.trie
        at, state, n = 0, 0, len(word)
        path: list[int] = []
        left: list[tuple[int, list]] = []  # where each token of the path starts, and shorter choices
        dead: set[int] = set()
        choices: list[tuple[int, int]] | None = None
        while at < n:
            if choices is None:
                choices, node, end = [], trie, at
                for b in word[at : at + longest]:
                    entry = node.get(b)
                    if entry is None:
                        break
                    label, node = entry
                    end += 1
                    if label >= 0:
                        choices.append((end, label))
                    if node is None:
                        break
            while choices:
                end, label = choices.pop()
                if end not in dead and arcs[state << 32 | label]:
                    path.append(label)
                    left.append((at, choices))
                    at, state, choices = end, target[label], None
                    break
            else:
                dead.add(at)
                if not path:
                    raise ValueError("the vocabulary lacks a byte of the text")
                path.pop()
                at, choices = left.pop()
                state = target[path[-1]] if path else 0
        return tuple(path)


def _broadcast_automaton(docs: DataFrame, vocabulary_path: str):
    vocabulary = read_vocabulary(vocabulary_path)
    automaton = Automaton(vocabulary)
    # Encoding needs the special strings only; tokens and merges are in the automaton.
    rest = replace(vocabulary, ids={}, ranks={})
    return docs.sparkSession.sparkContext.broadcast((rest, automaton))


def _text_encoder(vocabulary: Vocabulary, automaton: Automaton):
    special, words = vocabulary.splitter()
    spell = Encoder(automaton).encode
    known = Recent(lambda word: spell(word.encode("utf-8")), keep=lambda word: len(word) < LONGEST_REMEMBERED)
    look_up, find = known.__getitem__, words.findall
    flat = chain.from_iterable

    def encode(text: str) -> list[int]:
        if special is None or not special.search(text):
            return list(flat(map(look_up, find(text))))
        ids: list[int] = []
        for i, part in enumerate(special.split(text)):
            if i % 2:
                ids.append(vocabulary.specials[part])
            else:
                ids.extend(flat(map(look_up, find(part))))
        return ids

    return encode


def _decoder(vocabulary: Vocabulary, automaton: Automaton):
    label = dict(automaton.label)
    label.update({i: text.encode("utf-8") for text, i in vocabulary.specials.items()})

    def decode(ids: list[int]) -> str:
        return b"".join(map(label.__getitem__, ids)).decode("utf-8", "replace")

    return decode


def encode_column(
    docs: DataFrame, vocabulary_path: str, text_col: str = "text", out: str = "ids"
) -> DataFrame:
    """Add the token ids of ``text_col`` as array<int> column ``out``.

    Null counts as empty and gives an empty array.  All other columns pass through untouched;
    an existing column ``out`` is replaced.  Map-only.
    """
    docs = docs.drop(out)
    shared = _broadcast_automaton(docs, vocabulary_path)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _text_encoder(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                ids = [encode(text.as_py() or "") for text in part.column(at)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, out]
                )

    schema = StructType([*docs.schema.fields]).add(out, ArrayType(IntegerType()))
    return docs.mapInArrow(releasing(run), schema)


def decode_column(
    docs: DataFrame, vocabulary_path: str, ids_col: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add the text that the ids of ``ids_col`` spell as column ``out``.

    Null decodes to the empty text, an unknown id raises.  Bytes that are no UTF-8 become the
    replacement character.  Map-only.
    """
    docs = docs.drop(out)
    shared = _broadcast_automaton(docs, vocabulary_path)
    at = docs.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(*shared.value)
        for batch in batches:
            texts = [decode(ids.as_py() or []) for ids in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out]
            )

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(out, StringType()))


def encode_and_check(
    docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids: str = "ids", intact: str = "intact"
) -> DataFrame:
    """Add the token ids, and whether they decode to the text, in one pass.

    One worker a task holds the automaton, where an encoding and a decoding pass need two.
    Null counts as empty; columns of these names are replaced.  Map-only.
    """
    docs = docs.drop(ids, intact)
    shared = _broadcast_automaton(docs, vocabulary_path)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = _text_encoder(*shared.value), _decoder(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = [text.as_py() or "" for text in part.column(at)]
                found = [encode(text) for text in texts]
                same = [decode(i) == text for i, text in zip(found, texts)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                    [*part.schema.names, ids, intact],
                )

    schema = StructType([*docs.schema.fields])
    schema = schema.add(ids, ArrayType(IntegerType())).add(intact, BooleanType())
    return docs.mapInArrow(releasing(run), schema)


def token_digests(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode every text; return the id, n_tokens, ids_sha256, decoded_sha256.

    One pass over the rows: ids and decoded text are digested where they are made, so neither
    is moved.  Null counts as empty; null ids and repeated rows stay as they are; further
    columns are ignored.
    """
    shared = _broadcast_automaton(docs, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, automaton = shared.value
        encode = _text_encoder(vocabulary, automaton)
        decode = _decoder(vocabulary, automaton)
        number = {i: str(i) for i in [*automaton.label, *vocabulary.specials.values()]}
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = encode(text.as_py() or "")
                joined = ",".join(map(number.__getitem__, ids)).encode()
                back = decode(ids).encode("utf-8")
                rows.append(
                    (len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(back).hexdigest())
                )
            counts, joined, back = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(counts, pa.int64()),
                    pa.array(joined, pa.string()),
                    pa.array(back, pa.string()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    done = rows.mapInArrow(
        releasing(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return done.withColumnRenamed("id", id_col)
