"""Token counts, encoding and decoding against the library of the vocabulary."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from storylake.llm import bpe_automaton, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "é", "漢", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "!!", "aaaa", "<|endoftext|>",
    "<|endof", "'s", "'ll", "123", "½", "́", "😀", "the", "ing", " token", "ization", "\xa0",
    "​", "Ⅷ", "\x00", "%%%", "$$$", "THE", "İ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n, seed):
    rnd = random.Random(seed)
    found = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return [*found, "", "x" * 3000, "ab" * 2000, "$" * 500, "the " * 2000]


def test_counts(spark, library):
    rows = [(i, t) for i, t in enumerate(texts(400, 1))] + [(None, "a b"), (7, None), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens")
    got = token_counts.count_tokens(docs, PATH, limit=20).collect()
    expected = []
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((i, len((text or "").encode()), n, n > 20))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_every_proven_string_is_one_token(library):
    vocabulary = token_counts.read_vocabulary(PATH)
    proven = token_counts.proven_whole(vocabulary)
    assert len(proven) > 45_000
    some = random.Random(3).sample(sorted(proven), 2000)
    assert all(len(e.ids) == 1 for e in library.encode_batch(some, add_special_tokens=False))


def test_digests_and_columns(spark, library):
    rows = [(i, t) for i, t in enumerate(texts(400, 2))] + [(None, "a b"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS ids")
    expected = {}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.setdefault(i, []).append((ids, back))
    for row in bpe_automaton.token_digests(docs, PATH).collect():
        assert any(
            row["n_tokens"] == len(ids)
            and row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            and row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
            for ids, back in expected[row["doc_id"]]
        )
    both = bpe_automaton.decode_column(bpe_automaton.encode_column(docs, PATH), PATH).collect()
    assert len(both) == len(rows)
    assert all(row["decoded"] == (row["text"] or "") for row in both)
    assert all((row["ids"], row["decoded"]) in expected[row["doc_id"]] for row in both)
    checked = bpe_automaton.encode_and_check(docs, PATH).collect()
    assert len(checked) == len(rows) and all(row["intact"] for row in checked)
    assert all((row["ids"], row["text"] or "") in expected[row["doc_id"]] for row in checked)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(docs, PATH).count() == 0
    assert bpe_automaton.token_digests(docs, PATH).count() == 0
    assert bpe_automaton.encode_column(docs, PATH).columns == ["doc_id", "text", "ids"]


def test_automaton_is_small_and_deterministic():
    """Every merge adds one state at most, whatever the number of arcs."""
    ids = {bytes([c]): i for i, c in enumerate(b"abc")} | {b"ab": 3, b"aa": 4, b"abc": 5, b"aab": 6}
    ranks = {(b"a", b"b"): 0, (b"a", b"a"): 1, (b"ab", b"c"): 2, (b"a", b"ab"): 3}
    vocabulary = token_counts.Vocabulary(ids, ranks, {})
    automaton = bpe_automaton.Automaton(vocabulary)
    assert len(automaton.original) == len(ranks) + 1
    encoder = bpe_automaton.Encoder(automaton)
    rnd = random.Random(4)
    for _ in range(3000):
        word = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 12)))
        spelled = [automaton.label[i] for i in encoder.encode(word)]
        assert spelled == token_counts.merged(word, ranks)
