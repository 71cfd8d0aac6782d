"""Exact and near duplicates against brute force on small tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from storylake.llm import exact_dedup, near_join
from storylake.llm.support import components

DOCS = "doc_id long, text string"


def normal(text):
    return " ".join(p for p in _split(text)) if text else ""


def _split(text):
    import re

    return re.split(r"[\x20\x09-\x0D]+", text)


def brute_classes(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(normal(text), []).append(i)
    out = []
    for i, text in rows:
        ids = [x for x in groups[normal(text)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[normal(text)]), i == keep))
    return sorted(out, key=str)


ROWS = [
    (4, "a  b"), (2, "a b"), (9, "a\tb"), (1, None), (7, ""), (None, "a b"), (None, "x"), (None, "x"),
    (5, " a b"), (6, "é"), (6, "é"), (3, "c " * 5000), (8, "c " * 5000), (11, "c " * 4999),
]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.lit("same"), lambda t: F.length(t)])
def test_classes(spark, digest):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("digest", F.lit(1)).withColumn("id", F.lit(2))
    got = exact_dedup.duplicate_classes(docs, digest=digest).collect()
    found = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in got), key=str)
    assert found == brute_classes(ROWS)


def test_hot_group_is_salted(spark):
    rows = [(i, "same text") for i in range(3000)] + [(i, f"t{i}") for i in range(3000, 3100)]
    got = exact_dedup.duplicate_classes(spark.createDataFrame(rows, DOCS).repartition(7))
    assert got.filter("kept").count() == 101
    assert got.agg(F.max("group_size")).first()[0] == 3000


def test_drop_keeps_columns_and_one_repeat(spark):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("_key", F.lit("mine"))
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and {r["_key"] for r in kept.collect()} == {"mine"}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["2", "1", "None", "5", "6", "3", "11"]
    )


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert exact_dedup.duplicate_classes(docs).count() == 0
    assert exact_dedup.drop_duplicates(docs).count() == 0
    assert near_join.near_duplicates(docs).count() == 0
    assert near_join.drop_near_duplicates(docs).columns == docs.columns


def shingles(text, k):
    words = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        either = len(sets[a]) + len(sets[b]) - both
        if either and 100 * both >= percent * either:
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, families=6, members=14, words=60):
    """Families of texts at all distances around the threshold, with a passage they share."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(12)]
    rows, number = [], 0
    for family in range(families):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice((5, 8, 20, words, 3 * words)))]
        for _ in range(members):
            text = list(base)
            for _ in range(rnd.randrange(5)):
                at = rnd.randrange(len(text))
                kind = rnd.randrange(3)
                if kind == 0:
                    text[at] = f"n{rnd.randrange(9)}"
                elif kind == 1:
                    text.insert(at, f"n{rnd.randrange(9)}")
                elif len(text) > 1:
                    del text[at]
            if rnd.random() < 0.3:
                text += passage
            rows.append((number * 3 % 1009, " ".join(text)))
            number += 1
    rows += [(2000, None), (2001, ""), (2002, "one"), (2003, "ONE"), (2004, "one two"), (None, rows[0][1])]
    rows += [rows[5], (2005, "Z " * 300), (2006, "z " * 400)]
    return rows


@pytest.mark.parametrize(("seed", "k", "percent", "rare", "block"), [(1, 4, 85, 32, 256), (2, 4, 85, 2, 4), (3, 5, 80, 2, 3), (4, 1, 80, 1, 4), (5, 2, 90, 3, 5), (6, 3, 80, 4, 8)])
def test_components_equal_brute_force(spark, seed, k, percent, rare, block):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("x")).withColumn("n", F.lit(1))
    got = near_join.near_duplicates(docs, k=k, percent=percent, rare=rare, block=block).collect()
    found = sorted((tuple(r) for r in got), key=str)
    assert found == brute_components(rows, k, percent)


def test_drop_near_duplicates(spark):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, DOCS).withColumn("_key", F.lit(5))
    kept = near_join.drop_near_duplicates(docs)
    expected = [d for d, _, c in brute_components(rows, 5, 80) if d == c]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, expected))
    assert kept.columns == docs.columns


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(300, 300), (None, 4)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {300: 300}


def test_percent_is_checked(spark):
    with pytest.raises(ValueError, match="percent"):
        near_join.near_duplicates(spark.createDataFrame([(1, "a")], DOCS), percent=70)
