"""Sketch dedup, norm-bucket search and hard negatives against brute force on small tables."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storylake.llm import hard_negatives, norm_search, sketch_dedup, support

DOCS = "doc_id long, text string"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- sketch dedup -------------------------------------------------------------------------


def shingles(text, k):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((d, len(sets[i]), least.get(find(i)), d == least.get(find(i))) for i, (d, _) in enumerate(rows)),
        key=str,
    )


def found_components(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).withColumn("place", F.lit(1)).withColumn("sign", F.lit("x"))
    got = sketch_dedup.near_duplicates(docs.repartition(3), **options).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=str)


def family(seed, copies, words, edits):
    """A text and copies of it with a few words changed."""
    dice = random.Random(seed)
    base = [f"w{dice.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        copy = list(base)
        for _ in range(dice.randrange(edits + 1)):
            copy[dice.randrange(words)] = f"v{dice.randrange(5000)}"
        out.append(" ".join(copy))
    return out


def test_sketch_fills_and_estimates():
    dice = np.random.default_rng(1)
    for size in (1, 2, 30, 400, 20_000):
        a = dice.integers(0, 2**63, size, dtype=np.uint64)
        b = np.concatenate([a[: size // 2], dice.integers(0, 2**63, size - size // 2, dtype=np.uint64)])
        hashes = np.concatenate([a, b])
        sketch = sketch_dedup.fast_sketch(hashes, np.array([0, size, size, 2 * size]), 352)
        assert (sketch[[0, 2]] != sketch_dedup._EMPTY).all() and (sketch[1] == sketch_dedup._EMPTY).all()
        jaccard = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        assert abs((sketch[0] == sketch[2]).mean() - jaccard) < 0.12
        # A sketch depends on its own set only, however many rounds are computed at once.
        alone = sketch_dedup.fast_sketch(a, np.array([0, size]), 352)
        assert (alone[0] == sketch[0]).all()


def test_bands_guarantee():
    for percent in (80, 85, 95):
        bands = sketch_dedup.bands_for(percent)
        assert (1 - (percent / 100) ** sketch_dedup.BAND_ROWS) ** bands <= sketch_dedup.MISS
    assert sketch_dedup.bands_for(100) == 1


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two"),
    (None, "one two"), (None, "alone here with no id at all"), (None, "alone here with no id at all"),
    (9, "É é"), (10, "é É"), (11, "a b c d"), (11, "a b c d"), (12, "long " * 30_000), (13, "LONG " * 29_999),
]


@pytest.mark.parametrize("block", [256, 4])
def test_near_duplicates_match_brute_force(spark, block):
    texts = family(1, 25, 60, 3) + family(2, 3, 200, 4) + family(3, 8, 12, 1)
    rows = ODD + [(100 + 7 * i % 97, t) for i, t in enumerate(texts)]
    for k, percent in ((3, 85), (5, 80)):
        got = found_components(spark, rows, k=k, percent=percent, block=block)
        assert got == brute_components(rows, k, percent)


def test_large_family_in_many_blocks(spark):
    """Half of the pairs of the family do not link; nothing is lost across blocks."""
    rows = list(enumerate(family(5, 160, 70, 3) + [f"other {i} text {i * 7} here" for i in range(40)]))
    assert found_components(spark, rows, k=3, percent=85, block=8) == brute_components(rows, 3, 85)


def test_bins_bound_what_sets_share():
    """Never less than sets share, also where counts stop; pairs far below the threshold drop out."""
    dice = np.random.default_rng(3)
    for size, common in ((1, 0), (40, 35), (500, 430), (500, 100), (100_000, 90_000)):
        pool = np.unique(dice.integers(0, 2**63, 2 * size + 9).astype(np.uint64))[: 2 * size - common]
        both = np.concatenate([pool[:size], pool[size - common :]])
        bins = sketch_dedup.bin_counts(both, np.array([0, size, 2 * size]))
        most = sketch_dedup.most_shared(bins[:1], bins[1:], np.array([size]), np.array([size]))[0]
        assert common <= most <= size
        if (size, common) == (500, 100):
            assert 100 * most < 85 * (2 * size - most)
    assert sketch_dedup.bin_counts(np.zeros(0, np.uint64), np.array([0, 0])).sum() == 0


def test_texts_and_sets_without_a_partner_are_not_moved(spark):
    """Only rows that may meet go into a join: all that do, and few others."""
    wanted = spark.range(0, 4000, 4).withColumnRenamed("id", "key")
    rows = spark.range(8000).select(F.col("id").alias("key"), F.lit("text").alias("_part"))
    rows = rows.union(spark.sql("select cast(null as bigint), 'none'"))
    found = support.may_meet(rows, wanted, "key")
    assert found.columns == rows.columns
    keys = [r["key"] for r in found.collect()]
    assert set(range(0, 4000, 4)) <= set(keys) and len(keys) == len(set(keys)) < 1500
    assert support.may_meet(rows, wanted.filter("key < 0"), "key").count() == 0


def test_sketch_drop_and_empty(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("_place", F.lit("mine"))
    kept = sketch_dedup.drop_near_duplicates(docs, k=3, percent=85)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "6", "None", "None", "9", "10", "11", "11", "12"])
    empty = spark.createDataFrame([], DOCS)
    assert sketch_dedup.near_duplicates(empty).count() == 0
    assert sketch_dedup.drop_near_duplicates(empty).columns == empty.columns
    with pytest.raises(ValueError):
        sketch_dedup.near_duplicates(docs.withColumn("doc_id", F.lit("a")))


# --- ranked search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().translate(LOWER).decode())


def brute_search(docs, items, k):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = Counter(t for _, ts in held for t in set(ts))
    out = []
    for item, text in set(items):
        scores = []
        for i, ts in held:
            tf, m = Counter(ts), 50 + (50 * len(ts) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in set(terms(text)) if tf[t]
            )
            if score > 0:
                scores.append((-score, i is None, i))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item, rank + 1, s[2], -s[0]) for rank, s in enumerate(best)]
    return sorted(out, key=str)


def made_documents(seed, n):
    dice = random.Random(seed)
    words = [f"t{i}" for i in range(300)]
    chance = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(dice.choices(words, chance, k=dice.randrange(1, 80)))) for i in range(n)]
    return docs, [" ".join(dice.choices(words, k=12)) for _ in range(25)]


@pytest.mark.parametrize(("bucket", "queries"), [(1024, 4096), (16, 7)])
def test_search_matches_brute_force(spark, bucket, queries):
    docs, asked = made_documents(3, 600)
    docs += [
        (None, "t1 t2"), (700, None), (701, ""), (702, " .,;"), (703, "T299 É ß"), (704, "T299 É ß"),
        (704, "T299 É ß"), (705, "t298 " * 40_000), (-5, "t299 É ß"),
    ]
    items = [(i, t) for i, t in enumerate(asked)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "É t299"), (53, "É t299"), (53, "t298"), (None, "t1"), (54, "absent")]
    table = spark.createDataFrame(docs, DOCS).withColumn("length", F.lit(3)).repartition(5)
    want = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    for k in (3, 50):
        got = norm_search.search(table, want, k=k, bucket=bucket, queries=queries)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_search(docs, items, k)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], DOCS)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert norm_search.search(d, i).count() == 0
    assert norm_search.search(docs, items).count() == 1


def test_buckets_and_coordinates_prune(spark):
    """With a threshold in place, light terms bring in no candidates."""
    queries = norm_search.Queries.build([np.array([0, 1])], np.array([9000, 10]))
    best = norm_search._Best(1, 1, np.array([9000 * 100]))
    touched = []
    best.add = lambda query, scores, ids: touched.extend(ids.tolist())
    ids, offsets = np.array([5, 6, 7]), np.array([0, 1, 3, 4])
    terms_, impacts = np.array([1, 0, 1, 0]), np.array([900, 100, 900, 99])
    norm_search.search_bucket(queries, best, ids, offsets, terms_, impacts)
    assert touched == [6]


# --- hard negatives -----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_mine(rows):
    held = set()
    for i, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        held.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in vec), label))
    out = []
    for a in held:
        if a[0] is None or a[0] % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[1], r[1], strict=True)), r[0] is None, r[0] or 0, r)
            for r in held if len(r[1]) == len(a[1])
        ]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[3][2] == a[2] and s[3][0] != a[0]][:5]:
            fits = [s for s in scored if s[3][2] != a[2] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out += [(a[0], p[3][0], r + 1, s[3][0], -p[0], -s[0]) for r, s in enumerate(fits[:3])]
    return sorted(out, key=str)


def made_vectors(seed, n, d=8):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(5, d))
    rows = []
    for i in range(n):
        vec = centres[i % 5] + dice.normal(size=d) * 0.4
        rows.append((i, [float(np.float32(x)) for x in vec / np.linalg.norm(vec) * dice.uniform(0.5, 2)], int(dice.integers(4))))
    return rows


@pytest.mark.parametrize(("bucket", "anchors"), [(1024, 4096), (32, 3)])
def test_mining_matches_brute_force(spark, bucket, anchors):
    rows = made_vectors(1, 700)
    nan, inf = float("nan"), float("inf")
    rows += [
        (750, None, 1), (751, [1.0] * 8, None), (800, [nan] * 8, 1), (801, [1.0] * 7 + [inf], 1),
        (802, [1.0] * 7 + [None], 2), (850, [0.0] * 8, 1), (851, [0.0] * 8, 2), (900, [1.0, 2.0], 1),
        (901, [1.0, 2.5], 1), (902, [1.0, 1.0], 2), (903, [0.5, 0.5], 3), (903, [0.5, 0.5], 3),
        (904, [], 1), (950, [], 1), (905, [], 2), (None, rows[0][1], 1), (None, rows[0][1], 3),
        (1000, rows[7][1], rows[7][2]), (1001, rows[7][1], rows[7][2]),
    ]
    table = spark.createDataFrame(rows, VECTORS).withColumn("vec", F.lit(1)).withColumn("id", F.lit("x"))
    got = hard_negatives.mine(table.repartition(4), F.col("vec_id") % 50 == 0, bucket=bucket, anchors=anchors)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_mine(rows)


def test_feasible_ranges_keep_every_hit():
    rows = np.array([np.array(r[1]) * 256 for r in made_vectors(2, 500, d=6)]).astype(np.int64)
    held = hard_negatives.Bucket(np.arange(500), np.zeros(500), rows)
    narrowed = 0
    for anchor in rows[:40]:
        length = float(np.sqrt((anchor**2).sum()))
        scores = rows @ anchor
        for need in np.percentile(scores, [60, 90, 99, 100]).astype(int).tolist():
            found = held.candidates(anchor, length, need, 3)
            if found is not None:
                narrowed += len(found) < 400
                assert set(np.flatnonzero(scores >= need)) <= set(found.tolist())
    assert narrowed > 20


@pytest.mark.parametrize("dense", [0.0, 0.25, 1.0])
def test_anchors_are_scanned_together(dense, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TOGETHER", 16)
    rows = np.array([np.array(r[1]) * 256 for r in made_vectors(3, 400, d=6)] + [[0] * 6]).astype(np.int64)
    held = hard_negatives.Bucket(np.arange(401), np.zeros(401), rows)
    asking = np.concatenate([rows[:60], rows[400:]])  # the last one has no length
    anchors = hard_negatives.Anchors.build(range(61), range(61), [0] * 61, asking)
    scores = asking @ rows.T
    need = np.sort(scores, axis=1)[np.arange(61), np.arange(61) * 6]  # from the least score to the best
    need[5] = np.iinfo(np.int64).min
    parts = list(hard_negatives.scan(held, anchors, need, dense=dense))
    found = sorted((i, row, score) for part in parts for i, row, score in zip(*(x.tolist() for x in part), strict=True))
    assert found == [(i, r, scores[i, r]) for i, r in np.argwhere(scores >= need[:, None]).tolist()]
    assert len(parts) <= 5  # one of few candidates, four products
    assert all((np.diff(who) >= 0).all() for who, _, _ in parts)
    none = hard_negatives.Anchors.build([0, 1], [0, 1], [0, 0], np.zeros((2, 0)))
    empty = hard_negatives.Bucket(np.arange(3), np.zeros(3), np.zeros((3, 0), np.int64))
    hits = [part for part in hard_negatives.scan(empty, none, np.array([0, 1]))]
    assert [(w.tolist(), r.tolist(), s.tolist()) for w, r, s in hits] == [([0, 0, 0], [0, 1, 2], [0, 0, 0])]


def test_best_of_many_lists_at_once():
    dice = np.random.default_rng(4)
    best, kept = hard_negatives._Best(np.full(9, -50), 3), {i: [] for i in range(9)}
    for size in (1, 2, 400, 30, 1):
        lists = np.sort(dice.integers(0, 8, size))  # list 8 gets nothing
        scores, ids = dice.integers(-20, 20, size), dice.integers(0, 10, size)
        best.add(lists, scores, ids)
        for i, score, id_ in zip(lists.tolist(), scores.tolist(), ids.tolist(), strict=True):
            kept[i] = sorted([*kept[i], (-score, id_)])[:3]
        assert best.need.tolist() == [-kept[i][2][0] if len(kept[i]) == 3 else -50 for i in range(9)]
    got = best.batch({"anchor": np.arange(9) + 100}).to_pylist()
    assert [(r["anchor"], -r["score"], r["id"]) for r in got] == [(i + 100, *e) for i in range(9) for e in kept[i]]


def test_mining_of_empty_tables_and_long_vectors(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0
    large = spark.createDataFrame([(0, [3e38, 3e38], 1)], VECTORS)
    with pytest.raises(ValueError):
        hard_negatives.mine(large, F.col("vec_id") % 50 == 0)
