"""Curve search, quality classifier and license scan against brute force or held-out rows."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storylake.llm import ann_curves, license_scan, quality

VECTORS = "vec_id long, embedding array<float>"


def brute_nearest(rows, asks, k):
    sound = {
        i: np.array(v, dtype=np.float64)
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8
    }
    out = []
    for q in (i for i in sound if i % asks == 0):
        scored = sorted((-(sound[q] * sound[i]).sum(), i) for i in sound if i != q)
        out += [(q, r + 1, i) for r, (_, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors(n, seed):
    random_ = np.random.default_rng(seed)
    rows = [(i, random_.normal(size=8).astype(np.float32).tolist()) for i in range(n)]
    rows += [(10_000 + i, rows[3][1]) for i in range(40)]  # copies: ties to the smaller id
    rows += [(1, None), (None, rows[0][1]), (20_000, [0.0] * 8), (20_005, [None] + [1.0] * 7)]
    rows += [(20_010, [float("nan")] + [1.0] * 7), (20_015, [float("inf")] + [1.0] * 7), (20_020, [1.0])]
    return rows


def test_small_table_is_exact(spark):
    rows = vectors(300, 1)
    frame = spark.createDataFrame(rows, VECTORS).withColumn("label", F.lit(1)).withColumn("key", F.lit(1))
    got = ann_curves.nearest(frame, F.col("vec_id") % 5 == 0, k=7).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == brute_nearest(rows, 5, 7)
    values = dict((i, v) for i, v in rows if i is not None and i < 300 and v)
    for r in got[:50]:
        if r["query_id"] in values and r["vec_id"] in values:
            a, b = (np.array(values[r[c]], dtype=np.float64) for c in ("query_id", "vec_id"))
            assert r["score"] == (a * b).sum()


def test_recall_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann_curves, "BLOCK_VECTORS", 100)
    rows = [(i, v) for i, v in vectors(3000, 2) if i is not None and i < 3000 and v]
    got = ann_curves.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, k=20).collect()
    expected = {(q, i) for q, _, i in brute_nearest(rows, 50, 20)}
    assert len({(r["query_id"], r["vec_id"]) for r in got} & expected) >= 0.9 * len(expected)


def test_nearest_columns_are_those_of_a_stable_sort():
    random_ = np.random.default_rng(4)
    for _ in range(200):  # ties, and scores that are no number
        far = random_.integers(0, 4, size=random_.integers(1, 30, size=2)).astype(float)
        far[random_.random(far.shape) < random_.choice([0, 0.1, 0.8])] = np.nan
        for k in (1, 2, 5, 40):
            expected = np.argsort(far, axis=1, kind="stable")[:, :k]
            assert ann_curves._nearest_columns(far, k).tolist() == expected.tolist()


def test_a_block_is_searched_in_parts_of_bounded_size(monkeypatch):
    random_ = np.random.default_rng(5)
    ids, asking = random_.permutation(40), np.arange(100, 170)
    x, q = (random_.normal(size=(n, 8)).astype(np.float32) for n in (40, 70))
    entries = pa.table({"entry": ids, "vector": pa.array(list(x))})
    queries = pa.table({"query": asking, "sought": pa.array(list(q))})
    monkeypatch.setattr(ann_curves, "QUERIES_AT_ONCE", 16)
    got = ann_curves._best_of_block(5)(entries, queries).to_pylist()
    exact = (q.astype(float)[:, None, :] * x.astype(float)).sum(axis=2)
    expected = [(a, i, s) for a, row in zip(asking, exact) for s, i in sorted(zip(row, ids), key=lambda e: (-e[0], e[1]))[:5]]
    assert [(r["query"], r["entry"], r["score"]) for r in got] == expected
    assert ann_curves._best_of_block(5)(entries.slice(0, 0), queries).num_rows == 0
    assert ann_curves._best_of_block(5)(entries, queries.slice(0, 0)).num_rows == 0
    assert ann_curves._best_of_block(50)(entries, queries).num_rows == 70 * 40


def test_hilbert_keys_visit_neighbouring_cells():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = ann_curves.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert steps.tolist() == [1] * 511


def test_nothing_to_search(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert ann_curves.nearest(frame, F.lit(True)).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0])], VECTORS)
    assert ann_curves.nearest(one, F.lit(True)).count() == 0


def test_ids_that_repeat_and_vectors_under_several_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (3, None)]
    rows += [(None, [1.0, 1.0]), (4, [0.5, -0.0]), (4, [0.5, 0.0]), (5, [0.5, 0.0]), (6, [1.0]), (7, [0.0, 0.0])]
    rows += [(9, [-1.0, 3.0])]
    # The two vectors of id 0 ask together, and each of them has a place among the neighbours.
    expected = [(0, 1, 9, 3.0), (0, 2, 9, 3.0), (2, 1, 0, 2.0), (2, 2, 0, 2.0), (4, 1, 2, 1.0), (4, 2, 0, 0.5)]
    for kind in ("float", "double"):
        frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        got = ann_curves.nearest(frame, F.col("vec_id") % 2 == 0, k=2)
        assert sorted(tuple(r) for r in got.collect()) == expected


def scans_of(df, path):
    """How often a plan reads the files of a folder."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    files = [leaf for leaf in leaves if leaf.getClass().getSimpleName() == "LogicalRelation"]
    return sum(leaf.relation().location().rootPaths().mkString(" ").endswith(path) for leaf in files)


def test_vectors_stay_out_of_the_curves_and_rows_are_read_once(spark, tmp_path, monkeypatch):
    rows = [(i, v) for i, v in vectors(300, 3) if i is not None and v]
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/input")
    frame = spark.read.parquet(f"{tmp_path}/input")
    tables = {}

    def kept(df, name, write=ann_curves.shared_table):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(ann_curves, "shared_table", kept)
    for most, scans in ((300, 0), (30_000, 2)):  # without copies, and with them
        got = ann_curves.nearest(frame.filter(F.col("vec_id") < most), F.col("vec_id") % 5 == 0, k=7)
        assert scans_of(got, "/input") == scans
        assert not any("array" in kind for _, kind in tables["ann-curves"].dtypes)
        assert dict(tables["ann-entries"].dtypes)["vector"] == "array<float>"
        wanted = [(i, v) for i, v in rows if i < most]
        assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == brute_nearest(wanted, 5, 7)


def texts(n, seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("aeioubdklmnst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        good = rnd.random() < 0.7
        some = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        if not good:
            some = rnd.choice(([w.upper() + "!!" for w in some], [some[0]] * 40, [w + " |" for w in some]))
        rows.append((i, " ".join(some), int(good)))
    return rows


def test_classifier_on_rows_kept_out(spark):
    rows = texts(1500, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = docs.select("doc_id", "quality").filter(~quality.held_out())
    labels = labels.union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    model = quality.fit_quality(docs, labels)
    scored = quality.score_quality(docs.withColumn("id", F.lit(1)), model)
    kept_out = scored.filter(quality.held_out()).collect()
    assert len(kept_out) > 200
    assert np.mean([(r["score"] >= 0.3) == bool(r["quality"]) for r in kept_out]) > 0.97
    assert scored.columns == ["doc_id", "text", "quality", "id", "score"]
    again = quality.fit_quality(docs.repartition(3), labels)
    assert np.allclose(again.first, model.first, atol=1e-3)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x" * 200_000), (3, "é " * 90_000)], "doc_id long, text string")
    scores = [r["score"] for r in quality.score_quality(odd, model).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[2]


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    assert [r["score"] for r in quality.score_quality(docs, model).collect()] == [0.5]
    assert quality.score_quality(docs.filter("false"), model).count() == 0


def test_training_rows_are_bounded(spark):
    rows = texts(300, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    few = quality.fit_quality(docs, docs.select("doc_id", "quality"), training_rows=50)
    assert few.mean.shape == (2 * quality.DIMENSIONS,)


def test_temperature_calibrates():
    random_ = np.random.default_rng(3)
    logit = random_.normal(size=4000) * 2
    y = (random_.random(4000) < 1 / (1 + np.exp(-logit))).astype(float)
    assert quality._temperature(3 * logit, y) == pytest.approx(3, rel=0.15)


def brute_licenses(rows, containment):
    found = set()
    for i, text in rows:
        words = license_scan.words_of(text or "")
        for number, (_, notice) in enumerate(license_scan.NOTICES):
            wanted = license_scan.shingles_of(license_scan.words_of(notice))
            n = len(license_scan.words_of(notice))
            if any(
                len(wanted & license_scan.shingles_of(words[at : at + n])) / len(wanted) >= containment
                for at in range(max(1, len(words) - n + 1))
            ):
                found.add((i, number))
    return found


def test_licenses_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        words = [rnd.choice(("the", "license", "version", "released", "under", f"w{i}", "é")) for _ in range(rnd.randint(0, 300))]
        for _ in range(rnd.choice((0, 0, 1, 2))):
            _, notice = rnd.choice(license_scan.NOTICES)
            words.insert(rnd.randint(0, len(words)), rnd.choice((notice, notice.upper(), notice.replace(" ", "\n  "), notice.rpartition(" ")[0])))
        rows.append((i, " ".join(words)))
    rows += [(None, "Released under the MIT License."), (900, None), (901, ""), (902, "a"), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("mine"))
    got = license_scan.scan_licenses(docs, containment=1.0).collect()
    assert {(r["doc_id"], r["notice"]) for r in got} == brute_licenses(rows, 1.0)
    assert all(r["containment"] == 1.0 for r in got)
    loose = license_scan.scan_licenses(docs, containment=0.7).collect()
    assert {(r["doc_id"], r["notice"]) for r in loose} >= {(r["doc_id"], r["notice"]) for r in got}
    first = [r for r in got if r["doc_id"] is None]
    assert [(r["license"], r["first_word"]) for r in first] == [("MIT", 0)]


def test_no_texts_to_scan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan_licenses(docs).count() == 0
    with pytest.raises(ValueError, match="words"):
        license_scan.build_index([("X", "too short")])


def test_inserted_words_break_only_their_shingles(spark):
    """At the default containment: the real MIT text, and a notice with one and with many words more."""
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    )
    short = mit.replace('(the "Software")', "").replace(" ,", ",")
    notices = (("MIT", short),)
    docs = spark.createDataFrame(
        [(1, f"before it {mit}, including"), (2, short.replace("charge", "charge x y z v w")),
         (3, short.replace("charge", "a b").replace("copy", "c"))], "doc_id long, text string"
    )
    wanted = len(license_scan.shingles_of(license_scan.words_of(short)))
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs, notices).collect()}
    assert {i: r["containment"] for i, r in got.items()} == {1: (wanted - 2) / wanted, 2: (wanted - 2) / wanted}
    assert (got[1]["first_word"], got[1]["n_words"]) == (2, len(license_scan.words_of(mit)))
    exact = license_scan.scan_licenses(docs).filter("doc_id = 1").collect()
    assert [(r["license"], r["containment"]) for r in exact] == [("MIT", 1.0)]


def test_repeated_rows_do_not_use_up_members(spark):
    rows = [(1, [1.0, 0.5] * 4)] * 21 + [(i, [1.0, 0.5] * 4) for i in range(2, 9)] + [(0, [0.5, 1.0] * 4)]
    got = ann_curves.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0, k=5).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(i, i) for i in range(1, 6)]


def test_model_parts_reach_the_driver_as_arrow(spark, monkeypatch):
    """Vectors as Python objects take several times their size in the driver's memory."""
    docs = spark.createDataFrame([(i, f"some words {i % 7} here {'!!' * (i % 2)}") for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))

    def refuse(*_):
        raise AssertionError("rows as Python objects")

    for name in ("collect", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(docs), name, refuse)
    model = quality.fit_quality(docs, labels)
    assert model.words.any() and np.isfinite(model.mean).all()
