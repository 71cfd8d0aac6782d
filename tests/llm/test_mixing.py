"""Mixing: shares, flow and selection."""

import random

import pytest
from pyspark.sql import functions as F

from storylake.llm import mixing
from storylake.llm.support import shared_table


def test_shares_are_capped_and_reshared():
    shares = mixing.capped_shares({"a": 10, "b": 1000, "c": 1000}, {"a": 3, "b": 1, "c": 2}, 3)
    assert shares == pytest.approx({"a": 30, "b": 660, "c": 1320})
    assert mixing.capped_shares({"a": 0, "b": 5}, {"a": 9, "b": 1}, 3) == {"a": 0, "b": 5}
    assert mixing.capped_shares({}, {}, 3) == {}


def test_flow_repeats_only_what_it_must():
    # Source b stands only in pattern 2, a also alone: all of b's pattern must serve b first.
    flow = mixing.route({1: (10, ["a"]), 2: (10, ["a", "b"])}, {"a": 15, "b": 10}, 3)
    assert flow[2]["b"] == 10 and flow[1]["a"] + flow[2]["a"] == 15
    assert flow[1]["a"] in (10, 15) and max(sum(f.values()) for f in flow.values()) <= 15
    flow = mixing.route({1: (10, ["a"]), 2: (10, ["a", "b"])}, {"a": 10, "b": 10}, 3)
    assert flow == {1: {"a": 10}, 2: {"a": 0, "b": 10}}
    assert mixing.route({1: (10, ["a"])}, {"a": 99}, 3) == {1: {"a": 30}}


def least_cost(patterns, quotas, passes):
    """Brute force over unit flows: (most flow, least cost)."""
    best = (0, 0)

    def cost(size, words):
        return sum(max(0, min(words - size * e, size)) * e for e in range(passes))

    def go(rest, left, moved, paid):
        nonlocal best
        if not rest:
            best = max(best, (moved, -paid))
            return
        (size, sources), *others = rest

        def give(at, spare, mine):
            if at == len(sources):
                go(others, dict(left), moved + mine, paid + cost(size, mine))
                return
            s = sources[at]
            for amount in range(min(spare, left[s]) + 1):
                left[s] -= amount
                give(at + 1, spare - amount, mine + amount)
                left[s] += amount

        give(0, size * passes, 0)

    go(list(patterns.values()), dict(quotas), 0, 0)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_of_least_cost(seed):
    rnd = random.Random(seed)
    patterns = {p: (rnd.randint(0, 3), rnd.sample("abc", rnd.randint(1, 3))) for p in range(3)}
    quotas = {s: rnd.randint(0, 4) for s in "abc"}
    flow = mixing.route(patterns, quotas, 2)
    words = {p: sum(f.values()) for p, f in flow.items()}
    paid = sum(max(0, words[p] - size) for p, (size, _) in patterns.items())
    assert (sum(words.values()), -paid) == least_cost(patterns, quotas, 2)
    assert all(words[p] <= 2 * size for p, (size, _) in patterns.items())
    assert all(sum(f.get(s, 0) for f in flow.values()) <= quotas[s] for s in "abc")


def weights(names):
    return [i % 3 + 1 for i in range(len(names))]


def run(docs, **more):
    return mixing.mix(docs, "doc_id", size=mixing.word_count(F.col("text")), sources=F.array("source"), weights=weights, **more)


def test_targets_are_met(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.choice((1, 3, 10, 40, 400)), f"s{rnd.randrange(4)}" if rnd.random() < 0.6 else None) for i in range(900)]
    rows += [(1000, None, "s1"), (1001, "", "s2"), (None, "a b", "s1"), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("pid", F.lit(1))
    mixed, sources = run(docs)
    once = sorted(map(str, mixed.collect()))
    assert len(once) == len(rows) and once == sorted(map(str, run(docs.repartition(5))[0].collect()))
    for row in sources.collect():
        assert abs(row["taken"] - row["target"]) <= 0.01 * row["target"], row
    assert sum(r["target"] for r in sources.collect()) == pytest.approx(sum(r["source_size"] for r in sources.collect()))
    assert mixed.filter("copies > 3 or (size = 0 and copies > 0)").count() == 0
    assert mixed.filter("copies > 0").count() > 0


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(200)] + [(999, "w", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    mixed, sources = mixing.mix(docs, "doc_id", size=mixing.word_count(F.col("text")), sources=F.col("of"), weights=lambda names: [1] * len(names))
    assert {r["source"]: r["source_size"] for r in sources.collect()} == {"a": 2000, "b": 1000}
    for row in sources.collect():
        assert abs(row["taken"] - row["target"]) <= 10
    served = mixed.select("sources", F.explode("served").alias("part")).filter("part.copies > 0")
    assert served.filter(~F.array_contains("sources", F.col("part.source"))).count() == 0


def test_rows_repeat_as_taken_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (2, "a", "t"), (3, "b", "t")], "doc_id long, text string, source string").withColumn("_key", F.lit(0))
    options = {"size": mixing.word_count(F.col("text")), "sources": F.array("source"), "weights": weights}
    out = mixing.mix_documents(docs, **options)
    copies = {r["id"]: r["copies"] for r in run(docs)[0].collect()}
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
    assert mixing.mix_documents(docs.filter("false"), **options).count() == 0


@pytest.mark.parametrize("ident", [None, 7])
def test_rows_of_one_id_are_documents_of_their_own(spark, ident):
    """Targets are met, and no row is taken more than three times, by mix and by mix_documents."""
    rows = [(ident, "w " * (10 + i % 30), "a") for i in range(200)]
    rows += [(1000 + i, "w " * (5 + i % 40), "bc"[i % 2]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", F.lit(1))
    options = {
        "size": mixing.word_count(F.col("text")),
        "sources": F.array("source"),
        "weights": lambda names: [i % 3 + 1 for i in range(len(names))],
    }
    result, summary = mixing.mix(docs, "doc_id", **options)
    got = result.collect()
    assert len(got) == len(rows) and max(r["copies"] for r in got) <= 3
    targets = {r["source"]: r["target"] for r in summary.collect()}
    for r in summary.collect():
        assert abs(r["taken"] - r["target"]) <= 45
    taken = mixing.mix_documents(docs, **options)
    assert taken.columns == docs.columns
    words = {r["source"]: r["w"] for r in taken.groupBy("source").agg(F.sum(options["size"]).alias("w")).collect()}
    assert words.keys() == targets.keys()
    for source, target in targets.items():
        assert abs(words[source] - target) <= 45
    again, _ = mixing.mix(docs.repartition(7), "doc_id", **options)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_mixing_starts_no_further_python_workers(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(40)], "doc_id int, text string, source string")
    docs = shared_table(docs, "docs")

    def refused(*args, **more):
        raise AssertionError("a list became an RDD")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    mixed = mixing.mix_documents(
        docs, size=mixing.word_count(F.col("text")), sources=F.array("source"), weights=lambda names: [1] * len(names)
    )
    assert mixed.count() >= 1
