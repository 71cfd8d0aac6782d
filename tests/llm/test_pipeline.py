"""The pipeline against its stages by brute force, and the registered queries."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from storylake.llm import mixing, quality
from storylake.llm.queries import GOOD_QUALITY, ORACLES, QUERIES, cyclic_weights
from test_dedup_and_near import brute_classes, brute_components
from tools.check_parity import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    good, note = compare(spark, connect(SF_DIR), SF_DIR, key)
    assert good, note


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(P.STAGES)
    run = lambda name, df: stages[name](spark, df, SF_DIR).cache()
    good = run("quality classifier", docs)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.fit_quality(docs, labels.filter(~quality.held_out()))
    scored = quality.score_quality(docs, model)
    assert rows(good) == rows(scored.filter(F.col("score") >= GOOD_QUALITY).drop("score"))
    assert good.columns == docs.columns

    distinct = run("exact dedup", good)
    pairs = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert ids(distinct) == sorted(i for i, _, _, kept in brute_classes(pairs) if kept)

    apart = run("n-gram Jaccard join", distinct)
    pairs = [(r["doc_id"], r["text"]) for r in distinct.collect()]
    assert ids(apart) == sorted(i for i, _, c in brute_components(pairs, 5, 80) if i == c)

    mixed = run("mixing sources", apart)
    result, _ = mixing.mix(apart, "doc_id", size=mixing.word_count(F.col("text")), sources=F.array("source"), weights=cyclic_weights)
    assert ids(mixed) == sorted(r["id"] for r in result.collect() for _ in range(r["copies"]))
    assert mixed.columns == docs.columns

    coded = run("BPE encoding and decoding", mixed)
    assert ids(coded) == ids(mixed) and coded.filter("not intact or n_tokens <> size(ids)").count() == 0
    assert ids(P.run(spark, SF_DIR)) == ids(coded)


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def rows(df):
    return sorted(map(str, df.collect()))


def test_stages_take_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (900001, None, "en", None, 0), (900002, "", None, "src1", 0), (900002, "", None, "src1", 0)],
        docs.schema,
    )
    df = docs.union(odd).withColumn("_key", F.lit(1)).withColumn("_score", F.lit(2))
    for name, stage in P.STAGES:
        out = stage(spark, df, SF_DIR)
        if name != "BPE encoding and decoding":
            assert out.columns == df.columns, name
        out.collect()
        assert stage(spark, df.filter("false"), SF_DIR).count() == 0, name
