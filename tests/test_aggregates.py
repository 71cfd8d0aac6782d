import pandas as pd
import pytest
from pyspark.sql import functions as F

from storylake.operators import aggregates as G
from storylake.operators.aboutness import (
    aboutness_summary,
    filter_aboutness,
    score_aboutness,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_top_values_of_scalars_and_lists(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a",), ("c",)], "v string")
    assert rows(G.top_values(df, "v", 2)) == [("a", 2), ("b", 2)]
    assert rows(G.top_values(df, "v", 0)) == []
    lists = spark.createDataFrame([(["x", "x", "y"],), (["y"],), ([],), (None,)], "v array<string>")
    assert rows(G.top_values(lists, "v")) == [("y", 2), ("x", 1)]
    numbers = spark.createDataFrame([(1.5,), (float("nan"),), (1.5,)], "v double")
    assert rows(G.top_values(numbers, "v")) == [(1.5, 2)]
    with pytest.raises(ValueError, match="absent"):
        G.top_values(df, "absent")


ENTITIES = [
    ([("Paris", "GPE"), ("Paris", "GPE"), ("Paris", "PERSON"), ("UN", "ORG")],),
    ([("Paris", "PERSON"), (None, "ORG")],),
    ([("Paris", "PERSON"), ("Rome", "GPE"), ("Rome", "GPE")],),
    ([],),
    (None,),
]


@pytest.fixture
def tagged(spark):
    return spark.createDataFrame(ENTITIES, "entities array<struct<text:string,type:string>>")


def test_top_entities(tagged):
    assert rows(G.top_entities(tagged, top_n=-1)) == [
        ("Paris", "PERSON", 5, 60.0, 3),
        ("Rome", "GPE", 2, 20.0, 1),
        ("UN", "ORG", 1, 20.0, 1),
    ]
    assert rows(G.top_entities(tagged, top_n=1, sort_by="percentage"))[0][0] == "Paris"
    assert rows(G.top_entities(tagged, filter_type="GPE")) == [
        ("Paris", "GPE", 2, 20.0, 1),
        ("Rome", "GPE", 2, 20.0, 1),
    ]
    with pytest.raises(ValueError, match="sort_by"):
        G.top_entities(tagged, sort_by="other")


def test_top_entities_of_a_long_article(spark):
    # 200 000 mentions in one row: comparing each with all others would not end.
    one = spark.range(1).select(
        F.transform(
            F.sequence(F.lit(0), F.lit(199_999)),
            lambda i: F.struct(
                F.concat(F.lit("n"), i % 50_000).alias("text"),
                F.when(i % 3 > 0, "ORG").alias("type"),
            ),
        ).alias("entities")
    )
    found = G.top_entities(one, top_n=-1)
    assert found.agg(F.count("*"), F.min("count"), F.max("count"), F.max("document_count")).first() == (
        50_000, 4, 4, 1,
    )


def test_histogram_equals_pandas_cut(spark):
    scores = [0.0, 0.05, 0.1, 0.1000001, 0.3, 0.5, 0.7, 0.95, 1.0, 1.0, None, -0.1, 1.2]
    df = spark.createDataFrame([(s,) for s in scores], "about_score double")
    binned = pd.cut(
        pd.Series([s for s in scores if s is not None]), [i / 10 for i in range(11)], include_lowest=True
    )
    expected = binned.value_counts().sort_index().tolist()
    got = sorted(rows(G.score_histogram(df)))
    assert [r[3] for r in got] == expected
    assert [r[0] for r in got] == list(range(10))


def test_aboutness(stories):
    df = stories(
        {"title": "Gaza talks", "text": "Nothing else here."},
        {"title": "x", "text": "gaza and again Gaza, finally"},
        {"title": "x", "text": "Gaza opens a long text about the weather and the sea"},
        {"title": "x", "text": "A long text about the weather and the sea near Gaza"},
        {"title": None, "text": None},
    )
    scored = score_aboutness(df, " Gaza ")
    got = {r["ingest_seq"]: (r["about_is_about"], r["about_score"]) for r in scored.collect()}
    assert got == {
        0: (True, 0.5),
        1: (True, 0.65),
        2: (True, 0.5),
        3: (False, 0.15),
        4: (False, 0.0),
    }
    assert sorted(r[0] for r in filter_aboutness(scored, 0.6).collect()) == [1]
    summary = aboutness_summary(scored, 0.5, "Gaza").first()
    assert (summary["total_scored"], summary["passed_count"], summary["discarded_count"]) == (5, 3, 2)
    assert sum(summary["score_histogram_counts"]) == 5
    assert summary["score_histogram_edges"] == [i / 10 for i in range(11)]


def test_failed_rows_never_pass(spark):
    df = spark.createDataFrame(
        [(True, 0.9), (None, None), (False, 0.9)], "about_is_about boolean, about_score double"
    )
    assert filter_aboutness(df, 0.5).count() == 1
    summary = aboutness_summary(df, 0.5, "t").first()
    assert (summary["total_scored"], summary["passed_count"]) == (3, 1)
    assert sum(summary["score_histogram_counts"]) == 2


def test_usage_cost(spark):
    df = spark.createDataFrame(
        [((1_000_000, 500_000, 1_500_000),), ((None, 500_000, None),), (None,)],
        "usage struct<prompt_tokens:long,completion_tokens:long,total_tokens:long>",
    )
    got = G.usage_cost(df, model="openai/gpt-oss-120b").first()
    assert (got["total_requests"], got["total_prompt_tokens"], got["total_completion_tokens"]) == (
        2,
        1_000_000,
        1_000_000,
    )
    assert got["total_cost_usd"] == pytest.approx(0.75)
    unknown = G.usage_cost(df, model="someone/else").first()
    assert unknown["total_cost_usd"] is None and unknown["total_requests"] == 2
