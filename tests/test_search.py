from datetime import date

import pytest
from pyspark.sql import functions as F

from storylake.operators import search as S
from storylake.operators.selection import limit_after_dedup, limit_before_dedup, random_sample
from storylake.params import SearchTerms


def ids(df):
    return sorted(r[0] for r in df.select("ingest_seq").collect())


def test_terms_are_whole_tokens_in_title_or_text(stories):
    df = stories(
        {"title": "Vaccine news", "text": "nothing"},
        {"title": "x", "text": "All about vaccines"},
        {"title": "x", "text": "the VACCINE, works"},
        {"title": None, "text": "vaccine and flu"},
    )
    assert ids(S.search_terms(df, all_of=["vaccine"])) == [0, 2, 3]
    assert ids(S.search_terms(df, all_of=["vaccine"], none_of=["flu"])) == [0, 2]
    assert ids(S.search_terms(df, any_of=["vaccines", "flu"])) == [1, 3]
    assert ids(S.search_terms(df, any_of=["Vaccine works"])) == [2]
    with pytest.raises(ValueError):
        S.search_terms(df, all_of=["!!"])


def test_phrase_does_not_cross_from_title_to_text(stories):
    df = stories({"title": "climate", "text": "change is here"})
    assert ids(S.search_terms(df, all_of=["climate change"])) == []


def brute_repeated(words, term, mentions, slop):
    at = [i for i, w in enumerate(words) if w == term]
    spans = (at[i + mentions - 1] - at[i] for i in range(len(at) - mentions + 1))
    return any(span <= slop for span in spans)


def test_proximity_equals_brute_force(stories):
    texts = [
        "v a v b v",
        "v a a a v a a a v v",
        "v",
        "",
        "a b c",
        "v v v v",
        "x v y y v y v",
        None,
    ]
    df = stories(*[{"text": t} for t in texts])
    for mentions in (1, 2, 3, 4):
        for slop in (0, 1, 2, 4, 8):
            expected = [
                i
                for i, t in enumerate(texts)
                if brute_repeated((t or "").split(), "v", mentions, slop)
            ]
            assert ids(S.search_proximity(df, "V", mentions, slop)) == expected, (mentions, slop)


def test_date_range_reaches_the_scan(spark, tmp_path, stories):
    path = str(tmp_path / "a.parquet")
    stories({"day": 1}, {"day": 5}, {"day": None}, {"day": 9}).write.parquet(path)
    found = S.filter_date_range(spark.read.parquet(path), date(2024, 1, 1), date(2024, 1, 5))
    assert ids(found) == [0, 1]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(publish_date" in plan and "LessThanOrEqual(publish_date" in plan


def test_scope_is_a_union_of_sources_and_collections(spark, stories):
    df = stories(*[{"media_name": m} for m in ("a", "b", "c", "d")])
    members = spark.createDataFrame(
        [(1, "b"), (1, "c"), (2, "c")], "collection_id int, media_name string"
    )
    assert ids(S.filter_scope(df)) == [0, 1, 2, 3]
    assert ids(S.filter_scope(df, ["a"])) == [0]
    assert ids(S.filter_scope(df, ["a"], [1], members)) == [0, 1, 2]
    assert ids(S.filter_scope(df, [], [2], members)) == [2]
    with pytest.raises(ValueError):
        S.filter_scope(df, [], [2])


def test_patterns_and_mask(spark):
    df = spark.createDataFrame([("Mamdani won",), ("the moon",), (None,)], "s string")
    got = df.select(
        S.any_pattern(F.col("s"), None),
        S.any_pattern(F.col("s"), ["MAMDANI", "sun"]),
        S.mention_mask(F.col("s"), "m.o"),
        S.mention_mask(F.col("s"), "m.o", literal=True),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, True, False, False),
        (True, False, True, False),
        (True, False, False, False),
    ]


def test_limits_have_a_total_order(stories):
    df = stories({"day": 9}, {"day": None}, {"day": 2}, {"day": 2}, {"day": 1}).repartition(5)
    assert ids(limit_before_dedup(df, 2)) == [0, 1]
    assert ids(limit_before_dedup(df, 0)) == [0, 1, 2, 3, 4]
    assert ids(limit_after_dedup(df, 2)) == [2, 4]
    assert ids(limit_after_dedup(df, 4)) == [0, 2, 3, 4]
    assert ids(limit_after_dedup(df, None)) == [0, 1, 2, 3, 4]


def test_sample_does_not_depend_on_partitions(stories):
    df = stories(*[{"day": 1}] * 40)
    one = ids(random_sample(df.repartition(1), 10, seed=3))
    assert one == ids(random_sample(df.repartition(7), 10, seed=3))
    assert len(one) == 10 and one != ids(random_sample(df, 10, seed=4))


def test_apply_search(stories):
    df = stories({"text": "a b a"}, {"text": "a c"}, {"text": "b"})
    terms = SearchTerms(any_of=("a", "b"), none_of=("c",), near=(("a", 2, 5),))
    assert ids(S.apply_search(df, terms)) == [0]
    assert terms.describe() == '(a OR b) AND NOT c AND "a a"~5'


@pytest.mark.parametrize(
    ("terms", "slop", "expected"),
    [
        (["side effects", "vaccine"], 3, {0}),
        (["side effects", "vaccine"], 7, {0, 1}),
        (["vaccine", "vaccine", "vaccine"], 4, {2}),
        (["vaccine", "vaccine", "vaccine"], 3, set()),
        (["vaccine"], 0, {0, 1, 2, 3}),
        (["effects side"], 9, set()),
        (["coast", "storm"], 1, {4}),
    ],
)
def test_words_and_phrases_near_each_other(stories, terms, slop, expected):
    df = stories(
        {"text": "The vaccine has side effects."},
        {"text": "side-effects, one two three four five vaccine"},
        {"text": "vaccine a vaccine b vaccine"},
        {"text": "side of vaccine effects"},
        {"title": "Storm coast", "text": "storm far from the coast"},
        {"text": None},
    )
    got = {r["ingest_seq"] for r in S.search_proximity_terms(df, terms, slop).collect()}
    assert got == expected


def test_phrases_repeat(stories):
    df = stories({"text": "side effects and side effects"}, {"text": "side effects, side"})
    assert [r["ingest_seq"] for r in S.search_proximity(df, "Side Effects", 2, 3).collect()] == [0]
    with pytest.raises(ValueError):
        S.search_proximity(df, "?!", 2, 3)


def test_proximity_takes_the_tokens_of_a_text_once(spark):
    near = S.near_each_other(F.col("text"), ["that", "of the", "That"], 30)
    again = S.repeated_within(F.col("text"), "of the", 2, 30)
    for condition in (near, again):
        plan = spark.createDataFrame([("of the",)], "text string").select(condition.alias("hit"))._jdf.queryExecution()
        assert plan.analyzed().toString().count("regexp_extract_all(") == 1
