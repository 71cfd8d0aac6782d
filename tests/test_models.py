import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.operators import scoring as S
from storylake.operators import zeroshot as Z
from storylake.params import AboutnessParams, ArticleQuery, LabelParams
from storylake.session import shared_dir

OUT = T.StructType([T.StructField("n", T.LongType()), T.StructField("first", T.StringType())])
ITEM = T.StructType([T.StructField("text", T.StringType()), T.StructField("k", T.LongType())])


def one(frame):
    if frame["text"].isna().any():
        raise ValueError("no text")
    return pd.DataFrame({"n": frame["text"].str.len(), "first": frame["text"].str[:1]})


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "abc"), (2, None), (3, ""), (4, "xy")], "id long, text string"
    ).repartition(2)


def test_add_column_in_both_worlds(rows):
    df = S.add_column(rows, lambda t: F.length(t), ["text"], "n")
    assert {r["id"]: r["n"] for r in df.collect()} == {1: 3, 2: None, 3: 0, 4: 2}
    df = S.add_column(rows.limit(0), lambda t: t.str.len(), ["text"], "n", "long")
    assert df.columns == ["id", "text", "n"] and df.count() == 0
    df = S.add_column(rows, lambda i, t: i + t.str.len().fillna(0), ["id", "text"], "n", "double")
    assert {r["id"]: r["n"] for r in df.collect()} == {1: 4, 2: 2, 3: 3, 4: 6}
    with pytest.raises(ValueError, match="absent"):
        S.add_column(rows, F.length, ["absent"], "n")


def test_add_columns_stay_with_their_row(rows):
    kept = rows.filter("id >= 3")
    df = S.add_columns(kept, one, ["text"], OUT)
    assert sorted(tuple(r) for r in df.collect()) == [(3, "", 0, ""), (4, "xy", 2, "x")]
    with pytest.raises(Exception, match="lacks the columns"):
        S.add_columns(kept, lambda f: one(f)[["n"]], ["text"], OUT).collect()


def test_one_to_one_keeps_failed_rows(rows):
    got = {r["id"]: r for r in S.model_map_one(rows, lambda: one, ["text"], OUT).collect()}
    assert (got[1]["n"], got[1]["first"], got[1]["llm_error"]) == (3, "a", None)
    assert (got[2]["n"], got[2]["llm_error"]) == (None, "ValueError: no text")
    assert len(got) == 4


def test_models_that_run_later_get_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    counted = T.StructType([T.StructField("n", T.LongType())])

    def sizes(frame):
        return pd.DataFrame({"n": [len(frame)] * len(frame)})

    try:
        spark.conf.set(key, "10000")
        df = S.model_map_one(spark.range(0, 5000, 1, 1), lambda: sizes, ["id"], counted)
        assert {r["n"] for r in df.collect()} == {1000}
        spark.conf.set(key, "500")
        df = S.model_map_one(spark.range(0, 5000, 1, 1), lambda: sizes, ["id"], counted)
        assert {r["n"] for r in df.collect()} == {500}
    finally:
        spark.conf.set(key, before)


def test_all_rows_failing_keeps_the_schema(rows):
    def broken(frame):
        raise RuntimeError("down")

    df = S.model_map_one(rows, lambda: broken, ["text"], OUT)
    assert df.columns == ["id", "text", "n", "first", "llm_error"]
    assert [r["llm_error"] for r in df.collect()] == ["RuntimeError: down"] * 4


def many(frame):
    if frame["text"].isna().any():
        raise ValueError("no text")
    items = [[{"text": c, "k": i} for i, c in enumerate(t)] for t in frame["text"]]
    tokens = frame["text"].str.len()
    return pd.DataFrame(
        {"items": items, "prompt_tokens": tokens, "completion_tokens": 1, "total_tokens": tokens + 1}
    )


def test_one_to_many_and_outcomes_from_one_scoring(rows, tmp_path):
    calls = tmp_path / "calls"

    def factory():
        def run(frame):
            with open(calls, "a") as log:
                log.write("".join(f"{t}\n" for t in frame["text"]))
            return many(frame)

        return run

    numbered = rows.withColumn("ingest_seq", F.col("id") + 100)
    outcomes = S.model_outcomes(numbered, factory, ["text"], ITEM, many=True)
    called = calls.read_text()
    # Colliding names are overwritten by the item; failed and empty rows give no rows.
    items = S.outcome_items(outcomes, ITEM.names).drop("ingest_seq")
    assert sorted(tuple(r) for r in items.collect()) == [
        (1, "a", 0, None),
        (1, "b", 1, None),
        (1, "c", 2, None),
        (4, "x", 0, None),
        (4, "y", 1, None),
    ]
    table = {r["id"]: r for r in S.outcome_table(outcomes).collect()}
    assert {k: r["status"] for k, r in table.items()} == {
        1: "success",
        2: "failure",
        3: "success",
        4: "success",
    }
    assert table[2]["total_tokens"] is None and table[1]["total_tokens"] == 4
    usage = S.outcome_usage(outcomes).agg(F.count("usage"), F.sum("usage.total_tokens")).first()
    assert tuple(usage) == (3, 8)
    # The written outcomes answer all three results: the scorer was called once per row.
    assert calls.read_text() == called and len(called.splitlines()) >= 4
    written = max(glob.glob(f"{shared_dir(rows.sparkSession)}/outcomes-*"), key=os.path.getmtime)
    assert rows.sparkSession.read.parquet(written).columns == ["ingest_seq", "outcome"]


def scorer_for(labels, scores, seen=None):
    def factory():
        def run(frame):
            if (frame["text"] == "boom!").any():
                raise TimeoutError("504")
            if seen is not None:
                with open(seen, "a") as log:
                    for _, row in frame.iterrows():
                        log.write(f"{row['text']}|{list(row['labels'])}|{row['template']}\n")
            n = len(frame)
            return pd.DataFrame({"labels": [labels] * n, "scores": [scores] * n})

        return run

    return factory


def test_scorer_gets_cut_text_and_never_blank_text(spark, tmp_path):
    seen = tmp_path / "seen"
    df = spark.createDataFrame([(0, "hello world"), (1, " "), (2, None), (3, "boom!")], "n int, text string")
    df = df.withColumn("ingest_seq", F.col("n").cast("long")).coalesce(1)
    params = LabelParams(labels=("politics", "economy"), max_chars=5)
    out = Z.score_labels_with(df, params, scorer_for(["politics", "economy"], [0.91, 0.12], seen))
    got = {r["n"]: r for r in out.collect()}
    assert got[0]["zeroshot_top_label"] == "politics" and got[0]["zeroshot_labels"] == ["politics", "economy"]
    assert got[0]["text"] == "hello world"
    for blank in (1, 2):
        assert got[blank]["zeroshot_top_label"] == "" and got[blank]["zeroshot_top_score"] is None
        assert got[blank]["zeroshot_labels"] == [] and got[blank]["zeroshot_error"] == ""
    assert got[3]["zeroshot_top_label"] == "unknown" and got[3]["zeroshot_scores"] == []
    assert got[3]["zeroshot_error"] == "TimeoutError: 504"
    assert set(seen.read_text().splitlines()) == {
        "hello|['politics', 'economy']|This text is about {}"
    }


def test_overrides_map_back_to_labels(spark, tmp_path):
    seen = tmp_path / "seen"
    params = LabelParams(
        labels=("maternal health", "economy"),
        hypotheses={"maternal health": "about pregnancy and childbirth"},
    )
    df = spark.createDataFrame([(0, "hello")], "ingest_seq long, text string")
    factory = scorer_for(
        ["about pregnancy and childbirth", "This text is about economy"], [0.81, 0.22], seen
    )
    row = Z.score_labels_with(df, params, factory).first()
    assert row["zeroshot_labels"] == ["maternal health", "economy"]
    assert "|{}\n" in seen.read_text()


def test_hypotheses():
    assert Z.hypothesis_texts(["a", "b"], "is {}", {"a": " x ", "b": " "}) == {"a": "x", "b": "is b"}
    with pytest.raises(ValueError, match="not candidates"):
        Z.hypothesis_texts(["a"], "is {}", {"z": "x"})
    with pytest.raises(ValueError, match="share the text"):
        Z.hypothesis_texts(["a", "b"], "is {}", {"a": "is b"})
    with pytest.raises(ValueError, match="empty"):
        Z.hypothesis_texts([" "], "{}")


def scored(spark, *rows):
    schema = (
        "zeroshot_labels array<string>, zeroshot_scores array<double>, "
        "zeroshot_top_label string, zeroshot_error string"
    )
    return spark.createDataFrame(list(rows), schema)


def test_threshold_and_top_n(spark):
    df = scored(spark, (["politics", "economy", "technology"], [0.91, 0.62, 0.58], "politics", ""))
    labels = ["technology", "economy", "politics"]
    assert Z.add_passing_labels(df, labels, 0.6).first()[-1] == ["economy", "politics"]
    assert Z.add_selected_labels(df, labels, 0.99, 2).first()[-1] == ["politics", "economy"]
    assert Z.add_selected_labels(df, labels, 0.6).first()[-1] == ["economy", "politics"]
    assert Z.add_selected_labels(df, labels).first()[-1] == ["politics"]
    with pytest.raises(ValueError):
        Z.add_selected_labels(df, labels, None, 0)
    failed = scored(spark, ([], [], "unknown", " HTTP 504 "))
    assert Z.add_selected_labels(failed, labels, 0.1).first()[-1] == []


def counts(df, **params):
    row = Z.label_distribution(df, LabelParams(**params)).first()
    return (
        list(row["label_counts"]),
        row["stories_without_prediction"],
        row["stories_classification_failed"],
    )


def test_label_counts_in_three_modes(spark):
    top = scored(
        spark,
        (["a"], [1.0], "a", ""),
        (["b"], [1.0], "b", None),
        ([], [], "", ""),
        (["a"], [1.0], " a ", ""),
    )
    assert counts(top, labels=("a", "b", "c")) == ([2, 1, 0], 1, 0)
    ab = ["a", "b"]
    threshold = scored(
        spark, (ab, [0.9, 0.2], "a", ""), (ab, [0.1, 0.8], "b", ""), (ab, [0.2, 0.3], "a", "")
    )
    assert counts(threshold, labels=("a", "b"), score_threshold=0.5) == ([1, 1], 1, 0)
    top_n = scored(
        spark,
        (["a", "b", "c"], [0.9, 0.2, 0.1], "a", ""),
        (["b", "a", "c"], [0.8, 0.7, 0.1], "b", ""),
        (["c", "d", "e"], [0.7, 0.6, 0.5], "c", ""),
    )
    assert counts(top_n, labels=("a", "b"), score_threshold=0.95, top_n=2) == ([2, 2], 1, 0)
    assert counts(top_n, labels=("a", "b"), top_n=1) == ([1, 1], 1, 0)
    errors = scored(spark, (["a"], [1.0], "a", ""), ([], [], "unknown", "504"), (["b"], [1.0], "b", ""))
    assert counts(errors, labels=("a", "b")) == ([1, 1], 0, 1)
    assert counts(errors.limit(0), labels=("a", "b")) == ([0, 0], 0, 0)


def test_failures_tags_and_export(spark):
    df = spark.createDataFrame(
        [
            ("s1", "Hello", "SECRET", ["a", "b"], [0.9, 0.4], "a", "Something broke"),
            ("s2", "World", "SECRET", ["a", "b"], [0.9, 0.4], "a", " "),
            ("s3", None, "SECRET", [], [], "unknown", None),
        ],
        "id string, title string, text string, zeroshot_labels array<string>, "
        "zeroshot_scores array<double>, zeroshot_top_label string, zeroshot_error string",
    )
    assert [tuple(r) for r in Z.failure_details(df).collect()] == [("s1", "Hello", "Something broke")]
    picked = Z.add_selected_labels(df, ["b", "a"], 0.3)
    maps = [r[0] for r in picked.select(Z.tag_scores(picked, "threshold_ge")).collect()]
    assert maps == [{}, {"a": 0.9, "b": 0.4}, {}]
    assert [r[0] for r in picked.select(Z.tag_scores(picked, "top_label")).collect()] == [{}, {"a": 0.9}, {}]
    assert [r[0] for r in picked.select(Z.tags_for_prompt(picked)).collect()] == [None, "b; a", None]
    exported = Z.label_export(picked)
    assert exported.columns == [
        "story_id",
        "title",
        "zeroshot_labels_json",
        "zeroshot_scores_json",
        "zeroshot_top_label",
        "zeroshot_error",
        "zeroshot_labels_selected_json",
    ]


def test_column_scorer(spark):
    df = spark.createDataFrame([(0, "tax tax budget"), (1, "rain"), (2, " ")], "n int, text string")
    params = LabelParams(labels=("the tax", "rain and snow"), hypotheses={"the tax": "budget"})
    got = {r["n"]: r for r in Z.score_labels(df, params).collect()}
    assert got[0]["zeroshot_labels"] == ["the tax", "rain and snow"]
    assert got[0]["zeroshot_scores"] == [0.5, 0.0]
    assert got[1]["zeroshot_top_label"] == "rain and snow"
    assert (got[2]["zeroshot_top_label"], got[2]["zeroshot_top_score"]) == ("", None)
    single = {r["n"]: r for r in Z.score_labels(df, LabelParams(("tax", "rain"), multi_label=False)).collect()}
    assert single[0]["zeroshot_scores"] == [0.75, 0.25]
    with pytest.raises(ValueError, match="text"):
        Z.score_labels(df.drop("text"), params)


def test_decode(spark):
    df = spark.createDataFrame([('["a","b"]',), ("oops",), (None,), ('{"a": 1}',)], "j string")
    assert [r[0] for r in df.select(Z.decode_labels(F.col("j"))).collect()] == [["a", "b"], [], [], []]


@pytest.mark.parametrize(
    "make",
    [
        lambda: LabelParams(labels=(" ", "")),
        lambda: LabelParams(hypothesis_template="no place"),
        lambda: LabelParams(score_threshold=1.2),
        lambda: LabelParams(top_n=0),
        lambda: AboutnessParams(target=" "),
        lambda: AboutnessParams(target="x", kind="planet"),
        lambda: AboutnessParams(target="x", threshold=-0.1),
        lambda: ArticleQuery(dedup_strategy="url"),
        lambda: ArticleQuery(max_articles=-1),
    ],
)
def test_bad_parameters(make):
    with pytest.raises(ValueError):
        make()


def test_parameters_are_cleaned():
    params = LabelParams(labels=(" a ", "", "b"), hypotheses={"a": " ", " b": "x ", "c": None})
    assert params.labels == ("a", "b") and params.hypotheses == {"b": "x"}
    assert params.selection_mode == "top_label"
    assert LabelParams(score_threshold=0.5).selection_mode == "threshold_ge"
    assert LabelParams(score_threshold=0.5, top_n=1).selection_mode == "top_n"


def test_label_words_anywhere_in_a_long_text_count(spark):
    text = "word " * 3000 + "politics politics"
    df = spark.createDataFrame([(0, text)], "ingest_seq long, text string")
    assert Z.score_labels(df, LabelParams(labels=("politics",))).first()["zeroshot_top_score"] == 0.4
    cut = LabelParams(labels=("politics",), max_chars=2000)
    assert Z.score_labels(df, cut).first()["zeroshot_top_score"] == 0.0


def test_scores_of_labels_with_white_space(spark):
    row = (0, ["politics\t", "economy"], [0.7, 0.2], ["politics"], "")
    kinds = "ingest_seq long, zeroshot_labels array<string>, zeroshot_scores array<double>, "
    kinds += "zeroshot_labels_selected array<string>, zeroshot_error string"
    df = spark.createDataFrame([row], kinds)
    assert df.select(Z.tag_scores(df, "top_n").alias("s")).first()["s"] == {"politics": 0.7}


def test_failures_are_whole_unless_a_length_is_given(spark):
    df = spark.createDataFrame([("1", "t" * 900, "e" * 3000)], "id string, title string, zeroshot_error string")
    whole, cut = Z.failure_details(df).first(), Z.failure_details(df, max_title=5, max_error=7).first()
    assert (len(whole["title"]), len(whole["error"])) == (900, 3000)
    assert (len(cut["title"]), len(cut["error"])) == (5, 7)
