import hashlib
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storylake.constants import TAGGED_SUMMARY_COLUMNS
from storylake.operators import selection
from storylake.params import AboutnessParams, ArticleQuery, LabelParams, SearchTerms
from storylake.plans import jobs as J
from storylake.schema import canonical_id
from storylake.session import shared_dir
from storylake.sources import exports as X
from storylake.sources.articles import batch_union, read_articles, scan_articles


def test_batches_are_renumbered(spark):
    a = spark.createDataFrame([(1, "a1"), (0, "a0")], "position long, id string")
    b = spark.createDataFrame([], "position long, id string, url string")
    c = spark.createDataFrame([(0, "c0", "u")], "position long, id string, url string")
    rows = batch_union([a, b, c]).orderBy("ingest_seq").collect()
    assert [tuple(r) for r in rows] == [(0, "a0", None), (1, "a1", None), (2, "c0", "u")]
    with pytest.raises(ValueError):
        batch_union([])


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_every_format_reads_back(spark, stories, tmp_path, fmt):
    df = stories({"title": 'A "quoted", title', "text": "line 1\nline 2"}, {"title": "b", "day": None})
    path = str(tmp_path / fmt)
    writer = df.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)
    back = read_articles(spark, path, fmt)
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        read_articles(spark, path, "xml")


def test_scan_order_of_steps(stories):
    df = stories(
        {"title": "A", "text": "tax", "day": 3},
        {"title": "a", "text": "tax", "day": 2},
        {"title": "b", "text": "rain", "day": 2},
        {"title": "c", "text": "tax", "day": 9},
        {"title": "d", "text": "tax", "day": 4},
    )
    query = ArticleQuery(
        terms=SearchTerms(all_of=("tax",)),
        start_date=date(2024, 1, 2),
        end_date=date(2024, 1, 8),
        dedup_strategy="title",
        max_articles=2,
    )
    rows, summary = scan_articles(df, query)
    # The cap comes before copies are removed: two articles matched, one is a copy.
    assert [r["ingest_seq"] for r in rows.collect()] == [1]
    assert summary.first()["duplicate_story_count"] == 1


def test_csv_round_trip_and_manifest(spark, tmp_path):
    data = [(1, 'say "hi", ok', "a\nb"), (2, "", " lead and trail "), (3, None, "é")]
    df = spark.createDataFrame(data, "id long, title string, text string")
    written = X.write_csv(df, "/out/DATE/x.csv", root=str(tmp_path))
    back = X.read_csv(spark, written.path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(data)
    row = written.manifest.first()
    assert (row["row_count"], row["columns_saved"]) == (3, ["id", "title", "text"])
    assert row["object_key"] == f"out/{date.today().isoformat()}/x.csv"
    with pytest.raises(Exception, match="(?i)exists"):
        X.write_csv(df, "/out/DATE/x.csv", root=str(tmp_path))


def test_csv_of_nested_values(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b"], {"k": 0.5})], "l array<string>, m map<string,double>")
    written = X.write_csv(df.coalesce(1), "nested", root=str(tmp_path))
    text = "".join(p.read_text() for p in tmp_path.glob("nested/part-*"))
    assert text == 'l,m\n"[""a"",""b""]","{""k"":0.5}"\n'
    assert written.manifest.first()["row_count"] == 1


def test_shapes(stories):
    df = stories({"title": "a"})
    assert "text" not in X.drop_text(X.drop_text(df)).columns
    shaped = X.contract_columns(df)
    assert shaped.columns == [name for name, _ in TAGGED_SUMMARY_COLUMNS]
    assert dict(shaped.dtypes)["about_score"] == "double"
    assert canonical_id(df.withColumnRenamed("id", "stories_id")).columns == df.columns
    with pytest.raises(ValueError):
        canonical_id(df.drop("id"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.fixture
def news(stories):
    long = " ".join(f"Sentence {i} about the storm and the coast." for i in range(12))
    return stories(
        {"title": "Storm hits", "text": long, "day": 2},
        {"title": "storm  hits", "text": long, "day": 1, "media_name": "n"},
        {"title": "Budget", "text": 'The budget failed. "No," said Ann Lee. Storm later.', "day": 3},
        {"title": "Empty", "text": None, "day": 4},
    )


def scans_of(df, path):
    """How often a plan reads the files of a folder."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    files = [leaf for leaf in leaves if leaf.getClass().getSimpleName() == "LogicalRelation"]
    return sum(leaf.relation().location().rootPaths().mkString(" ").endswith(path) for leaf in files)


def test_a_cap_reads_the_articles_twice_for_all_outputs(spark, stories, tmp_path, monkeypatch):
    words = ["the storm", "a storm", None, "The end"]
    df = stories(*[{"title": f"t{i % 9}", "text": words[i % 4], "day": i % 28 + 1} for i in range(60)])
    twice = df.union(df.filter("ingest_seq % 10 = 0")).union(df.filter("ingest_seq = 3").withColumn("id", F.lit(None)))
    twice.write.parquet(f"{tmp_path}/articles")
    articles, written = spark.read.parquet(f"{tmp_path}/articles"), {}

    def kept(df, name, write=selection.materialize):
        written.setdefault(name, []).append(scans_of(df, "/articles"))
        return write(df, name)

    monkeypatch.setattr(selection, "materialize", kept)
    query = ArticleQuery(
        terms=SearchTerms(all_of=("the",)), dedup_strategy="title_source", randomized=True, seed=5, max_articles=12
    )
    outputs = J.full_text(articles, query)
    # Input scans of what is written: only the keys come from the articles, and come once.
    assert written == {"sort-keys": [1], "ordered-keys": [0], "taken-keys": [0]}
    assert scans_of(outputs["stories"], "/articles") == 1
    assert "SortMergeJoin" not in outputs["stories"]._jdf.queryExecution().executedPlan().toString()

    rows = [r for r in twice.collect() if r["text"] in ("the storm", "The end")]
    order = sorted(
        (r["id"] is None, r["id"] and hashlib.md5(f"5:{r['id']}".encode()).hexdigest(), r["ingest_seq"]) for r in rows
    )
    taken = {seq for _, _, seq in order[:12]}
    groups = {}
    for r in rows:
        if r["ingest_seq"] in taken:
            groups.setdefault((r["title"], r["media_name"]), []).append(r["ingest_seq"])
    got = sorted(r["ingest_seq"] for r in outputs["stories"].collect())
    assert got == sorted(min(seqs) for seqs in groups.values())
    sizes = outputs["dedup_summary"].first()
    assert sizes["input_story_count"] == sum(map(len, groups.values()))
    dropped = sorted(r["ingest_seq"] for r in outputs["duplicates"].collect())
    assert dropped == sorted(s for seqs in groups.values() for s in seqs if s != min(seqs))


def test_every_job_runs(spark, news):
    query = ArticleQuery(dedup_strategy="title")
    about, labels = AboutnessParams("storm"), LabelParams(labels=("storm", "budget"), top_n=1)
    pages = spark.createDataFrame([("http://m.example.org/2", '<img src="x.png">')], "url string, html string")
    runs = {
        "keywords": J.keywords(news, query, top_n=5),
        "entities": J.entities(news, query, {"Ann Lee": "PERSON"}),
        "matching_sentences": J.matching_sentences(news, query, ["storm"]),
        "targeted_sentiment": J.targeted_sentiment(news, query, "storm", ["storm"]),
        "top_images": J.top_images(news, query, pages),
        "full_text": J.full_text(news, query),
        "summaries": J.summaries(news, query),
        "quotes": J.quotes(news, query),
        "tagged_summaries": J.tagged_summaries(news, query, about, labels),
        "aboutness_filter": J.aboutness_filter(news, query, about),
        "zero_shot": J.zero_shot(news, query, labels),
    }
    assert set(runs) == set(J.JOBS)
    for name, outputs in runs.items():
        for part, df in outputs.items():
            df.collect()
            assert df.columns, (name, part)
        if name != "full_text":
            assert outputs["query_summary"].first()["story_count"] == 3
    assert runs["full_text"]["stories"].count() == J.entities(news, query, {})["stories"].count()
    assert runs["top_images"]["stories"].filter("top_image_url = 'x.png'").count() == 1
    assert [r["speaker"] for r in runs["quotes"]["quotes"].collect()] == ["Ann Lee"]
    assert runs["quotes"]["cost"].first()["total_requests"] == 3
    tagged = {r["story_id"]: r for r in runs["tagged_summaries"]["stories"].collect()}
    assert tagged["s1"]["zero-shot-tags"] == '["storm"]'
    assert tagged["s1"]["zero-shot-tag-scores"].startswith('{"storm":')
    summary = runs["aboutness_filter"]["filter_summary"].first()
    assert summary["passed_count"] == runs["aboutness_filter"]["stories"].count()


def test_jobs_on_an_empty_table_keep_their_schema(news):
    query, none = ArticleQuery(), news.limit(0)
    about, labels = AboutnessParams("storm"), LabelParams(labels=("a", "b"))
    outputs = J.tagged_summaries(none, query, about, labels)
    assert outputs["stories"].columns == [name for name, _ in TAGGED_SUMMARY_COLUMNS]
    assert outputs["stories"].count() == 0
    assert list(outputs["label_summary"].first()["label_counts"]) == [0, 0]
    assert list(outputs["filter_summary"].first()["score_histogram_counts"]) == [0] * 10
    assert outputs["summary_cost"].first()["total_requests"] == 0


def test_model_runs_once_for_all_outputs_of_a_job(news, tmp_path):
    calls = tmp_path / "calls"

    def factory():
        def run(frame):
            with open(calls, "a") as log:
                log.write("x\n" * len(frame))
            return pd.DataFrame({"labels": [["b", "a"]] * len(frame), "scores": [[0.2, 0.7]] * len(frame)})

        return run

    outputs = J.zero_shot(news, ArticleQuery(), LabelParams(labels=("a", "b")), factory)
    called = calls.read_text()
    assert outputs["stories"].filter(F.col("zeroshot_top_label") == "a").count() == 3
    assert list(outputs["label_summary"].first()["label_counts"]) == [3, 0]
    assert outputs["failures"].count() == 0
    assert calls.read_text() == called


def test_focus():
    assert J.summary_focus(None, " x ") == "x"
    assert J.summary_focus(" ", "x") is None
    assert J.summary_focus("y", "x") == "y"
