import pytest
from pyspark.sql import functions as F

from storylake.operators import dedup as D
from storylake.operators.selection import first_by


def ids(df):
    return sorted(r[0] for r in df.select("ingest_seq").collect())


def test_title_copies_keep_the_earliest(stories):
    df = stories(
        {"title": "Story A", "day": 1}, {"title": "Story A ", "day": 2}, {"title": "Story B", "day": 1}
    )
    keys = D.article_keys(df)
    assert ids(D.keep_first(df, keys)) == [0, 2]
    assert ids(D.dropped_rows(df, keys)) == [1]


@pytest.fixture
def mixed(stories):
    return stories(
        {"title": "A", "text": "one", "day": 9, "media_name": "x"},
        {"title": " a ", "text": "two", "day": 3, "media_name": "x"},
        {"title": "A", "text": "ONE", "day": None, "media_name": "y"},
        {"title": None, "text": "", "day": 1, "media_name": None},
        {"title": None, "text": "  ", "day": 1, "media_name": None},
        {"title": "none", "text": "one ", "day": 1, "media_name": "x"},
        {"title": "A", "text": "x", "day": 3, "media_name": "x"},
    )


def test_every_key_choice(mixed):
    by = D.article_keys
    assert ids(D.keep_first(mixed, by(mixed))) == [1, 3, 5]
    assert ids(D.keep_first(mixed, by(mixed), earliest=False)) == [0, 3, 5]
    assert ids(D.keep_first(mixed, by(mixed, by_title=False, by_text=True))) == [1, 3, 5, 6]
    assert ids(D.keep_first(mixed, by(mixed, by_text=True))) == [0, 1, 3, 5, 6]
    # Raw titles and sources, null equal to null, first in input order.
    assert ids(D.deduplicate(mixed, "title_source")) == [0, 1, 2, 3, 5]
    assert ids(D.deduplicate(mixed, "none")) == [0, 1, 2, 3, 4, 5, 6]


def test_no_usable_key_keeps_every_row(mixed):
    narrow = mixed.drop("title", "text")
    assert D.article_keys(narrow, by_text=True) == {}
    assert D.keep_first(narrow, {}).count() == 7
    assert D.dropped_rows(narrow, {}).count() == 0


@pytest.mark.parametrize("hot_rows", [1, 2, 1_000_000])
def test_mapping_is_the_same_for_hot_groups(mixed, hot_rows):
    mapped = D.duplicate_mapping(mixed, D.article_keys(mixed), hot_rows=hot_rows)
    got = {(r["id"], r["kept_id"], r["dedup_norm_title"]) for r in mapped.collect()}
    assert got == {
        ("s0", "s1", "a"),
        ("s2", "s1", "a"),
        ("s6", "s1", "a"),
        ("s4", "s3", None),
    }


def test_hot_group_is_spread_over_tasks(spark):
    """One title holds most rows; no partition of the mapping may hold most of them."""
    rows = spark.range(20_000).select(
        F.col("id").alias("ingest_seq"),
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 10 < 9, "same").otherwise(F.col("id").cast("string")).alias("title"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mapped = D.duplicate_mapping(rows, D.article_keys(rows), hot_rows=1000)
        sizes = [r[0] for r in mapped.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 18_000 - 1
    assert max(sizes) < 0.4 * sum(sizes)


def test_groups_are_cut_before_the_shuffle(spark, mixed, tmp_path):
    path = str(tmp_path / "articles")
    mixed.write.parquet(path)
    df = spark.read.parquet(path)
    plan = D.deduplicate(df, "title")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    partial = next(i for i, line in enumerate(lines) if "row_number(), 1, Partial" in line)
    assert partial > shuffle and plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_invariants_and_partition_independence(mixed):
    keys = D.article_keys(mixed)
    expected = ids(D.keep_first(mixed, keys))
    for n in (1, 7):
        df = mixed.repartition(n)
        kept, dropped = ids(D.keep_first(df, keys)), ids(D.dropped_rows(df, keys))
        assert kept == expected
        assert sorted(kept + dropped) == list(range(7))


def test_summary(mixed, stories):
    got = D.dedup_summary(mixed, "title").first().asDict()
    assert got == {
        "input_story_count": 7,
        "deduplicated_story_count": 3,
        "duplicate_story_count": 4,
        "strategy": "title",
    }
    empty = D.dedup_summary(mixed.limit(0), "title").first()
    assert (empty[0], empty[1], empty[2]) == (0, 0, 0)
    assert D.dedup_summary(mixed, "none").first()["duplicate_story_count"] == 0


def test_missing_columns_are_an_error(mixed):
    with pytest.raises(ValueError, match="media_name"):
        D.deduplicate(mixed.drop("media_name"), "title_source")


def test_a_hot_group_with_a_long_key_is_spread(spark):
    title = "long " * 500
    rows = [(i, i, title if i % 10 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "ingest_seq long, id long, title string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mapped = D.duplicate_mapping(df, D.exact_keys("title"), hot_rows=100)
        assert mapped.count() == 2000 - 2
        assert {r["kept_id"] for r in mapped.select("kept_id").distinct().collect()} == {0, 1}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_limits_cut_inside_a_range(spark):
    rows = [(i, (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "ingest_seq long, k long")
    for n in (0, 1, 499, 999, 1000, 5000):
        got = sorted(r["k"] for r in first_by(df, [F.col("k"), F.col("ingest_seq")], n).collect())
        assert got == list(range(min(n, 1000)))
