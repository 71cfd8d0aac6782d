import hashlib
import re
import unicodedata
from random import Random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog.base import sentences_cte
from storylake.functions import text as X
from storylake.functions.prompts import build_prompt

CASES = [
    "Story  A ",
    " Hello World\x85",
    "a\x1cb\x1fc",
    "",
    "   ",
    None,
    "Éléphant ÎLE straße",
    "Query with émojis 🎉 and symbols!",
    "This is a very long query string",
    "averyveryverylongword-and-more",
    "under_score  and--hyphens-",
    "ﬁne Ǆungla Œuvre naïve",
]


def values(spark, make, cases=CASES):
    df = spark.createDataFrame(list(enumerate(cases)), "n int, s string")
    return [row[0] for row in df.orderBy("n").select(make(F.col("s"))).collect()]


def python_normalize(value):
    return " ".join(value.split()).lower() if isinstance(value, str) else ""


def python_slug(value, limit=16):
    slug = unicodedata.normalize("NFKD", (value or "").lower())
    slug = "".join(c for c in slug if not unicodedata.combining(c))
    slug = re.sub(r"[^a-z0-9-]", "", re.sub(r"[\s_]+", "-", slug))
    slug = re.sub(r"-+", "-", slug).strip("-")
    if len(slug) > limit:
        cut = slug[:limit]
        slug = cut[: cut.rfind("-")] if cut.rfind("-") > limit * 0.5 else cut
    return slug.rstrip("-")


def test_normalize_text_equals_python(spark):
    assert values(spark, X.normalize_text) == [python_normalize(c) for c in CASES]


def test_hash_text(spark):
    expected = []
    for case in CASES:
        normal = python_normalize(case)
        expected.append(hashlib.md5(normal.encode()).hexdigest() if normal else "")
    assert values(spark, X.hash_text) == expected


def test_url_slug(spark):
    assert values(spark, X.url_slug) == [python_slug(c) for c in CASES]
    assert values(spark, X.url_slug, ["Hello World!", "Query with émojis"]) == [
        "hello-world",
        "query-with-emojis"[:10],
    ]


@pytest.mark.parametrize(
    ("text", "limit", "expected"),
    [("abcdef", 3, "abc"), ("ab", 10, "ab"), ("x", None, "x"), ("abc", 0, "abc"), (None, 2, "")],
)
def test_truncate(spark, text, limit, expected):
    assert values(spark, lambda c: X.truncate(c, limit), [text]) == [expected]


def test_sentences(spark):
    cases = [
        " First one.  Second?\nThird! Tail ",
        "No end",
        "3.5 percent... more. ",
        "   ",
        "",
        None,
        "A. B.",
    ]
    assert values(spark, X.sentences, cases) == [
        ["First one.", "Second?", "Third!", "Tail"],
        ["No end"],
        ["3.5 percent...", "more."],
        [],
        [],
        None,
        ["A.", "B."],
    ]


SENTENCE_ENDS = {
    "Dr. Smith met Mr. Lee in the U.S. on Monday.": 1,
    "He left the U.S. The talks went on.": 2,
    "J. R. R. Tolkien wrote. J. Smith read.": 2,
    "Plan B. The rest failed.": 2,
    "Acme Corp. said so, etc. It grew.": 2,
    "She came at 9 p.m. on Friday. Mme. Roux spoke!": 2,
    "So did Prof. Dr. Ing. Weber? Yes.": 2,
    "今天下雨。明天晴天！": 2,
    "他说：「好。」我走了？": 2,
    "यह पहला है। यह दूसरा है।": 2,
    "Mr.": 1,
    "。": 1,
    "A.  B. C.D. e.g. x. Y": 4,
    "Summit. Dr.\tWho": 2,
}


def test_sentence_ends(spark):
    found = values(spark, X.sentences, list(SENTENCE_ENDS))
    assert [len(parts) for parts in found] == list(SENTENCE_ENDS.values())
    assert found[0] == [next(iter(SENTENCE_ENDS))]
    assert found[7:9] == [["今天下雨。", "明天晴天！"], ["他说：「好。」", "我走了？"]]


def test_sentence_ends_equal_sql(spark):
    pieces = ["Dr.", "J.", "U.S.", "The", "the", "Lee", "etc.", "a", "I", "。", "!", "e.g.", "」"]
    pieces += ["B", "St.", "M.K.", "In."]
    random = Random(5)
    cases = list(SENTENCE_ENDS) + [
        "".join(random.choice(pieces) + random.choice(["", " ", " ", " \n"]) for _ in range(12))
        for _ in range(600)
    ]
    sql = (
        f"WITH articles AS (SELECT * FROM cases), {sentences_cte()} "
        "SELECT id, list(sentence_text ORDER BY sentence_id) FROM sentences GROUP BY 1 ORDER BY 1"
    )
    with duckdb.connect() as connection:
        cases_table = pa.table({"id": range(len(cases)), "text": cases})
        connection.register("cases", cases_table)
        expected = [row[1] for row in connection.execute(sql).fetchall()]
    assert values(spark, X.sentences, cases) == expected


def test_another_table_of_abbreviations(spark):
    ends = X.sentence_end_pattern({}, {"xx": ["abt"]})
    found = values(spark, lambda c: X.sentences(c, ends), ["Dr. Lee. abt. five"])
    assert found == [["Dr.", "Lee.", "abt. five"]]


def test_tokens_and_counts(spark):
    assert values(spark, X.tokens, ["Don't stop—É 3x!"]) == [["don", "t", "stop", "é", "3x"]]
    assert values(spark, X.token_count, ["Don't stop—É 3x!"]) == [5]


def test_stopwords_follow_the_language(spark):
    df = spark.createDataFrame(
        [("the", "en"), ("the", "fr"), ("die", "de"), ("the", None)], "t string, l string"
    )
    got = [r[0] for r in df.select(X.is_stopword(F.col("t"), F.col("l"))).collect()]
    assert got == [True, False, True, False]


def test_prompt_fields_are_inserted_once(spark):
    prompt = build_prompt('{"a": {title}} {text}{text}', title=F.lit("{text}"), text=F.lit("T"))
    assert spark.range(1).select(prompt).first()[0] == '{"a": {text}} TT'
    missing = build_prompt("[{title}]", title=F.lit(None))
    assert spark.range(1).select(missing).first()[0] == "[]"
