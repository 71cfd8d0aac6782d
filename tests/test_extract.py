import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from storylake.constants import STOPWORDS
from storylake.operators import keyword_batches as batches
from storylake.operators import keywords as K
from storylake.operators.entities import extract_entities
from storylake.operators.images import (
    distinct_urls,
    extract_top_images,
    join_top_images,
    urls_by_domain,
)
from storylake.operators.quotes import quote_table
from storylake.operators.sentences import (
    matching_sentences,
    sentence_table,
    targeted_sentiment,
)
from storylake.operators.summaries import summarize_articles


def test_sentences_keep_their_unfiltered_number(stories):
    df = stories(
        {"text": "The premiere was late. Nobody came. A PREMIERE again!"}, {"text": ""}, {"text": None}
    )
    assert sentence_table(df).count() == 3
    found = matching_sentences(df, ["premiere"])
    assert found.columns == [
        "id",
        "media_name",
        "title",
        "publish_date",
        "url",
        "language",
        "sentence_id",
        "sentence_text",
    ]
    assert [(r["sentence_id"], r["sentence_text"]) for r in found.orderBy("sentence_id").collect()] == [
        (0, "The premiere was late."),
        (2, "A PREMIERE again!"),
    ]
    none = matching_sentences(df, ["moon*land"])
    assert none.count() == 0 and none.columns == found.columns


def test_targeted_sentiment(spark):
    texts = [
        "Mamdani was blamed for the crisis.",
        "A great success for Mamdani.",
        "A good day for others.",
        "Mamdani spoke.",
        "good Mamdani bad",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, sentence_text string")
    got = {
        r["n"]: (r["target_sentiment"], r["target_sentiment_score"])
        for r in targeted_sentiment(df, "mamdani").collect()
    }
    negative = 1 / (1 + 2) + 1 / (1 + 5)
    positive = 1 / (1 + 3) + 1 / (1 + 2)
    assert got == {
        0: ("Negative", round(negative / (negative + 1), 4)),
        1: ("Positive", round(positive / (positive + 1), 4)),
        2: (None, None),
        3: ("Neutral", 0.0),
        4: ("Neutral", 0.0),
        5: (None, None),
    }


def test_entities_inline_and_joined_agree(spark, stories):
    df = stories(
        {"text": "Ada Lovelace met Paris and Rome in Paris. iPhone Maker"},
        {"text": "nothing here"},
        {"text": None},
    )
    names = {"Paris": "GPE", "Ada Lovelace": "PERSON"}
    table = spark.createDataFrame(list(names.items()), "text string, type string")
    expected = {
        0: [("Ada Lovelace", "PERSON"), ("Paris", "GPE"), ("Paris", "GPE")],
        1: [],
        2: [],
    }
    for gazetteer in (names, table):
        got = extract_entities(df, gazetteer)
        assert got.columns == [*df.columns, "entities"]
        assert {r["ingest_seq"]: [tuple(e) for e in r["entities"]] for r in got.collect()} == expected
    other = extract_entities(df, {}).first()["entities"]
    assert [tuple(e) for e in other] == [("Ada Lovelace", "MISC")]


def test_quotes(stories):
    df = stories(
        {"text": 'Then: "We must act," said Ann Lee. “Never”, he said. "Loose" words.'},
        {"text": "no quotes"},
        {"text": '"Fine," Bob Stone added. "Odd," She said.'},
    )
    got = quote_table(df)
    assert "text" not in got.columns and "title" in got.columns
    rows = got.orderBy("ingest_seq", "quote_id").collect()
    assert [(r["quote"], r["speaker"], r["pronoun"]) for r in rows] == [
        ("We must act,", "Ann Lee", "unspecified"),
        ("Never", "unspecified", "he"),
        ("Loose", "unspecified", "unspecified"),
        ("Fine,", "Bob Stone", "unspecified"),
        ("Odd,", "unspecified", "she"),
    ]


PAGES = [
    ("u0", '<meta content="a.jpg" property="og:image"><img src="z.png">', "a.jpg"),
    ("u1", "<meta name='twitter:image' content='t.jpg'>", "t.jpg"),
    ("u2", '<link rel="image_src" href="l.jpg"><img src="z.png">', "l.jpg"),
    ("u3", '<div class="big ad"><img src="ad.png"></div><IMG alt="" SRC="i.png">', "i.png"),
    ("u4", '<div class="ad"><img src="ad.png"></div>', None),
    ("u5", "not html", None),
    ("u6", None, None),
    ("u7", '<meta property="og:image" content=""><img src="ok.png">', "ok.png"),
]


def test_top_image_order(spark):
    pages = spark.createDataFrame([p[:2] for p in PAGES], "url string, html string")
    got = {r["url"]: r["top_image_url"] for r in extract_top_images(pages).collect()}
    assert got == {p[0]: p[2] for p in PAGES}


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_image_join(spark, stories, hot_rows):
    df = stories({"url": "u0"}, {"url": "u0"}, {"url": "u4"}, {"url": "gone"}, {"url": None})
    pages = spark.createDataFrame([p[:2] for p in PAGES], "url string, html string")
    got = join_top_images(df, extract_top_images(pages), hot_rows)
    assert {r["ingest_seq"]: (r["top_image_url"], r["resolved_url"]) for r in got.collect()} == {
        0: ("a.jpg", "u0"),
        1: ("a.jpg", "u0"),
        2: (None, "u4"),
        3: ("", ""),
        4: ("", ""),
    }


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_domains_are_dealt_evenly(spark, hot_rows):
    urls = [f"https://site{i % 7}.org/{i}" for i in range(40)] + ["/relative", "https://site0.org/0"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = urls_by_domain(df, 3, hot_rows).collect()
    assert sorted(r["url"] for r in rows) == sorted(set(urls) - {"/relative"})
    batch_of = {}
    for row in rows:
        assert row["url"].split("/")[2] == row["domain"]
        assert batch_of.setdefault(row["domain"], row["batch"]) == row["batch"]
    assert sorted(Counter(batch_of.values()).values()) == [2, 2, 3]
    assert distinct_urls(df).filter("url = 'https://site0.org/0'").first()["article_count"] == 2


# A plain-Python statement of the keyword formulas, used as brute force.
WORD = re.compile(r"[^\W_]+")


def python_sentences(text):
    return [s for s in re.sub(r"([.!?])\s+", "\\1\x01", text.strip()).split("\x01") if s]


def python_keywords(text, language="en", ngram_max=3):
    sentences = [WORD.findall(s) for s in python_sentences(text)]
    stop = set(STOPWORDS[language])
    seen = {}
    for sid, words in enumerate(sentences):
        for at, word in enumerate(words):
            facts = seen.setdefault(word.lower(), {"sid": [], "upper": 0, "cap": 0, "l": [], "r": []})
            facts["sid"].append(sid)
            facts["upper"] += len(word) > 1 and word.isupper()
            facts["cap"] += at > 0 and word[0].isupper()
            if at > 0:
                facts["l"].append(words[at - 1].lower())
            if at + 1 < len(words):
                facts["r"].append(words[at + 1].lower())
    tf = {term: len(facts["sid"]) for term, facts in seen.items()}
    content = [n for term, n in tf.items() if term not in stop]
    mean = sum(content) / len(content) if content else 0
    spread = math.sqrt(max(sum(n * n for n in content) / len(content) - mean**2, 0)) if content else 0
    scores = {}
    for term, facts in seen.items():
        n = tf[term]
        variety = sum(len(set(side)) / len(side) for side in (facts["l"], facts["r"]) if side)
        rel = 1 + variety * n / max(tf.values())
        sids = sorted(facts["sid"])
        median = (sids[(n - 1) // 2] + sids[n // 2]) / 2
        case = max(facts["upper"], facts["cap"]) / (1 + math.log(n))
        norm = n / (mean + spread) if content else 0
        different = len(set(sids)) / len(sentences)
        scores[term] = rel * math.log(math.log(3 + median)) / (case + norm / rel + different / rel)
    grams = Counter()
    for words in sentences:
        lower = [w.lower() for w in words]
        for n in range(1, ngram_max + 1):
            for at in range(len(lower) - n + 1):
                gram = lower[at : at + n]
                ends = gram[0] not in stop and gram[-1] not in stop
                if ends and all(any(c.isalpha() for c in w) for w in gram):
                    grams[" ".join(gram)] += 1
    ranked = []
    for gram, kf in grams.items():
        parts = [scores[w] for w in gram.split()]
        ranked.append((round(math.prod(parts) / (kf * (1 + sum(parts))), 12), gram))
    return sorted(ranked)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def python_walk(ranked, top_n, limit):
    kept = []
    for _, gram in ranked:
        close = any(1 - edit_distance(gram, k) / max(len(gram), len(k)) >= limit for k in kept)
        if len(kept) < top_n and not close:
            kept.append(gram)
    return kept


ARTICLES = [
    "NASA launched a new rocket. The rocket carried NASA probes, and the probes left Earth! "
    "Rockets like this rocket cost 40 million. Engineers at NASA watched the launch. "
    "The launches were watched by engineers of the Space Agency.",
    "Budget talks failed. Budget talk in Berlin failed again. Talks on the budget go on.",
    "the of and",
    "12 34. 56",
    "",
]


def test_keywords_equal_brute_force(stories):
    df = stories(*[{"text": t} for t in ARTICLES])
    got = {}
    for row in K.keyword_scores(df).collect():
        got.setdefault(row["ingest_seq"], {})[row["keyword"]] = row["score"]
    for i, text in enumerate(ARTICLES):
        expected = {gram: score for score, gram in python_keywords(text)}
        assert got.get(i, {}) == pytest.approx(expected, abs=1e-11)


@pytest.mark.parametrize(("top_n", "limit"), [(5, 0.6), (20, 0.8), (50, 0.9), (7, 1.0)])
def test_near_duplicates_equal_brute_force(stories, top_n, limit):
    df = stories(*[{"text": t} for t in ARTICLES])
    got = {r["ingest_seq"]: r["keywords"] for r in K.extract_keywords(df, top_n, dedup_limit=limit).collect()}
    assert got == {
        i: python_walk(python_keywords(text), top_n, limit) for i, text in enumerate(ARTICLES)
    }


def test_keywords_do_not_depend_on_partitions(stories):
    df = stories(*[{"text": t} for t in ARTICLES])
    one = {tuple(r) for r in K.top_keywords(df.repartition(1), 5).collect()}
    assert one == {tuple(r) for r in K.top_keywords(df.repartition(7), 5).collect()}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"[\s+:-]Exchange ", line)]


def test_keywords_shuffle_the_text_once_and_summaries_only_by_article(spark, stories, tmp_path):
    path = str(tmp_path / "articles")
    stories(*[{"text": t} for t in ARTICLES]).write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for result in (K.top_keywords(df, 5), K.article_keywords(df, 5), K.keyword_scores(df)):
            (only,) = exchanges(result)
            assert "REPARTITION_BY_COL" in only
        found = exchanges(summarize_articles(df, focus="coast"))
        assert found and all("hashpartitioning(ingest_seq" in line for line in found), found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keywords_hold_one_article_at_a_time(spark, stories, tmp_path):
    """No operator that gathers rows; a filter on what is found does not compute it again."""
    path = str(tmp_path / "articles")
    stories(*[{"text": t} for t in ARTICLES]).write.parquet(path)
    df = spark.read.parquet(path)
    found = K.extract_keywords(df, 5).filter("size(keywords) > 2")
    for result in (K.term_scores(df), K.keyword_scores(df), K.top_keywords(df, 5), found):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Aggregate|Sort\b|Window|Join", plan)
        assert plan.count("regexp_extract_all") == 1
    assert {r["ingest_seq"] for r in found.collect()} == {0, 1}


def test_keywords_need_no_expression_per_word(spark, stories, tmp_path):
    """Words are counted in arrays of many articles; Spark evaluates nothing for each of them."""
    path = str(tmp_path / "articles")
    stories(*[{"text": t} for t in ARTICLES]).write.parquet(path)
    df = spark.read.parquet(path)
    whole = K.article_keywords(df, 5, dedup_limit=1.0)
    for result in (K.term_scores(df), K.keyword_scores(df), K.top_keywords(df, 5), whole):
        assert "lambda" not in result._jdf.queryExecution().executedPlan().toString()


def test_near_duplicates_are_looked_for_behind_the_first_stretch(stories, monkeypatch):
    df = stories(*[{"text": t} for t in ARTICLES])
    monkeypatch.setattr(K, "_HEAD", 1)
    got = {r["ingest_seq"]: r["keywords"] for r in K.extract_keywords(df, 12, dedup_limit=0.5).collect()}
    assert got == {i: python_walk(python_keywords(text), 12, 0.5) for i, text in enumerate(ARTICLES)}
    plan = K.extract_keywords(df, 12)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(slice(") == 2


def words_of(text):
    return [each for part in python_sentences(text) for each in ["\x01", *WORD.findall(part)]]


@pytest.mark.parametrize("most", [1, 20, 10_000])
def test_batches_of_articles_score_as_each_alone(monkeypatch, most):
    monkeypatch.setattr(batches, "CHUNK_WORDS", most)
    texts = [*ARTICLES, "Étude à Œuvre. ÉTÉ été. Der Rat der Stadt.", *ARTICLES]
    words = pa.array([words_of(text) for text in texts], pa.list_(pa.string()))
    languages = pa.array(["en"] * 5 + ["de"] + ["en"] * 4 + [None])
    run = batches.over_batches(lambda terms: batches.candidate_lists(terms, 3), STOPWORDS)
    # The first and last article are in the memory of the batches, but not in them.
    first, second = run(iter([(words[1:4], languages[1:4]), (words[4:-1], languages[4:-1])]))
    for text, language, found in zip(texts[1:-1], languages[1:-1].to_pylist(), [*first, *second], strict=True):
        got = [(row["keyword"], row["score"]) for row in found.as_py()]
        expected = python_keywords(text, language)
        assert [keyword for keyword, _ in got] == [keyword for _, keyword in expected]
        assert [score for _, score in got] == pytest.approx([score for score, _ in expected], abs=1e-11)


@pytest.mark.parametrize("room", [1, 1 << 20, 1 << 62])
def test_candidates_are_ordered_by_article_score_and_keyword(monkeypatch, room):
    monkeypatch.setattr(batches, "_ROOM", room)
    some = np.random.default_rng(3)
    article, score, *names = (some.integers(0, 4, 300) for _ in range(5))
    names = [names[0], names[1] - 1, np.where(names[1] == 0, -1, names[2] - 1)]
    order = batches._best_first(article, score / 8, names, 4)
    rows = [*zip(article.tolist(), score.tolist(), *(name.tolist() for name in names), strict=True)]
    assert [rows[at] for at in order] == sorted(rows)


def test_terms_of_odd_words_and_texts(stories):
    df = stories(
        {"text": "The İstanbul ΟΔΟΣ NATO straße. ⅣA 42 ªb 東京 ok Ǆ \x01\x01 end.\x01"},
        {"text": None},
        {"text": " \n\u3000", "language": None},
        {"text": "the The THE", "language": None},
    )
    rows = K.term_scores(df).collect()
    assert {r["term"] for r in rows if r["ingest_seq"] == 0} == {
        "the", "i̇stanbul", "οδος", "nato", "straße", "ⅳa", "42", "ªb", "東京", "ok", "ǆ", "end"
    }
    assert {r["ingest_seq"] for r in rows} == {0, 3}
    (the,) = [r for r in rows if r["ingest_seq"] == 3]
    assert (the["term"], the["tf"], the["is_stop"]) == ("the", 3, False)
    assert [r["is_stop"] for r in rows if r["ingest_seq"] == 0 and r["term"] == "the"] == [True]
    # Text with three sentences; what has no capital counts as written in capitals if it is long.
    score = {r["term"]: r["term_score"] for r in rows if r["ingest_seq"] == 0}
    one = math.log(math.log(4))
    assert score["東京"] == pytest.approx(one * 3 / (1 + 1 / 3 + 1 / 9), abs=1e-12)
    assert score["ok"] == pytest.approx(one * 3 / (1 / 3 + 1 / 9), abs=1e-12)
    found = {r["ingest_seq"]: r["keywords"] for r in K.extract_keywords(df, 3).collect()}
    assert found[1] == found[2] == [] and found[3] == ["the the the", "the the", "the"]


def test_summaries(stories):
    long_text = " ".join(
        [f"Word{i} item{i} note{i} thing{i}." for i in range(12)]
        + ["Storm storm warnings rose.", "The storm hit the coast.", "Ships left before the storm came."]
    )
    df = stories({"title": "Storm", "text": long_text}, {"text": "Too short."}, {"text": None})
    rows = {r["ingest_seq"]: r for r in summarize_articles(df, focus="coast").collect()}
    assert rows[0]["llm_summary_is_confident"] and "The storm hit the coast." in rows[0]["llm_summary_text"]
    assert len(rows[0]["key_points"]) == 3
    for seq in (1, 2):
        assert rows[seq]["llm_summary_text"] is None
        assert rows[seq]["llm_summary_is_confident"] is False
        assert rows[seq]["usage"]["completion_tokens"] == 0
    usage = rows[0]["usage"]
    assert usage["total_tokens"] == usage["prompt_tokens"] + usage["completion_tokens"]


def test_summaries_hold_one_article_at_a_time(spark, stories, tmp_path):
    path = str(tmp_path / "articles")
    words = " ".join(f"Word{i} item{i} note{i} thing{i}." for i in range(12))
    # A focus word may come twice in a sentence, and a sentence may have no word.
    text = f"{words} Coast and coast ... Coast item1. !!! ??? Sea item1 item2."
    stories({"text": text}, {"text": "Too short."}, {"text": None}, {"text": ""}).write.parquet(path)
    found = summarize_articles(spark.read.parquet(path), focus="coast")
    plan = found.filter("llm_summary_is_confident")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Aggregate|Sort\b|Window|Join", plan)
    rows = {r["ingest_seq"]: r for r in found.collect()}
    assert [rows[i]["llm_summary_is_confident"] for i in range(4)] == [True, False, False, False]
    assert "Coast and coast ... Coast item1." in rows[0]["llm_summary_text"]
    assert rows[1]["key_points"] == rows[2]["key_points"] == rows[3]["key_points"] == []


def test_a_mapping_of_any_size_gives_the_same_entities(stories):
    df = stories({"text": "Ann Lee met Bob in Big Town. Zed came."}, {"text": None})
    small = {"Ann Lee": "PERSON", "Zed": "PERSON"}
    large = small | {f"Name{i}": "OTHER" for i in range(5000)}
    expected = {r["ingest_seq"]: r["entities"] for r in extract_entities(df, small).collect()}
    assert {r["ingest_seq"]: r["entities"] for r in extract_entities(df, large).collect()} == expected


@pytest.mark.parametrize("entries", [500, 501])
def test_entities_need_no_article_key(stories, entries):
    """Rows without a key, of equal texts too, have the same entities on both sides of any size."""
    df = stories({"text": "Ann Lee met Bob in Big Town. Zed came."}, {"text": None}, {"text": "Zed"}, {"text": "Zed"})
    names = {"Ann Lee": "PERSON", "Zed": "PERSON"} | {f"Name{i}": "OTHER" for i in range(entries - 2)}
    got = extract_entities(df.drop("ingest_seq"), names)
    assert got.columns == [c for c in df.columns if c != "ingest_seq"] + ["entities"]
    assert {r["id"]: [tuple(e) for e in r["entities"]] for r in got.collect()} == {
        "s0": [("Ann Lee", "PERSON"), ("Big Town", "MISC"), ("Zed", "PERSON")],
        "s1": [],
        "s2": [("Zed", "PERSON")],
        "s3": [("Zed", "PERSON")],
    }


def test_stopwords_of_any_language(stories):
    df = stories({"text": "Huset och havet. Huset och skogen.", "language": "sv"})
    plain = K.extract_keywords(df, 50).first()["keywords"]
    assert "och" in plain
    assert "och" not in K.extract_keywords(df, 50, stopwords={"sv": ["och"]}).first()["keywords"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('Ann Lee said, "We will go." He added: "No."', [("Ann Lee", "unspecified"), ("unspecified", "he")]),
        ('"No," said Ann Lee, "never." She left.', [("Ann Lee", "unspecified")] * 2),
        ('"No." Bob Ray said. "Yes."', [("Bob Ray", "unspecified"), ("unspecified", "unspecified")]),
        ('In Paris. J. Lee told: "A b."', [("J. Lee", "unspecified")]),
        ('They said "maybe" and left.', [("unspecified", "they")]),
        ('“Go!” asked she. Carl said “why”', [("unspecified", "she"), ("Carl", "unspecified")]),
        ('said Ann Lee: "x" says Bob.', [("Ann Lee", "unspecified")]),
        ('A lone " mark', []),
    ],
)
def test_speakers_on_both_sides(stories, text, expected):
    rows = quote_table(stories({"text": text})).orderBy("quote_id").collect()
    assert [(r["speaker"], r["pronoun"]) for r in rows] == expected
