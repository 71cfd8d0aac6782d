"""URL rules with aliases, and main text of pages."""

import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storylake.llm import html_template, url_filter

RULES = url_filter.parse_rules(
    allow=("com/", "www.example.com/en/"), block=("example.com/en/", "net/es/", "net/fr/")
)
PAGES = "page_id long, url string, html string"


def judged(spark, rows, html=""):
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], PAGES)
    out = url_filter.judge_urls(pages.withColumn("node", F.lit(1)), RULES, url_filter.page_links(pages))
    assert out.count() == len(rows)
    return {r["page_id"]: r for r in out.collect()}


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("https://A.Example.COM/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://a.net/fr/", "a.net", "/fr/", "net/fr/", "block"),
        ("http://a.net?x=/fr/", "a.net", "", None, "allow"),
        ("net://net/es/://x", "net", "/es/://x", "net/es/", "block"),
        ("//a.net/fr/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://É.net/fr/\n", "É.net", "/fr/\n", "net/fr/", "block"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    row = judged(spark, [(url, None)])[0]
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def link(target):
    return f'<html><link href="{target}" rel="canonical"><p>x</p>'


def test_blocks_reach_aliases_but_not_allowed_ones(spark):
    rows = [
        ("http://a.org/1", link("http://b.org/2")),
        ("http://b.org/2", "<meta http-equiv=refresh content=\"0; URL='http://c.net/fr/3'\">"),
        ("http://c.net/fr/3#top", ""),  # blocked by a rule
        ("http://d.org/4", link("http://b.org/2")),
        ("http://e.com/5", link("http://a.org/1")),  # explicitly allowed
        ("http://f.org/6", link("http://e.com/5")),
        ("http://g.org/7", link("http://h.org/8")),
        ("http://i.org/9", link("//z.net/es/gone")),  # the target is no page
        ("http://j.org/a/b", link("c")),
        ("http://j.org/a/c", link("/d")),
        ("http://j.org/d", link("http://y.net/fr/")),
        ("http://k.org/", "<!-- " + link("http://c.net/fr/3") + " -->"),
        ("http://k.org/2", "<script>'" + link("http://c.net/fr/3") + "'</script>"),
        ("http://l.org/", link("mailto:x@c.net")),
        ("http://c.net/fr/3", None),
        (None, link("http://c.net/fr/3")),
    ]
    got = judged(spark, rows)
    assert [got[i]["verdict"] for i in range(len(rows))] == [
        "block", "block", "block", "block", "allow", "block", "allow", "block",
        "block", "block", "block", "allow", "allow", "allow", "block", "allow",
    ]
    assert got[4]["via"] == "rule" and got[0]["via"] == "alias" and got[6]["via"] == "default"


def test_many_aliases_of_one_url(spark):
    rows = [(f"http://s{i}.org/", link("http://hub.net/fr/")) for i in range(400)]
    assert {r["verdict"] for r in judged(spark, rows).values()} == {"block"}


def test_no_pages(spark):
    pages = spark.createDataFrame([], PAGES)
    assert url_filter.judge_urls(pages, RULES, url_filter.page_links(pages)).count() == 0
    assert html_template.extract_text(pages).count() == 0


def text_of(spark, rows):
    pages = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("x")).withColumn("text", F.lit("y"))
    return [
        (r["page_id"], r["text"], r["n_chars"]) for r in html_template.extract_text(pages).collect()
    ]


def test_article_without_its_surroundings(spark):
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
    <header>site</header><nav><ul><li><a href=/>home</a></ul></nav><!-- <p>no</p> -->
    <div class="ad">buy</div><article><h1>Head &amp; line</h1><p>One <b>two
    &eacute;&#8212;</b>three<br>four<p>Five<script>var a="<p>x</p>";</script>
    <div class="comments"><p>reader</p></div><aside>side</aside><form>f</form>
    <ul><li>six<li>seven</ul></article><div id=cookie-notice>ok?</div><footer>&copy; us</footer>"""
    expected = "Head & line\n\nOne two é—three four\n\nFive\n\nsix\n\nseven"
    rows = [(i, "http://h.org/1", page) for i in range(5)] + [(9, "http://other.org/1", page)]
    assert sorted(text_of(spark, rows)) == sorted((i, expected, len(expected)) for i, _, _ in rows)


def test_template_without_article_elements(spark):
    rows = []
    for i in range(8):
        body = "".join(f"<div><p>Unique words number {i} {j} of this text here</p></div>" for j in range(3))
        rows.append(
            (i, f"http://h.org/{i}", f"<body><div class=top><a href=/>All our sections</a></div><div class=x><p>Always the same long line, repeated on each page of it</p>{body}</div><div class=low><p>Imprint</p></div>")
        )
    for i, text, _ in text_of(spark, rows):
        assert text == "\n\n".join(f"Unique words number {i} {j} of this text here" for j in range(3))


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "", ""), (None, "u", "plain text"), (4, "http://h", "<article>a < b &amp c"),
        (5, "http://h", "<p>cut <a href='x"), (5, "http://h", "<p>cut <a href='x"),
        (6, "http://h", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 2000),
        (7, "http://h", "<article><p>" + "word " * 50_000 + "</p></article>"),
        (8, "http://h", "</p></b><article></div>x</article>"),
    ]
    got = {(i, n): t for i, t, n in text_of(spark, rows)}
    assert got[1, 0] == "" and got[2, 0] == "" and got[None, 10] == "plain text"
    assert got[4, 9] == "a < b & c" and got[5, 3] == "cut" and got[6, 4] == "deep" and (7, 249_999) in got and got[8, 1] == "x"


def test_vector_classes_survive_copies(spark):
    """Pages that are copies do not turn their article into template text."""
    page = "<body><nav><a>n</a></nav><article><p>the same article</p></article><footer>f</footer>"
    rows = [(i, f"http://h.org/{i}", page) for i in range(50)]
    assert {t for _, t, _ in text_of(spark, rows)} == {"the same article"}


@pytest.mark.parametrize(
    "page",
    [
        "<div class='site-content has-sidebar'><article>{}</article></div>",
        "<div class='layout sidebar'><article>{}</article></div><p>Imprint</p>",
        "<form><div class='widget'>{}</div></form>",
        "<div id=page class='nav-open comments-open elementor-widget'><div>{}</div></div>",
        "<article><div class='entry-header'>{}</div></article>",
        "<main><div class='related'><article><p>teaser</p></article></div><article>{}</article></main>",
    ],
)
def test_wrappers_are_not_set_apart(spark, page):
    body = "<h1>The heading</h1><p>What the article says here, in plain words</p>"
    text = "The heading\n\nWhat the article says here, in plain words"
    assert text_of(spark, [(1, "http://h.org/1", page.format(body))]) == [(1, text, len(text))]


@pytest.mark.parametrize(
    "name",
    ["comment-list", "comments-area", "cookie-banner", "ad-container", "newsletter-signup", "sponsored-content"],
)
@pytest.mark.parametrize("place", ["<article>{0}{1}</article>", "<article>{0}</article>{1}", "<div>{0}</div>{1}"])
def test_compound_names_set_apart(name, place):
    page = place.format("<p>What the article says, at some length</p>", f"<div class='x {name}'><p>Other</p></div>")
    template = html_template._Template([], [], [])
    assert template.text(page, {}) == "What the article says, at some length"


def test_formulas_stay():
    page = "<article><p>So <math><mi>a</mi><mo>=</mo><mn>1</mn><annotation>a=1</annotation></math> holds</p></article>"
    assert html_template._Template([], [], []).text(page, {}) == "So a=1 holds"


@pytest.mark.parametrize(
    "page",
    ["<b>x" * 200_000, "<b class=y>x" * 200_000, "<div>x" * 20_000, "<p>x" * 100_000]
    + ["<form>" * 20_000 + "x", "<div><b>" * 50_000 + "</i>" * 50_000 + "x", "<b '>x" * 100_001],
)
def test_time_is_linear_in_the_page(page):
    start = time.process_time()
    assert "x" in html_template._Template([], [], []).text(page, {})
    assert time.process_time() - start < 20


def test_page_facts_tell_occurrence_vectors_apart():
    """The facts of two batches group tokens as whole occurrence vectors do."""
    pages = [
        "".join(f"<p>{w}</p>" for w in f"top {'even' if i % 2 else 'odd'} own{i} low low".split())
        for i in range(12)
    ]
    batch = pa.RecordBatch.from_pydict({"host": ["h"] * 12, "html": pages})
    vectors, found = {}, {}
    for i, page in enumerate(pages):
        words = [text for *_, text in html_template.page_blocks(page, {})]
        for word in words:
            vectors.setdefault(word, [0] * 12)[i] += 1
    halves = [batch.slice(0, 5), batch.slice(5)]
    for out in html_template._page_facts(iter(halves)):
        for r in out.to_pylist():
            if r["kind"] == html_template.TEXT:
                found.setdefault(r["token"], set()).add((r["content"], r["n"]))
    groups, expected = {}, {}
    for token, vector in found.items():
        groups.setdefault(frozenset(vector), set()).add(token)
    for word, vector in vectors.items():
        expected.setdefault(tuple(vector), set()).add(html_template._text_token(0, word))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_template_decides_on_parts_of_names(spark):
    rows = []
    for i in range(6):
        links = f"<div class=related-posts><p><a href=/{i}>Read on about number {i}</a></p></div>"
        rows.append((i, f"http://h.org/{i}", f"<div class=with-sidebar><article><p>Text number {i}</p>{links}</article></div>"))
    assert {t for _, t, _ in text_of(spark, rows)} == {f"Text number {i}" for i in range(6)}


def test_copies_without_article_elements_keep_their_text(spark):
    """A third of a host are copies, exact or with another date each, or it has copies only."""
    copy = "<body><p>By us all, as always since then</p><div class=x><p>The same story, told at length on many pages</p><p>And its second part, as long as the first one</p></div>"
    story = "The same story, told at length on many pages\n\nAnd its second part, as long as the first one"
    rows = [(i, f"http://few.org/{i}", copy) for i in range(3)]
    rows += [(i, f"http://third.org/{i}", copy) for i in range(10, 20)]
    rows += [(i, f"http://date.org/{i}", copy.replace("</div>", f"<p>No {i}</p></div>")) for i in range(20, 30)]
    for host in ("third", "date"):
        for i in range(100, 120):
            other = "".join(f"<p>Some quite different words {i} {j} about {host}</p>" for j in range(3))
            rows.append((i, f"http://{host}.org/{i}", f"<body><p>By us all, as always since then</p><div class=x>{other}</div>"))
    got = {i: t for i, t, _ in text_of(spark, rows) if i < 100}
    assert len(got) == 23 and all(t.startswith(story) for t in got.values())


def test_template_text_inside_articles(spark):
    """A notice on all pages goes, a line on half of them, or of copies only, is content."""
    rows = []
    for i in range(12):
        half = "<p>Ingredients</p>" if i % 2 else ""
        rows.append((i, f"http://h.org/{i}", f"<article><h1>Title {i}</h1>{half}<p>Words that only number {i} has</p><div class=box><p>Subscribe now</p></div></article>"))
    copy = "<article><p>One story, the same on all pages</p><p>Its end</p></article>"
    rows += [(i, f"http://c.org/{i}", f"{copy}<p>{i}</p>") for i in range(20, 26)]
    got = {i: t for i, t, _ in text_of(spark, rows)}
    for i in range(12):
        half = "Ingredients\n\n" if i % 2 else ""
        assert got[i] == f"Title {i}\n\n{half}Words that only number {i} has"
    assert all(got[i] == "One story, the same on all pages\n\nIts end" for i in range(20, 26))


def test_classes_keep_their_order():
    template = html_template._Template([], [[1, 2, 3], [9, 5]], [])
    assert template.in_order([5, 1, 9, 2, 3, 2]) == {1, 2, 3, 9}


@pytest.mark.parametrize("sign", ["&amp;", "&#38;", "&#x26;", "&#038;"])
def test_character_references_in_targets(spark, sign):
    rows = [
        ("http://a.net/fr/1", link(f"http://b.org/?a=1{sign}b=2")),  # blocked by a rule
        ("http://b.org/?a=1&b=2", ""),
        ("http://c.net/fr/2", f"<meta http-equiv=refresh content='0; url=&quot;http:&#47;&#x2F;d.org/?a=1{sign}b=2&#34;'>"),
        ("http://d.org/?a=1&b=2", ""),
        ("http://e.net/fr/3", link(f"http://f.org/?a=1{sign}amp;b=2")),  # decoded once
        ("http://f.org/?a=1&b=2", ""),
    ]
    got = judged(spark, rows)
    assert [got[i]["via"] for i in range(6)] == ["rule", "alias", "rule", "alias", "rule", "default"]
