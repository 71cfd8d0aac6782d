"""URL filters whose block decisions reach redirects and canonical aliases.

DataFrame expressions only.  Rules decide urls directly; redirect and canonical-link edges make
urls equivalent, and a component that holds a blocked url blocks its undecided members.  An
explicit allow rule keeps its urls out of that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylake.llm.support import components

#: Signs of urls and refresh contents that markup may name; & is last, as it begins the others.
REFERENCES = {
    '"': "quot", "'": "apos", "/": "sol", ":": "colon", "?": "quest", "=": "equals", ";": "semi",
    "#": "num", "%": "percnt", "+": "plus", ",": "comma", ".": "period", "&": "(?:amp|AMP)",
}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, from ``path`` on; verdict is allow or block."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(allow: Sequence[str] = (), block: Sequence[str] = ()) -> list[Rule]:
    """Rules from texts like ``example.com/en/``; the first slash begins the path."""
    rules = []
    for verdict, texts in (("allow", allow), ("block", block)):
        for text in texts:
            host, slash, path = text.partition("/")
            rules.append(Rule(host.lower(), slash + path, verdict))
    return rules


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both are empty for null and for urls without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null.

    The rules are a policy in the query itself, so they become one expression; of equal rules
    with different verdicts allow wins.
    """
    order = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(order):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        answer = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, answer).otherwise(chosen)
    return chosen


def url_node(url: Column) -> Column:
    """What a url stands for in the graph: host, path and query; null if there is no host."""
    host, _ = url_parts(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host != "", F.concat(host, rest))


def decoded(text: Column) -> Column:
    """``text`` with the character references of REFERENCES decoded, each once."""
    for sign, name in REFERENCES.items():
        forms = rf"(?i:&#0*{ord(sign)};|&#x0*{ord(sign):x};)|&{name};"
        text = F.regexp_replace(text, forms, sign)
    return text


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b) from pages to their canonical and refresh targets, as nodes.

    Relative targets are resolved against the page, after their character references; comments
    and scripts are no markup.
    """
    bare = F.regexp_replace(
        F.col(html_col), r"(?is)<!--.*?-->|<script\b[^>]*+>.*?</script\s*+>", " "
    )
    tags = F.regexp_extract_all(bare, F.lit(r"(?i)(<(?:link|meta)\b[^>]*+>)"), F.lit(1))

    def attribute(tag: Column, name: str) -> Column:
        quoted = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
        return F.concat(*[F.regexp_extract(tag, quoted, i) for i in (1, 2, 3)])

    canonical = F.transform(
        F.filter(tags, lambda t: F.lower(attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)")),
        lambda t: decoded(attribute(t, "href")),
    )
    refresh = F.transform(
        F.filter(tags, lambda t: F.lower(attribute(t, "http-equiv")) == "refresh"),
        lambda t: F.regexp_extract(
            decoded(attribute(t, "content")), r"(?i)^[\s\d.]*[;,]\s*(?:url\s*=)?\s*['\"]?([^'\"]*)", 1
        ),
    )
    linking = pages.filter(F.col(html_col).rlike(r"(?i)\b(canonical|refresh)\b"))
    found = linking.select(
        F.col(url_col).alias("url"), F.explode(F.concat(canonical, refresh)).alias("target")
    )
    return resolved_links(found.withColumn("target", F.trim("target")).filter("target <> ''"))


def resolved_links(links: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes from (url, target), targets relative to their url."""
    scheme = F.regexp_extract("url", r"^([^:/?#]*:)//", 1)
    root = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"(?s)^(.*?://[^?#]*/)", 1)
    folder = F.when(F.length(folder) > F.length(root), folder).otherwise(F.concat(root, F.lit("/")))
    target = (
        F.when(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(scheme, "target"))
        .when(F.col("target").startswith("/"), F.concat(root, "target"))
        .when(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(folder, "target"))
    )
    return links.select(url_node(F.col("url")).alias("a"), url_node(target).alias("b")).filter(
        "a is not null and b is not null and a <> b"
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    links: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per input row: the id, host, path, rule, verdict, via.

    The longest rule decides; ``via`` is then ``rule``.  Other urls are blocked (``via`` alias)
    when ``links`` (a, b: nodes as :func:`url_node` makes them) lead to a blocked url, whether
    or not that url is a page here, else allowed (``via`` default).  An allow rule is explicit
    and is never overruled by an alias; an allowed alias does not clear its neighbours.
    A null url, or one without ``://``, has empty host and path and no node.  Ids may be null
    or repeat; an empty table gives no rows; further columns are ignored.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(
        F.col(id_col),
        host.alias("host"),
        path.alias("path"),
        url_node(F.col(url_col)).alias("node"),
    ).withColumn("chosen", matching_rule(F.col("host"), F.col("path"), rules))
    judged = parts.select(
        id_col, "host", "path", "node", "chosen.rule", F.col("chosen.verdict").alias("direct")
    )
    blocked = None
    if links is not None:
        # Only urls with edges can be aliases; all of them are judged, pages or not.
        reached = components(links)
        if not reached.isEmpty():
            url = F.concat(F.lit("x://"), "node")
            aliases = reached.withColumn(
                "direct", matching_rule(*url_parts(url), rules)["verdict"]
            )
            roots = aliases.filter("direct = 'block'").select("root").distinct()
            blocked = reached.join(roots, "root", "left_semi").select(
                "node", F.lit(True).alias("alias")
            )
    if blocked is None:
        judged = judged.withColumn("alias", F.lit(None).cast("boolean"))
    else:
        judged = judged.join(blocked, "node", "left")
    return judged.select(
        id_col,
        "host",
        "path",
        "rule",
        F.coalesce("direct", F.when(F.col("alias"), "block"), F.lit("allow")).alias("verdict"),
        F.when(F.col("direct").isNotNull(), "rule")
        .when(F.col("alias"), "alias")
        .otherwise("default")
        .alias("via"),
    )
