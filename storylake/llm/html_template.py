"""Main text of web pages by equivalence-class template deduction.

After Arasu and Garcia-Molina (2003): on pages of one host, tokens (here element paths and
text blocks) that occur equally often on every page form an equivalence class.  Classes with
enough pages make up the host's template, nested as their paths are; what fills the slots of
the template is content, and the slots of the article are extracted.

Pages of the same content (texts outside links) count once, so copies of an article are not
taken for template text.  Occurrence vectors are never built: each (host, token) keeps the
number of its contents, its total, and a XOR over contents of a hash of (content, count), which
tells vectors apart and combines in any order.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylake.llm.support import shared_table
from storylake.llm.url_filter import url_parts

#: A token is of the template when it stands on so many pages and this share of its host's.
LEAST_PAGES = 3
LEAST_SHARE = 0.3

#: Text inside article elements is of the template on this share of the pages that have them.
ARTICLE_SHARE = 0.9

#: Pages with a class of template text have other text of at least this share of its length.
OTHER_SHARE = 0.25

#: Templates are broadcast up to this size, beyond it joined by a shuffle.
BROADCAST_BYTES = 32 << 20

# Elements by their role in a page.
RAW = frozenset(
    "script style template noscript iframe object svg annotation textarea select title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img br "
    "math semantics mrow mi mo mn ms mtext msup msub msubsup mfrac msqrt mroot mover munder mspace".split()
)
ITEMS = frozenset("li dt dd tr td th option".split())
MAIN = frozenset("article main".split())
APART = frozenset("nav aside form button dialog menu footer".split())
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
    "cookies disqus footer header masthead menu nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related replies share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split()
)

#: A name of several words, the first and last of these, says what an element is as a whole one does.
APART_FIRST = frozenset(
    "ad ads advert comment comments cookie cookies disqus newsletter promo sponsor sponsored subscribe".split()
)
APART_LAST = frozenset(
    "area banner block box container content form item list notice panel section signup thread "
    "unit widget wrap wrapper".split()
)

_TAG = re.compile(
    r"""<(?:(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z))"""
)
_CLOSE = {tag: re.compile(rf"</{tag}\b[^>]*+>", re.IGNORECASE) for tag in RAW}
_NAMES = re.compile(
    r"""\s(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE
)
_WORDS = re.compile(r"[a-z]+")

#: Token of the path of blocks outside all elements.
ROOT = 0


def _token(kind: str, value: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{value}") - (1 << 63)


def _traits(tag: str, attrs: str, inside: bool) -> tuple[str, bool, bool, bool]:
    """(step of the path, sets apart, in doubt, article element) of an element by its start tag."""
    names = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _NAMES.finditer(attrs)]
    main = tag in MAIN or ("role", "main") in names
    listed = APART_WORDS - {"header"} if inside else APART_WORDS
    sets = tag in APART or (tag == "header" and not inside)
    doubt = False
    if tag not in ("html", "body") and not main:
        for _, value in names:
            doubt = doubt or not listed.isdisjoint(_WORDS.findall(value))
            for name in value.split():
                words = _WORDS.findall(name)
                compound = len(words) > 1 and words[0] in APART_FIRST and words[-1] in APART_LAST
                sets = sets or name in listed or compound
    return tag + "".join(f"[{n}={v}]" for n, v in names if n != "role"), sets, doubt, main


class _Element:
    """``sets``: its tag or a name sets it apart; ``doubt``: a part of a name would; ``firm``: its
    tag sets it apart whatever it holds.

    ``home`` is the innermost article element it stands in, itself included; ``apart`` tells of
    all elements above it, ``inner`` of those within ``home``.  ``key`` and ``above`` are tokens of
    the paths of the block it is in and of the parent of that; ``article`` is the key of the
    outermost article element.  Children that differ in nothing are one, kept in ``same``.
    """

    __slots__ = ("above", "apart", "article", "doubt", "firm", "home", "inner", "key", "parent", "same", "sets")

    def __init__(self, tag: str, traits: tuple, parent: _Element | None):
        step, self.sets, doubt, main = traits
        self.firm = tag in APART and tag != "form"
        self.parent = parent
        self.same: dict[tuple[str, str], _Element] = {}
        self.apart = self.sets or (parent.apart if parent else False)
        self.inner = not main and (self.sets or (parent.inner if parent else False))
        self.doubt = (parent.doubt if parent and not main else False) or doubt
        self.home = self if main else parent.home if parent else None
        self.above = parent.key if parent else ROOT
        if tag in INLINE:
            self.key, self.above = (parent.key, parent.above) if parent else (ROOT, ROOT)
        else:
            self.key = _token("path", f"{self.above}/{step}")
        self.article = (parent.article if parent else ROOT) or (self.key if main else ROOT)


def _child(tag: str, attrs: str, parent: _Element | None, traits: dict) -> _Element | None:
    """The element of a start tag; one that is inline and has no attributes is its parent.

    ``traits`` remembers those of the start tags met so far.
    """
    if not attrs and tag in INLINE:
        return parent
    known = parent.same.get((tag, attrs)) if parent else None
    if known is None:
        start = tag, attrs, bool(parent and parent.article)
        found = traits.get(start)
        if found is None:
            found = traits[start] = _traits(*start)
        known = _Element(tag, found, parent)
        if parent and not found[1] and not found[3]:
            parent.same[tag, attrs] = known
    return known


def _chain(element: _Element | None) -> list[_Element]:
    """An element and all above it, outermost first."""
    chain = []
    while element is not None:
        chain.append(element)
        element = element.parent
    return chain[::-1]


def _spared(blocks: list[tuple[_Element | None, int, str]]) -> set:
    """Elements that are not set apart as they hold the article of the page.

    The article is the article element with most text outside links, if that is at least the
    text outside it that nothing sets apart.  On a page without, forms and elements set apart by
    name are spared if they hold all of its text.
    """
    within: dict[_Element, int] = defaultdict(int)
    outside: dict[_Element | None, int] = defaultdict(int)
    free = 0
    for element, links, text in blocks:
        weight = len(text) - links
        home = element.home if element else None
        if element is None or not element.apart:
            free += weight
            outside[home] += weight
        if home is not None and not element.inner:
            within[home] += weight
    holder = max(within, key=within.get, default=None)
    if holder is not None and within[holder] < free - outside[holder]:
        holder = None
    spared: set[_Element] = set()
    while holder is not None:
        if holder.sets:
            spared.add(holder)
        holder = holder.parent
    if blocks and not free and not within:
        common = _chain(blocks[0][0])
        place = {element: i for i, element in enumerate(common)}
        seen: set[_Element | None] = set()
        shared = len(common)
        for element, _, _ in blocks:
            # The innermost element of the first block's that holds this block as well.
            while element is not None and element not in place and element not in seen:
                seen.add(element)
                element = element.parent
            if element not in seen:
                shared = min(shared, place[element] + 1 if element is not None else 0)
        for element in common[:shared]:
            if element.sets and element.firm:
                break
            if element.sets:
                spared.add(element)
    return spared


def page_blocks(page: str, traits: dict) -> Iterator[tuple[_Element | None, bool, int, str]]:
    """(element, set apart, characters in links, text) of each block.

    A block ends where an element that is not inline begins or ends.  Paragraphs and list items
    that are not closed end at the next one; an unclosed tag at the end of the page is no text.
    ``traits`` is a dictionary that the pages of a batch share.
    """
    found = list(_raw_blocks(page, traits))
    spared = _spared(found)
    known: dict[_Element | None, bool] = {None: False}
    for element, links, text in found:
        apart = bool(element and element.apart)
        if apart and spared:
            apart = _known_above(element, known, lambda e: e.sets and e not in spared)
        yield element, apart, links, text


def _known_above(element: _Element | None, known: dict, holds: Callable[[_Element], bool]) -> bool:
    """Whether something holds of an element or one above it; ``known`` has the answers so far."""
    path = []
    while element not in known:
        path.append(element)
        element = element.parent
    answer = known[element]
    for element in reversed(path):
        answer = known[element] = answer or holds(element)
    return answer


def _raw_blocks(page: str, traits: dict) -> Iterator[tuple[_Element | None, int, str]]:
    """(element, characters in links, text) of each block, in time linear in the page."""
    tags: list[str] = []
    elements: list[_Element | None] = []
    blocks: list[int] = []  # places of elements that are not inline
    still_open: dict[str, int] = defaultdict(int)
    parts: list[str] = []
    at: _Element | None = None
    links = 0

    def close(depth: int) -> None:
        for tag in tags[depth:]:
            still_open[tag] -= 1
        del tags[depth:], elements[depth:]
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    pos, size = 0, len(page)
    while pos < size:
        start = page.find("<", pos)
        start = size if start < 0 else start
        match = None
        if start == pos:
            if page.startswith(("<!", "<?"), pos):
                comment = page.startswith("<!--", pos)
                end = page.find("-->", pos + 4) if comment else page.find(">", pos)
                pos = size if end < 0 else end + (3 if comment else 1)
                continue
            match = _TAG.match(page, pos)
            start += 1
        if match is None:
            if not parts:
                at = elements[-1] if elements else None
            parts.append(page[pos:start])
            links += start - pos if still_open["a"] else 0
            pos = start
            continue
        pos = match.end()
        ends, tag, attrs = match.group(1, 2, 3) if match[2] else match.group(4, 5, 6)
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW and not ends:
            match = _CLOSE[tag].search(page, pos)
            pos = match.end() if match else size
            continue
        inline = tag in INLINE
        if parts and not inline:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                yield at, links, text
            parts, links, at = [], 0, None
        if ends:
            if still_open[tag]:
                depth = len(tags) - 1
                while tags[depth] != tag:
                    depth -= 1
                close(depth)
            continue
        if tag in VOID:
            continue
        if not inline:
            # What HTML closes by itself: a paragraph before any block, an item before the next.
            for closed in ("p", tag if tag in ITEMS else "p"):
                if blocks and tags[blocks[-1]] == closed:
                    close(blocks[-1])
        if not attrs.endswith("/"):
            if not inline:
                blocks.append(len(tags))
            elements.append(_child(tag, attrs, elements[-1] if elements else None, traits))
            tags.append(tag)
            still_open[tag] += 1
    text = " ".join(html.unescape("".join(parts)).split())
    if text:
        yield at, links, text


#: Kinds of tokens.
PAGE, ARTICLE_PAGE, PATH, TEXT, ARTICLE_TEXT = range(5)


def _text_token(article: int, text: str) -> int:
    return _token("line" if article else "text", text)


def _where(element: _Element | None) -> tuple[int, int, int, bool]:
    """(path, path above it, path of its article, in doubt) of a block."""
    if element is None:
        return ROOT, ROOT, ROOT, False
    return element.key, element.above, element.article, element.doubt


def _page_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per host, token and content of a page (its text outside links) in a batch.

    Copies in a batch are one row already.
    """
    names = ["host", "token", "content", "kind", "n", "chars", "links", "around", "place", "role"]
    names += ["doubt", "above", "article"]
    kinds = [pa.string(), *[pa.int64()] * 8, pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
    any_page, article_page = _token("page", ""), _token("page", "article")
    for batch in batches:
        facts: dict[tuple[str, int, int], tuple] = {}
        traits: dict = {}
        for host, page in zip(batch["host"].to_pylist(), batch["html"]):
            # Kind, occurrences, characters, in links, first block, role, in doubt, paths.
            seen: dict[int, list] = {any_page: [PAGE, 1, 0, 0, 0, 0, False, ROOT, ROOT]}
            content = xxhash.xxh64()
            around = 0
            blocks = page_blocks(page.as_py() or "", traits)
            for place, (element, apart, links, text) in enumerate(blocks):
                key, above, article, doubt = _where(element)
                size = len(text)
                if key not in seen:
                    role = 2 if apart else 1 if article else 0
                    seen[key] = [PATH, 0, 0, 0, place, role, doubt, above, article]
                tokens = [key]
                if not apart:
                    token = _text_token(article, text)
                    if token not in seen:
                        kind = ARTICLE_TEXT if article else TEXT
                        seen[token] = [kind, 0, 0, 0, place, 0, doubt, ROOT, ROOT]
                    tokens.append(token)
                    if links * 2 < size:
                        content.update(text + "\n")
                        around += size - links
                if article:
                    seen[article_page] = [ARTICLE_PAGE, 1, 0, 0, 0, 0, False, ROOT, ROOT]
                for token in tokens:
                    fact = seen[token]
                    fact[1] += 1
                    fact[2] += size
                    fact[3] += links
            digest = content.intdigest() - (1 << 63)
            for token, (kind, n, chars, links, *rest) in seen.items():
                facts.setdefault((host, token, digest), (kind, n, chars, links, around, *rest))
        rows = [(*k, *v) for k, v in facts.items()]
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], names
        )


def _plain(t: dict) -> bool:
    """Whether less than half of the text is in links."""
    return t["links"] * 2 < t["chars"]


def main_containers(template: list[dict]) -> list[int]:
    """Tokens of paths of the elements that hold the article.

    ``template``: facts of paths, each with its class.  Article elements are it themselves.
    Else the parent under which one class has most text outside links; whatever is nested
    below it, in other classes too, fills its slots.
    """
    articles = sorted({t["article"] for t in template if t["role"] == 1})
    if articles:
        return articles
    weight: dict[tuple, int] = defaultdict(int)
    for t in template:
        if t["role"] == 0 and _plain(t):
            weight[t["above"], *t["class"]] += t["chars"] - t["links"]
    return [max(weight, key=lambda p: (weight[p], p))[0]] if weight else []


def template_classes(facts: list[dict]) -> list[list[dict]]:
    """Classes of text that are of the template, those on most pages first.

    Pages that share a class must differ elsewhere, or they are near copies and the class is
    their article: beside it and the template found so far, they hold at least OTHER_SHARE of
    its text.  Texts in links do not count.  A class is in the order of its first occurrences.
    """
    classes: dict[tuple, list[dict]] = defaultdict(list)
    for t in facts:
        if t["kind"] in (TEXT, ARTICLE_TEXT):
            classes[t["class"]].append(t)
    template, known = [], 0.0
    for key in sorted(classes, key=lambda c: (-c[0], c)):
        own = sum(t["chars"] - t["links"] for t in classes[key] if _plain(t)) / key[0]
        around = max(t["around"] for t in classes[key]) / key[0]
        if around - known - own >= OTHER_SHARE * own:
            # All are on the same pages, so where one is before another on each, its sum is less.
            template.append(sorted(classes[key], key=lambda t: (t["place"], t["token"])))
            known += own
    return template


def _templates(part: pd.DataFrame) -> pd.DataFrame:
    """One row per host: paths that hold the article, tokens of template text, and tokens of
    paths in doubt that are set apart, as their text is mostly links."""
    rows = []
    for host, group in part.groupby("host", sort=False):
        facts = group.to_dict("records")
        for t in facts:
            t["class"] = (t["pages"], t["total"], t["vector"])
        paths = [t for t in facts if t["kind"] == PATH]
        containers = main_containers([t for t in paths if t["token"] != ROOT])
        aside = [t["token"] for t in paths if t["doubt"] and not _plain(t)]
        fixed = [[t["token"] for t in c] for c in template_classes(facts)]
        rows.append((host, containers, fixed, aside))
    return pd.DataFrame(rows, columns=["host", "main", "fixed", "aside"])


def deduce_templates(pages: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """host, main (paths that hold the article), fixed (tokens of repeated text), aside."""
    once = (
        pages.select("host", "html")
        .mapInArrow(
            _page_facts,
            "host string, token long, content long, kind long, n long, chars long, links long, "
            "around long, place long, role int, doubt boolean, above long, article long",
        )
        .groupBy("host", "token", "content")
        .agg(
            *[F.max(c).alias(c) for c in ("kind", "n", "chars", "links", "around")],
            F.min("place").alias("place"),
            F.min("role").alias("role"),
            *[F.max(c).alias(c) for c in ("doubt", "above", "article")],
        )
    )
    facts = (
        once.groupBy("host", "token")
        .agg(
            F.count("*").alias("pages"),
            F.sum("n").alias("total"),
            F.expr("bit_xor(xxhash64(content, n))").alias("vector"),
            *[F.sum(c).alias(c) for c in ("chars", "links", "around", "place")],
            F.min("role").alias("role"),
            *[F.max(c).alias(c) for c in ("kind", "doubt", "above", "article")],
        )
        .filter(F.col("pages") >= least_pages)
    )
    facts = shared_table(facts, "page-tokens")
    counted = facts.filter(F.col("kind").isin(PAGE, ARTICLE_PAGE)).groupBy("host")
    hosts = counted.agg(
        F.max(F.when(F.col("kind") == PAGE, F.col("pages"))).alias("host_pages"),
        F.max(F.when(F.col("kind") == ARTICLE_PAGE, F.col("pages"))).alias("article_pages"),
    )
    least = F.when(
        F.col("kind") == ARTICLE_TEXT, F.col("article_pages") * ARTICLE_SHARE
    ).otherwise(F.col("host_pages") * least_share)
    frequent = (
        facts.filter(~F.col("kind").isin(PAGE, ARTICLE_PAGE))
        .join(hosts, "host")
        .filter(F.col("pages") >= least)
        .drop("host_pages", "article_pages")
    )
    # The tokens of a host are bounded by the length of its pages: each has a share of them.
    return frequent.groupBy("host").applyInPandas(
        _templates, "host string, main array<long>, fixed array<array<long>>, aside array<long>"
    )


class _Template:
    """What a host's row of ``deduce_templates`` says, for use on its pages."""

    def __init__(
        self, main: list[int] | None, fixed: list[list[int]] | None, aside: list[int] | None
    ):
        self.main = frozenset(main or ())
        self.aside = frozenset(aside or ())
        self.classes = fixed or []
        self.place = {
            token: (c, i) for c, members in enumerate(self.classes) for i, token in enumerate(members)
        }

    def in_order(self, tokens: list[int]) -> set[int]:
        """Template tokens of a page: of each class, a longest run of first occurrences in order."""
        found: dict[int, list[int]] = defaultdict(list)
        for token in dict.fromkeys(tokens):
            if token in self.place:
                number, rank = self.place[token]
                found[number].append(rank)
        kept = set()
        for number, ranks in found.items():
            ends: list[int] = []
            ends_at: list[int] = []
            before: list[int] = []
            for i, rank in enumerate(ranks):
                at = bisect_left(ends, rank)
                ends[at : at + 1] = [rank]
                ends_at[at : at + 1] = [i]
                before.append(ends_at[at - 1] if at else -1)
            i = ends_at[-1]
            while i >= 0:
                kept.add(self.classes[number][ranks[i]])
                i = before[i]
        return kept

    def text(self, page: str, traits: dict) -> str:
        """Article blocks of a page, joined by two line feeds.

        A page that its host's template does not fit, or whose host has none, is a template of
        its own: each of its paths is a class.
        """
        blocks = []
        for element, apart, links, text in page_blocks(page, traits):
            key, above, article, doubt = _where(element)
            if not apart and not (doubt and key in self.aside):
                blocks.append((element, key, above, article, links, text))
        inside = _inside(blocks, self.main)
        if not inside:
            facts: dict[int, dict] = {}
            for _, key, above, article, links, text in blocks:
                fact = facts.setdefault(
                    key,
                    {"above": above, "article": article, "class": (key,), "chars": 0, "links": 0}
                    | {"role": 1 if article else 0},
                )
                fact["chars"] += len(text)
                fact["links"] += links
            inside = _inside(blocks, frozenset(main_containers(list(facts.values()))))
        known: set[int] = set()
        if self.place:
            known = self.in_order([_text_token(b[3], b[5]) for b in blocks])
        return "\n\n".join(
            text
            for *_, article, _, text in inside
            if not known or _text_token(article, text) not in known
        )


def _inside(blocks: list[tuple], containers: frozenset[int]) -> list[tuple]:
    """Blocks in an element whose path is one of some; all are in the root."""
    answers: dict[_Element | None, bool] = {None: ROOT in containers}
    return [b for b in blocks if _known_above(b[0], answers, lambda e: e.key in containers)]


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """One row per input row: id, url, text, n_chars (code points of text).

    Null and empty pages have empty text, as have pages without an article.  Pages without a
    host form one group; ids may be null or repeat; further columns are ignored.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        url_parts(F.col(url_col))[0].alias("host"),
        F.col(html_col).alias("html"),
    )
    templates = shared_table(deduce_templates(rows, least_pages, least_share), "page-templates")
    size = templates.agg(
        F.sum(
            8 * (F.size(F.flatten("fixed")) + F.size("fixed") + F.size("aside") + F.size("main"))
            + F.length("host") + 64
        ).alias("bytes")
    ).first()["bytes"]
    if (size or 0) <= BROADCAST_BYTES:
        templates = F.broadcast(templates)
    joined = rows.join(templates, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, _Template] = {}
            traits: dict = {}
            texts = []
            for i, (host, page) in enumerate(zip(batch["host"].to_pylist(), batch["html"])):
                if host not in known:
                    known[host] = _Template(*(batch[c][i].as_py() for c in ("main", "fixed", "aside")))
                texts.append(known[host].text(page.as_py() or "", traits))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string())], ["id", "url", "text"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    done = joined.mapInArrow(run, f"id {kind}, url string, text string")
    return done.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
