"""Page work: distinct URLs, fetch batches by domain, and the top image of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storylake.operators.skew import HOT_GROUP_ROWS, attach_group_facts
from storylake.schema import ROW_KEY, require_columns

#: Domains are numbered bucket by bucket; a bucket is a prefix of this many hex digits.
_BUCKET_DIGITS = 3

_QUOTED = r"""["']([^"'<>]+)["']"""
_META = r"(?is)<meta\b[^>]*?"
_AD_BLOCK = r"""(?is)<(div|aside)\b[^>]*\bclass=["'](?:[^"']* )?ads?(?: [^"']*)?["'][^>]*>.*?</(?:div|aside)>"""


def distinct_urls(df: DataFrame) -> DataFrame:
    """Every URL once, with the number of articles that carry it."""
    require_columns(df, "url")
    return (
        df.filter(F.col("url").isNotNull())
        .groupBy("url")
        .agg(F.count(F.lit(1)).alias("article_count"))
    )


def url_domain(url: Column) -> Column:
    """Network location of a URL; empty or unparsable gives null."""
    return F.nullif(
        F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")
    )


def urls_by_domain(df: DataFrame, batches: int = 4, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Distinct URLs with their domain and a fetch batch; domains are dealt round-robin.

    One row per URL rather than a list per domain: a list could not be bounded.  URLs
    without a domain are left out.
    """
    urls = (
        distinct_urls(df)
        .select("url", url_domain(F.col("url")).alias("domain"))
        .filter(F.col("domain").isNotNull())
    )
    digest = F.md5("domain")
    domains = (
        urls.groupBy("domain")
        .agg(F.count(F.lit(1)).alias("url_count"))
        .withColumn("digest", digest)
        .withColumn("bucket", F.substring("digest", 1, _BUCKET_DIGITS))
    )
    # Number the domains without a global sort: rank inside evenly filled hash buckets, plus
    # the domains in earlier buckets.  The offset table never exceeds 16 ** 3 rows.
    sizes = domains.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("digest", "domain"))
    dealt = domains.join(F.broadcast(offsets), "bucket").select(
        "domain",
        "url_count",
        ((F.col("offset") + inside - 1) % batches).cast("int").alias("batch"),
    )
    return attach_group_facts(urls, dealt, ["domain"], ["batch"], "url_count", "url", hot_rows)


def top_image_url(html: Column) -> Column:
    """First of og:image, twitter:image, link rel=image_src, or an image outside ads."""

    def meta(name: str) -> list[Column]:
        key = rf"""(?:property|name)=["']{name}["']"""
        return [
            F.regexp_extract(html, rf"{_META}{key}[^>]*?\bcontent={_QUOTED}", 1),
            F.regexp_extract(html, rf"{_META}\bcontent={_QUOTED}[^>]*?{key}", 1),
        ]

    link = r"""(?is)<link\b[^>]*?\brel=["']image_src["'][^>]*?\bhref=""" + _QUOTED
    link_back = r"(?is)<link\b[^>]*?\bhref=" + _QUOTED + r"""[^>]*?\brel=["']image_src["']"""
    image = r"(?is)<img\b[^>]*?\bsrc=" + _QUOTED
    candidates = [
        *meta("og:image"),
        *meta("twitter:image"),
        F.regexp_extract(html, link, 1),
        F.regexp_extract(html, link_back, 1),
        F.regexp_extract(F.regexp_replace(html, _AD_BLOCK, " "), image, 1),
    ]
    return F.coalesce(*[F.nullif(candidate, F.lit("")) for candidate in candidates])


def extract_top_images(pages: DataFrame) -> DataFrame:
    """``url, resolved_url, top_image_url`` per fetched page; a page without an image stays.

    Pages have ``url``, ``html`` and optionally ``resolved_url`` after redirects.
    """
    require_columns(pages, "url", "html")
    resolved = F.col("resolved_url") if "resolved_url" in pages.columns else F.col("url")
    return pages.select(
        "url", resolved.alias("resolved_url"), top_image_url(F.col("html")).alias("top_image_url")
    )


def join_top_images(
    articles: DataFrame, images: DataFrame, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Put page results on every article with that URL.

    Articles whose URL was not fetched get empty strings; fetched pages without an image
    give a null image.
    """
    require_columns(articles, ROW_KEY, "url")
    one_per_url = images.groupBy("url").agg(
        F.max(F.struct("resolved_url", "top_image_url")).alias("page")
    )
    # URLs that were not fetched, and a missing URL, are groups too: any of them may be hot.
    counts = articles.groupBy("url").agg(F.count(F.lit(1)).alias("article_count"))
    found = counts.join(one_per_url, "url", "left")
    joined = attach_group_facts(
        articles, found, ["url"], ["page"], "article_count", ROW_KEY, hot_rows
    )
    fetched = F.col("page").isNotNull()
    return joined.select(
        *articles.columns,
        F.when(fetched, F.col("page.top_image_url")).otherwise("").alias("top_image_url"),
        F.when(fetched, F.col("page.resolved_url")).otherwise("").alias("resolved_url"),
    )
