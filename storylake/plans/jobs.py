"""The eleven composed jobs.

Each job takes an article table and parameters and returns named DataFrames.  They are lazy,
but for rows that a model has scored or that several outputs of a long job share: those are
checkpointed once.  Steps that cost little come before steps that
cost much, and every result that is exported drops the article text first where the export
does, so the text is pruned before any shuffle that follows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylake.constants import DEFAULT_MODEL, NEGATIVE_WORDS, POSITIVE_WORDS, STOPWORDS
from storylake.functions.prompts import QUOTES_PROMPT, build_prompt
from storylake.operators import keywords as keyword_ops
from storylake.operators.aboutness import (
    aboutness_summary,
    filter_aboutness,
    prompt_usage,
    score_aboutness,
)
from storylake.operators.aggregates import query_summary, top_entities, top_values, usage_cost
from storylake.operators.dedup import deduplicate
from storylake.operators.entities import extract_entities
from storylake.operators.images import extract_top_images, join_top_images
from storylake.operators.prompted import (
    aboutness_with,
    quotes_with,
    sentiment_with,
    summaries_with,
)
from storylake.operators.quotes import quote_table
from storylake.operators.scoring import ScorerFactory
from storylake.operators.selection import limit_after_dedup
from storylake.operators.sentences import matching_sentences as match_sentences
from storylake.operators.sentences import targeted_sentiment as add_sentiment
from storylake.operators.summaries import summarize_articles
from storylake.operators.zeroshot import (
    classify,
    failure_details,
    label_distribution,
    label_export,
    tag_scores,
    tags_for_prompt,
)
from storylake.params import AboutnessParams, ArticleQuery, DedupStrategy, LabelParams
from storylake.schema import ROW_KEY
from storylake.session import materialize
from storylake.sources.articles import query_articles, scan_articles, scan_duplicates
from storylake.sources.exports import contract_columns, drop_text

Outputs = dict[str, DataFrame]


def _scan(
    articles: DataFrame, query: ArticleQuery, collection_sources: DataFrame | None
) -> tuple[DataFrame, Outputs]:
    # Once for all outputs: a cap writes the keys it takes.
    matched = query_articles(articles, query, collection_sources)
    stories, dedup = scan_articles(articles, query, collection_sources, matched)
    return stories, {
        "query_summary": query_summary(stories, query, dedup),
        "dedup_summary": dedup,
        "duplicates": scan_duplicates(articles, query, collection_sources, matched),
    }


def _scan_title_source(
    articles: DataFrame, query: ArticleQuery, collection_sources: DataFrame | None
) -> tuple[DataFrame, Outputs]:
    """Jobs on sentences and images always remove copies by title and source."""
    stories, records = _scan(articles, query, collection_sources)
    return deduplicate(stories, DedupStrategy.TITLE_SOURCE), records


def keywords(
    articles: DataFrame,
    query: ArticleQuery,
    top_n: int = keyword_ops.TOP_N,
    dedup_limit: float = keyword_ops.DEDUP_LIMIT,
    stopwords: Mapping[str, Sequence[str]] = STOPWORDS,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Keywords per article and the fifty most common keywords of the query."""
    stories, outputs = _scan(articles, query, collection_sources)
    tagged = keyword_ops.article_keywords(
        stories, top_n=top_n, dedup_limit=dedup_limit, stopwords=stopwords
    )
    # Both outputs come from one narrow table, so that no article is scored twice.
    found = materialize(tagged.select(ROW_KEY, "keywords"), "keywords")
    outputs["top_keywords"] = top_values(found, "keywords", 50)
    outputs["stories"] = stories.drop("keywords").join(found, ROW_KEY)
    return outputs


def entities(
    articles: DataFrame,
    query: ArticleQuery,
    gazetteer: Mapping[str, str] | DataFrame,
    top_n: int = 10,
    filter_type: str | None = None,
    sort_by: str = "total",
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Entities per article and the most frequent entities of the query."""
    stories, outputs = _scan(articles, query, collection_sources)
    tagged = extract_entities(stories, gazetteer)
    outputs["stories"] = tagged
    outputs["top_entities"] = top_entities(
        tagged, top_n=top_n, filter_type=filter_type, sort_by=sort_by
    )
    return outputs


def matching_sentences(
    articles: DataFrame,
    query: ArticleQuery,
    patterns: Sequence[str] | None = None,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Sentences that match any pattern, from articles without copies."""
    stories, outputs = _scan_title_source(articles, query, collection_sources)
    outputs["sentences"] = match_sentences(stories, patterns)
    return outputs


def targeted_sentiment(
    articles: DataFrame,
    query: ArticleQuery,
    target: str,
    patterns: Sequence[str] | None = None,
    positive: Iterable[str] = tuple(POSITIVE_WORDS),
    negative: Iterable[str] = tuple(NEGATIVE_WORDS),
    scorer: ScorerFactory | None = None,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Sentiment towards a target of the sentences that match any pattern (default: all)."""
    stories, outputs = _scan_title_source(articles, query, collection_sources)
    sentences = match_sentences(stories, patterns)
    if scorer is not None:
        outputs["sentences"] = sentiment_with(sentences, scorer, target)
    else:
        outputs["sentences"] = add_sentiment(
            sentences, target, positive=positive, negative=negative
        )
    return outputs


def top_images(
    articles: DataFrame,
    query: ArticleQuery,
    pages: DataFrame,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Top image of every article whose page was fetched."""
    stories, outputs = _scan_title_source(articles, query, collection_sources)
    outputs["stories"] = join_top_images(drop_text(stories), extract_top_images(pages))
    return outputs


def full_text(
    articles: DataFrame,
    query: ArticleQuery,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Articles with their text; a cap (``max_articles``) applies before copies are removed."""
    stories, outputs = _scan(articles, query, collection_sources)
    outputs["stories"] = stories
    return outputs


def summaries(
    articles: DataFrame,
    query: ArticleQuery,
    focus: str | None = None,
    model: str = DEFAULT_MODEL,
    scorer: ScorerFactory | None = None,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """A summary per article and the usage totals."""
    stories, outputs = _scan(articles, query, collection_sources)
    if scorer is not None:
        summarized = drop_text(summaries_with(stories, scorer, focus))
    else:
        summarized = drop_text(summarize_articles(stories, focus))
    outputs["stories"] = summarized.drop("usage")
    outputs["cost"] = usage_cost(summarized, model=model)
    return outputs


def quotes(
    articles: DataFrame,
    query: ArticleQuery,
    model: str = DEFAULT_MODEL,
    scorer: ScorerFactory | None = None,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Quotes with speakers and the usage totals over all articles asked."""
    stories, outputs = _scan(articles, query, collection_sources)
    if scorer is not None:
        outputs["quotes"], calls = quotes_with(stories, scorer)
        outputs["cost"] = usage_cost(calls, model=model)
        outputs["failures"] = calls.filter("llm_error is not null").drop("usage")
        return outputs
    outputs["quotes"] = quote_table(stories)
    found = F.array_join(F.regexp_extract_all("text", F.lit('["“]([^"“”]+)["”]'), F.lit(1)), " ")
    usage = prompt_usage(build_prompt(QUOTES_PROMPT, text=F.col("text")), found)
    outputs["cost"] = usage_cost(stories.select(usage.alias("usage")), model=model)
    return outputs


def aboutness_filter(
    articles: DataFrame,
    query: ArticleQuery,
    about: AboutnessParams,
    max_stories: int | None = None,
    model: str = DEFAULT_MODEL,
    scorer: ScorerFactory | None = None,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Articles about the target, the filter summary, and all scored rows."""
    stories, outputs = _scan(articles, query, collection_sources)
    stories = limit_after_dedup(stories, max_stories)
    if scorer is not None:
        scored = aboutness_with(stories, scorer, about.target, about.context, about.max_rows)
    else:
        scored = score_aboutness(stories, about.target, about.context, max_rows=about.max_rows)
    outputs["scored"] = drop_text(scored).drop("usage")
    outputs["stories"] = drop_text(filter_aboutness(scored, about.threshold)).drop("usage")
    outputs["filter_summary"] = aboutness_summary(
        scored, about.threshold, about.target, about.kind.value
    )
    outputs["cost"] = usage_cost(scored, model=model)
    return outputs


def zero_shot(
    articles: DataFrame,
    query: ArticleQuery,
    labels: LabelParams,
    scorer: ScorerFactory | None = None,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Topic tags per article, their distribution and the failures."""
    stories, outputs = _scan(articles, query, collection_sources)
    tagged = classify(limit_after_dedup(stories, labels.max_stories), labels, scorer)
    outputs["stories"] = label_export(tagged)
    outputs["label_summary"] = label_distribution(tagged, labels)
    outputs["failures"] = failure_details(tagged)
    return outputs


def summary_focus(focus: str | None, target: str) -> str | None:
    """Run focus of the summaries: unset means the target, blank means none."""
    chosen = target if focus is None else focus
    return chosen.strip() or None


def tagged_summaries(
    articles: DataFrame,
    query: ArticleQuery,
    about: AboutnessParams,
    labels: LabelParams,
    focus: str | None = None,
    scorer: ScorerFactory | None = None,
    model: str = DEFAULT_MODEL,
    collection_sources: DataFrame | None = None,
) -> Outputs:
    """Filter by subject, tag, then summarise what is left with its tags.

    Copies are always removed by title, whatever the query says.
    """
    query = replace(query, dedup_strategy=DedupStrategy.TITLE)
    stories, outputs = _scan(articles, query, collection_sources)
    stories = limit_after_dedup(stories, labels.max_stories)
    scored = score_aboutness(stories, about.target, about.context, max_rows=about.max_rows)
    tagged = classify(filter_aboutness(scored, about.threshold).drop("usage"), labels, scorer)
    # Few articles pass the filter and four outputs read them, so they are written once.
    tagged = materialize(tagged.withColumn("_prompt_tags", tags_for_prompt(tagged, labels.max_prompt_tags)))
    summarized = summarize_articles(
        tagged, summary_focus(focus, about.target), "_prompt_tags", about.max_rows
    )
    exported = drop_text(summarized).withColumns(
        {
            "zero-shot-tags": F.to_json("zeroshot_labels_selected"),
            "zero-shot-tag-scores": F.to_json(
                tag_scores(summarized, labels.selection_mode), {"ignoreNullFields": "false"}
            ),
        }
    )
    outputs["stories"] = contract_columns(exported)
    outputs["scored"] = scored.drop("usage")
    outputs["filter_summary"] = aboutness_summary(
        scored, about.threshold, about.target, about.kind.value
    )
    outputs["label_summary"] = label_distribution(tagged, labels)
    outputs["failures"] = failure_details(tagged)
    outputs["aboutness_cost"] = usage_cost(scored, model=model)
    outputs["summary_cost"] = usage_cost(summarized, model=model)
    return outputs


JOBS = {
    "keywords": keywords,
    "entities": entities,
    "matching_sentences": matching_sentences,
    "targeted_sentiment": targeted_sentiment,
    "top_images": top_images,
    "full_text": full_text,
    "summaries": summaries,
    "quotes": quotes,
    "tagged_summaries": tagged_summaries,
    "aboutness_filter": aboutness_filter,
    "zero_shot": zero_shot,
}
