"""Zero-shot topic tags: scoring, selection, counts, failures and export shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.constants import (
    DEFAULT_HYPOTHESIS_TEMPLATE,
    LABEL_EXPORT_COLUMNS,
    STOPWORDS,
    UNKNOWN_LABEL,
)
from storylake.functions.text import WHITESPACE, is_blank, null_if_blank, tokens, truncate
from storylake.operators.scoring import ScorerFactory, model_outcomes
from storylake.params import LabelParams, clean_overrides
from storylake.schema import require_columns

_STRINGS = "array<string>"
_DOUBLES = "array<double>"


def hypothesis_texts(
    labels: Sequence[str],
    template: str = DEFAULT_HYPOTHESIS_TEMPLATE,
    overrides: Mapping[str, str | None] | None = None,
) -> dict[str, str]:
    """Hypothesis text of each label: its override, else the filled template."""
    chosen = clean_overrides(overrides)
    unknown = [key for key in chosen if key not in labels]
    if unknown:
        raise ValueError(f"hypotheses for labels that are not candidates: {unknown}")
    texts: dict[str, str] = {}
    for label in labels:
        text = chosen.get(label, template.format(label)).strip()
        if not text:
            raise ValueError(f"empty hypothesis text for label {label!r}")
        clash = next((other for other, used in texts.items() if used == text), None)
        if clash is not None and clash != label:
            raise ValueError(f"labels {clash!r} and {label!r} share the text {text!r}")
        texts[label] = text
    return texts


def inference_labels(params: LabelParams) -> tuple[list[str], str, dict[str, str]]:
    """Labels and template to hand to a model, and the way back to canonical labels.

    Without overrides the model gets the labels and the template; with overrides it gets the
    full hypothesis texts and the bare template.
    """
    if not params.hypotheses:
        return list(params.labels), params.hypothesis_template, {x: x for x in params.labels}
    texts = hypothesis_texts(params.labels, params.hypothesis_template, params.hypotheses)
    return list(texts.values()), "{}", {text: label for label, text in texts.items()}


def canonical_labels(labels: Column, mapping: Mapping[str, str]) -> Column:
    """Map inference texts back to labels; unknown texts pass through."""
    table = F.create_map(*[F.lit(part) for entry in mapping.items() for part in entry])
    return F.transform(labels, lambda text: F.coalesce(F.try_element_at(table, text), text))


def label_terms(
    labels: Sequence[str], overrides: Mapping[str, str | None] | None = None
) -> dict[str, list[str]]:
    """Content words of a label and of its override text."""
    stop = {word for words in STOPWORDS.values() for word in words}
    terms = {}
    for label in labels:
        words = f"{label} {(overrides or {}).get(label) or ''}".lower()
        pieces = "".join(c if c.isalnum() else " " for c in words).split()
        terms[label] = sorted({piece for piece in pieces if piece not in stop})
    return terms


def _with_ranking(df: DataFrame, scores: Column, error: Column) -> DataFrame:
    """Label columns from ``array<struct<label,score>>`` in candidate order."""
    ranked = df.withColumn(
        "_ranked",
        F.array_sort(
            F.transform(
                scores,
                lambda s, at: F.struct(
                    (-s["score"]).alias("key"), at.alias("at"), s["label"].alias("label")
                ),
            )
        ),
    )
    failed = error != ""
    labels = F.transform("_ranked", lambda r: r["label"])
    values = F.transform("_ranked", lambda r: -r["key"])
    none = F.array()
    ok_labels = F.when(failed, none.cast(_STRINGS)).otherwise(labels)
    ok_values = F.when(failed, none.cast(_DOUBLES)).otherwise(values)
    return ranked.select(
        *df.columns,
        ok_labels.alias("zeroshot_labels"),
        ok_values.alias("zeroshot_scores"),
        F.when(failed, UNKNOWN_LABEL)
        .otherwise(F.coalesce(F.get(labels, F.lit(0)), F.lit("")))
        .alias("zeroshot_top_label"),
        F.when(~failed, F.get(values, F.lit(0))).alias("zeroshot_top_score"),
        error.alias("zeroshot_error"),
    )


def score_labels(
    df: DataFrame,
    params: LabelParams,
    text_column: str = "text",
) -> DataFrame:
    """Column-only label scoring by overlap of text tokens with each label's content words.

    ``multi_label`` scores every label by itself; otherwise scores are shares that sum to 1.
    Blank text gets empty arrays, an empty top label and a null score.
    """
    require_columns(df, text_column)
    hypothesis_texts(params.labels, params.hypothesis_template, params.hypotheses)
    text = truncate(F.coalesce(F.col(text_column), F.lit("")), params.max_chars)
    terms = label_terms(params.labels, params.hypotheses)
    vocabulary = sorted({word for words in terms.values() for word in words})
    # Only tokens that belong to some label are kept before the labels are counted.
    hits = F.filter(tokens(text), lambda token: token.isin(vocabulary))
    work = df.withColumn("_blank", is_blank(text)).withColumn("_hits", hits)

    def count(words: list[str]) -> Column:
        if not words:
            return F.lit(0)
        return F.size(F.filter("_hits", lambda token: token.isin(words)))

    work = work.withColumn("_counts", F.array(*[count(terms[x]) for x in params.labels]))
    if params.multi_label:

        def score(hit: Column) -> Column:
            return F.round(hit / (hit + 3.0), 6)

    else:
        total = F.aggregate("_counts", F.lit(0), lambda a, n: a + n) + len(params.labels)

        def score(hit: Column) -> Column:
            return F.round((hit + 1) / total, 6)

    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("label"), score(F.get("_counts", F.lit(i))).alias("score"))
            for i, label in enumerate(params.labels)
        ]
    )
    shaped = F.when(F.col("_blank"), F.slice(pairs, 1, 0)).otherwise(pairs)
    scored = work.withColumn("_pairs", shaped)
    return _with_ranking(scored, F.col("_pairs"), F.lit("")).drop(
        "_blank", "_hits", "_counts", "_pairs"
    )


def score_labels_with(
    df: DataFrame,
    params: LabelParams,
    factory: ScorerFactory,
    text_column: str = "text",
) -> DataFrame:
    """Label scoring by a model.

    The scorer gets the columns ``text``, ``labels``, ``template`` and ``multi_label`` and
    returns ``labels`` and ``scores`` lists.  It never sees blank text.  A failed row gets the
    label ``unknown``, empty arrays and its error.
    """
    require_columns(df, text_column)
    texts, template, back = inference_labels(params)
    text = truncate(F.coalesce(F.col(text_column), F.lit("")), params.max_chars)
    output = T.StructType(
        [
            T.StructField("labels", T.ArrayType(T.StringType())),
            T.StructField("scores", T.ArrayType(T.DoubleType())),
        ]
    )

    def make():
        scorer = factory()

        def run(frame: pd.DataFrame) -> pd.DataFrame:
            return scorer(
                frame.assign(
                    labels=[list(texts) for _ in range(len(frame))],
                    template=template,
                    multi_label=params.multi_label,
                )
            )

        return run

    work = df.withColumn("_text", text)
    scored = model_outcomes(
        work.withColumnRenamed(text_column, "_original").withColumnRenamed("_text", "text"),
        make,
        ["text"],
        output,
        skip_blank="text",
    ).drop("text").withColumnRenamed("_original", text_column)
    empty = F.array().cast("array<struct<label:string,score:double>>")
    pairs = F.coalesce(
        F.zip_with(
            canonical_labels(F.col("outcome.output.labels"), back),
            F.col("outcome.output.scores"),
            lambda label, value: F.struct(label.alias("label"), value.alias("score")),
        ),
        empty,
    )
    error = F.coalesce(F.col("outcome.error"), F.lit(""))
    ranked = scored.withColumn("_pairs", pairs).withColumn("_error", error)
    return _with_ranking(ranked, F.col("_pairs"), F.col("_error")).select(
        *df.columns,
        "zeroshot_labels",
        "zeroshot_scores",
        "zeroshot_top_label",
        "zeroshot_top_score",
        "zeroshot_error",
    )


def row_error(df: DataFrame) -> Column:
    """Trimmed error of a row; blank or absent is null."""
    if "zeroshot_error" not in df.columns:
        return F.lit(None).cast("string")
    return null_if_blank(F.col("zeroshot_error"))


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def _score_of(label: Column) -> Column:
    """Score of a label in its row; a label listed twice has its last score."""
    pairs = F.arrays_zip(
        F.col("zeroshot_labels").alias("label"), F.col("zeroshot_scores").alias("score")
    )
    found = F.filter(pairs, lambda p: stripped(p["label"]) == stripped(label))
    return F.get(found, F.size(found) - 1)["score"]


def _passing(labels: Sequence[str], threshold: float) -> Column:
    return F.filter(
        F.array(*[F.lit(label) for label in labels]),
        lambda label: F.coalesce(_score_of(label) >= threshold, F.lit(False)),
    )


def _none_on_error(df: DataFrame, labels: Column) -> Column:
    empty = F.array().cast(_STRINGS)
    return F.when(row_error(df).isNotNull(), empty).otherwise(F.coalesce(labels, empty))


def add_passing_labels(df: DataFrame, labels: Sequence[str], threshold: float) -> DataFrame:
    """Add the labels that reach the threshold, in candidate order."""
    require_columns(df, "zeroshot_labels", "zeroshot_scores")
    return df.withColumn(
        "zeroshot_labels_passing_threshold", _none_on_error(df, _passing(labels, threshold))
    )


def add_selected_labels(
    df: DataFrame,
    labels: Sequence[str],
    threshold: float | None = None,
    top_n: int | None = None,
) -> DataFrame:
    """Add the selected labels: top-n by score, else by threshold, else the top label."""
    require_columns(df, "zeroshot_labels", "zeroshot_scores")
    if top_n is not None and top_n < 1:
        raise ValueError("top_n must be at least 1")
    if top_n is not None:
        chosen = F.slice("zeroshot_labels", 1, top_n)
    elif threshold is not None:
        chosen = _passing(labels, threshold)
    else:
        chosen = F.slice("zeroshot_labels", 1, 1)
    return df.withColumn("zeroshot_labels_selected", _none_on_error(df, chosen))


def classify(
    df: DataFrame,
    params: LabelParams,
    factory: ScorerFactory | None = None,
    text_column: str = "text",
) -> DataFrame:
    """Score labels and add the passing (if a threshold is set) and the selected labels."""
    if factory is None:
        scored = score_labels(df, params, text_column)
    else:
        scored = score_labels_with(df, params, factory, text_column)
    if params.score_threshold is not None:
        scored = add_passing_labels(scored, params.labels, params.score_threshold)
    return add_selected_labels(scored, params.labels, params.score_threshold, params.top_n)


def _counted_labels(df: DataFrame, params: LabelParams) -> Column:
    """Labels a row contributes to the distribution; null when it has no prediction."""
    candidates = F.array(*[F.lit(label) for label in params.labels])
    if params.selection_mode == "top_n":
        hits = F.filter(
            F.slice("zeroshot_labels", 1, params.top_n),
            lambda label: F.array_contains(candidates, label),
        )
    elif params.selection_mode == "threshold_ge":
        hits = _passing(params.labels, params.score_threshold)
    else:
        top = stripped(F.col("zeroshot_top_label"))
        hits = F.filter(F.array(top), lambda label: F.array_contains(candidates, label))
    return F.coalesce(hits, F.array().cast(_STRINGS))


def label_distribution(df: DataFrame, params: LabelParams) -> DataFrame:
    """One row: count per label (in input order), rows, rows without prediction, failed rows."""
    mode_columns = (
        ["zeroshot_top_label"]
        if params.selection_mode == "top_label"
        else ["zeroshot_labels", "zeroshot_scores"]
    )
    require_columns(df, *mode_columns)
    failed = row_error(df).isNotNull()
    rows = df.select(
        failed.alias("failed"),
        F.when(~failed, _counted_labels(df, params)).alias("hits"),
    )

    def occurrences(label: str) -> Column:
        n = F.size(F.filter("hits", lambda hit: hit == label))
        return F.coalesce(F.sum(F.when(~F.col("failed"), n)), F.lit(0).cast("long"))

    totals = rows.agg(
        F.count(F.lit(1)).alias("stories_classified"),
        F.count_if(~F.col("failed") & (F.size("hits") == 0)).alias("stories_without_prediction"),
        F.count_if("failed").alias("stories_classification_failed"),
        *[occurrences(label).alias(f"n{i}") for i, label in enumerate(params.labels)],
    )
    return totals.select(
        F.array(*[F.lit(label) for label in params.labels]).alias("input_labels"),
        F.array(*[F.col(f"n{i}") for i in range(len(params.labels))]).alias("label_counts"),
        "stories_classified",
        "stories_without_prediction",
        "stories_classification_failed",
        F.lit(params.selection_mode).alias("distribution_mode"),
        F.lit(params.score_threshold).cast("double").alias("summary_score_threshold"),
        F.lit(params.top_n).cast("int").alias("summary_top_n"),
        F.lit(params.multi_label).alias("multi_label"),
        F.lit(params.hypothesis_template).alias("hypothesis_template"),
    )


def label_counts(df: DataFrame, params: LabelParams) -> DataFrame:
    """``position, label, count`` for every input label, zero counts included."""
    return label_distribution(df, params).select(
        F.posexplode(F.arrays_zip("input_labels", "label_counts")).alias("position", "pair")
    ).select("position", F.col("pair.input_labels").alias("label"), F.col("pair.label_counts").alias("count"))


def failure_details(
    df: DataFrame,
    id_column: str = "id",
    max_title: int | None = None,
    max_error: int | None = None,
) -> DataFrame:
    """``story_id, title, error`` of the rows that failed, cut only where a length is given."""
    error = row_error(df)
    story = F.col(id_column).cast("string") if id_column in df.columns else F.lit(None)
    title = F.col("title") if "title" in df.columns else F.lit(None)
    return df.filter(error.isNotNull()).select(
        F.coalesce(story, F.lit("")).alias("story_id"),
        truncate(F.coalesce(title.cast("string"), F.lit("")), max_title).alias("title"),
        truncate(error, max_error).alias("error"),
    )


def _exported_labels(mode: str) -> Column:
    if mode in ("top_n", "threshold_ge"):
        trimmed = F.transform("zeroshot_labels_selected", lambda label: stripped(label))
        return F.filter(trimmed, lambda label: label.isNotNull() & (label != ""))
    top = stripped(F.col("zeroshot_top_label"))
    return F.filter(F.array(top), lambda t: t.isNotNull() & (t != "") & (t != UNKNOWN_LABEL))


def tag_scores(df: DataFrame, mode: str = "top_label") -> Column:
    """Map of each exported tag to its score (null if it has none); empty on error."""
    labels = F.array_distinct(_exported_labels(mode))
    scores = F.transform(labels, lambda label: _score_of(label))
    empty = F.create_map().cast("map<string,double>")
    return F.when(row_error(df).isNotNull(), empty).otherwise(
        F.coalesce(F.map_from_arrays(labels, scores), empty)
    )


def tags_for_prompt(df: DataFrame, max_labels: int | None = None) -> Column:
    """Selected labels as ``a; b``, else the top label, else null; null on error."""
    first = F.col("zeroshot_labels_selected")
    if max_labels is not None:
        first = F.slice(first, 1, max_labels)
    named = F.filter(
        F.transform(first, lambda label: stripped(label)),
        lambda label: label.isNotNull() & (label != "") & (label != UNKNOWN_LABEL),
    )
    top = F.nullif(F.nullif(stripped(F.col("zeroshot_top_label")), F.lit("")), F.lit(UNKNOWN_LABEL))
    joined = F.nullif(F.array_join(named, "; "), F.lit(""))
    return F.when(row_error(df).isNull(), F.coalesce(joined, top))


def decode_labels(json_text: Column) -> Column:
    """String array from JSON; anything that is not one becomes an empty array."""
    return F.coalesce(F.from_json(json_text, _STRINGS), F.array().cast(_STRINGS))


def decode_scores(json_text: Column) -> Column:
    return F.coalesce(F.from_json(json_text, _DOUBLES), F.array().cast(_DOUBLES))


def label_export(df: DataFrame) -> DataFrame:
    """Story metadata that is present, then every ``zeroshot_*`` column; never the text.

    Arrays are written as JSON under the name with the suffix ``_json``.
    """
    if "story_id" not in df.columns and "id" in df.columns:
        df = df.withColumnRenamed("id", "story_id")
    columns = [F.col(name) for name in LABEL_EXPORT_COLUMNS if name in df.columns]
    for field in df.schema.fields:
        if not field.name.startswith("zeroshot_"):
            continue
        if isinstance(field.dataType, T.ArrayType):
            columns.append(F.to_json(field.name).alias(f"{field.name}_json"))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)
