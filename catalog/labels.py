"""Zero-shot tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ARTICLES, articles, joined, query, toks
from storylake.operators import zeroshot as Z
from storylake.params import LabelParams
from storylake.sources.exports import drop_text

LABELS = ("tion", "rewh orre", "ment", "license", "eau")
HYPOTHESES = {"license": "the software license and copyright"}
PARAMS = LabelParams(labels=LABELS, hypotheses=HYPOTHESES, score_threshold=0.4)
SINGLE = LabelParams(labels=LABELS, hypotheses=HYPOTHESES, multi_label=False)
TOP2 = LabelParams(labels=LABELS, hypotheses=HYPOTHESES, top_n=2)
TOP1 = LabelParams(labels=LABELS, hypotheses=HYPOTHESES)


def label_cte(source: str = "articles", score: str = "round(h / (h + 3.0::DOUBLE), 6)") -> str:
    """``score_row(ingest_seq, pos, label, score)`` and ``ranked`` by score."""
    return f"""
label AS (SELECT * FROM (VALUES (0, 'tion'), (1, 'rewh orre'), (2, 'ment'), (3, 'license'), (4, 'eau')) v(pos, label)),
label_term AS (SELECT * FROM (VALUES (0, 'tion'), (1, 'rewh'), (1, 'orre'), (2, 'ment'), (3, 'license'),
               (3, 'software'), (3, 'copyright'), (4, 'eau')) v(pos, term)),
text_token AS (SELECT ingest_seq, unnest({toks("text")}) AS term FROM {source}),
hits AS (SELECT ingest_seq, pos, count(*) AS n FROM text_token JOIN label_term USING (term) GROUP BY 1, 2),
counted AS (SELECT a.ingest_seq, label.pos, label, coalesce(n, 0) AS h
            FROM {source} a CROSS JOIN label LEFT JOIN hits ON hits.ingest_seq = a.ingest_seq AND hits.pos = label.pos),
score_row AS (SELECT *, {score} AS score FROM counted),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ingest_seq ORDER BY score DESC, pos) AS rank FROM score_row)"""


_SHARE = "round((h + 1) / sum(h + 1.0::DOUBLE) OVER (PARTITION BY ingest_seq), 6)"


def _shown(df):
    millis = F.transform("zeroshot_scores", lambda s: F.round(s * 1000000).cast("long").cast("string"))
    return df.select(
        "ingest_seq",
        joined("zeroshot_labels"),
        F.array_join(millis, "|").alias("zeroshot_scores"),
        "zeroshot_top_label",
        "zeroshot_top_score",
        "zeroshot_error",
    )


def _scores_sql(score: str) -> str:
    return f"""WITH {ARTICLES}, {label_cte(score=score)}
SELECT ingest_seq, string_agg(label, '|' ORDER BY rank) AS zeroshot_labels,
  string_agg(CAST(CAST(round(score * 1000000) AS BIGINT) AS VARCHAR), '|' ORDER BY rank) AS zeroshot_scores,
  max(label) FILTER (rank = 1) AS zeroshot_top_label, max(score) FILTER (rank = 1) AS zeroshot_top_score,
  '' AS zeroshot_error FROM ranked GROUP BY 1"""


@query("zeroshot_scores", _scores_sql("round(h / (h + 3.0::DOUBLE), 6)"))
def _(spark, sf_dir):
    return _shown(Z.score_labels(articles(spark, sf_dir), PARAMS))


@query("zeroshot_scores_single", _scores_sql(_SHARE))
def _(spark, sf_dir):
    return _shown(Z.score_labels(articles(spark, sf_dir), SINGLE))


@query(
    "labels_passing",
    f"""WITH {ARTICLES}, {label_cte()}
SELECT ingest_seq, coalesce(string_agg(label, '|' ORDER BY pos) FILTER (score >= 0.4), '')
         AS zeroshot_labels_passing_threshold FROM ranked GROUP BY 1""",
)
def _(spark, sf_dir):
    tagged = Z.classify(articles(spark, sf_dir), PARAMS)
    return tagged.select("ingest_seq", joined("zeroshot_labels_passing_threshold"))


@query(
    "labels_selected",
    f"""WITH {ARTICLES}, {label_cte()}
SELECT ingest_seq, 'top_n' AS mode, string_agg(label, '|' ORDER BY rank) FILTER (rank <= 2) AS zeroshot_labels_selected
FROM ranked GROUP BY 1
UNION ALL SELECT ingest_seq, 'threshold_ge', coalesce(string_agg(label, '|' ORDER BY pos) FILTER (score >= 0.4), '')
FROM ranked GROUP BY 1
UNION ALL SELECT ingest_seq, 'top_label', string_agg(label, '|') FILTER (rank = 1) FROM ranked GROUP BY 1""",
)
def _(spark, sf_dir):
    scored = Z.score_labels(articles(spark, sf_dir), PARAMS)
    parts = [
        Z.add_selected_labels(scored, LABELS, p.score_threshold, p.top_n).select(
            "ingest_seq", F.lit(p.selection_mode).alias("mode"), joined("zeroshot_labels_selected")
        )
        for p in (TOP2, PARAMS, TOP1)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


#: Every tenth article failed; every eleventh of the rest has no prediction.
_FAILED = "ingest_seq % 10 = 3"
_EMPTY = "ingest_seq % 11 = 5"


def with_failures(df):
    """Tagged articles in which some rows failed and some have no labels."""
    failed, empty = F.expr(_FAILED), F.expr(_EMPTY)
    gone = failed | empty
    return df.withColumns(
        {
            "zeroshot_labels": F.when(gone, F.array().cast("array<string>")).otherwise(
                F.col("zeroshot_labels")
            ),
            "zeroshot_scores": F.when(gone, F.array().cast("array<double>")).otherwise(
                F.col("zeroshot_scores")
            ),
            "zeroshot_top_label": F.when(failed, "unknown")
            .when(empty, "")
            .otherwise(F.col("zeroshot_top_label")),
            "zeroshot_error": F.when(failed, F.concat(F.lit(" Timeout: story "), "id")).otherwise(""),
        }
    )


_COUNTED = f"""WITH {ARTICLES}, {label_cte()},
usable AS (SELECT * FROM ranked WHERE NOT ({_FAILED}) AND NOT ({_EMPTY}))"""


def _counts_sql(where: str) -> str:
    return f"""{_COUNTED},
chosen AS (SELECT pos, count(*) AS n FROM usable WHERE {where} GROUP BY 1)
SELECT CAST(pos AS INTEGER) AS position, label, coalesce(n, 0) AS count FROM label LEFT JOIN chosen USING (pos)"""


def _tagged(spark, sf_dir):
    return with_failures(Z.score_labels(articles(spark, sf_dir), PARAMS))


@query("label_counts_top", _counts_sql("rank = 1"))
def _(spark, sf_dir):
    return Z.label_counts(_tagged(spark, sf_dir), TOP1)


@query("label_counts_threshold", _counts_sql("score >= 0.4"))
def _(spark, sf_dir):
    return Z.label_counts(_tagged(spark, sf_dir), PARAMS)


@query("label_counts_topn", _counts_sql("rank <= 2"))
def _(spark, sf_dir):
    return Z.label_counts(_tagged(spark, sf_dir), TOP2)


@query(
    "label_outcome_counts",
    f"""{_COUNTED}, hit AS (SELECT count(DISTINCT ingest_seq) AS n FROM usable WHERE score >= 0.4)
SELECT count(*) AS stories_classified,
  count(*) FILTER (NOT ({_FAILED})) - (SELECT n FROM hit) AS stories_without_prediction,
  count(*) FILTER ({_FAILED}) AS stories_classification_failed, 'threshold_ge' AS distribution_mode
FROM articles""",
)
def _(spark, sf_dir):
    return Z.label_distribution(_tagged(spark, sf_dir), PARAMS).select(
        "stories_classified",
        "stories_without_prediction",
        "stories_classification_failed",
        "distribution_mode",
    )


@query(
    "zeroshot_failures",
    f"""WITH {ARTICLES}
SELECT CAST(id AS VARCHAR) AS story_id, title, 'Timeout: story ' || id AS error
FROM articles WHERE {_FAILED}""",
)
def _(spark, sf_dir):
    return Z.failure_details(_tagged(spark, sf_dir))


@query(
    "tag_scores",
    f"""WITH {ARTICLES}, {label_cte()},
picked AS (SELECT ingest_seq, string_agg(label || '=' || CAST(round(score * 1000000) AS BIGINT), '|' ORDER BY pos) AS tags
           FROM ranked WHERE score >= 0.4 AND NOT ({_FAILED}) AND NOT ({_EMPTY}) GROUP BY 1)
SELECT ingest_seq, coalesce(tags, '') AS tags FROM articles LEFT JOIN picked USING (ingest_seq)""",
)
def _(spark, sf_dir):
    tagged = Z.add_selected_labels(_tagged(spark, sf_dir), LABELS, 0.4)
    entries = F.transform(
        F.map_entries(Z.tag_scores(tagged, "threshold_ge")),
        lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 1000000).cast("long")),
    )
    return tagged.select("ingest_seq", F.array_join(entries, "|").alias("tags"))


@query(
    "tags_for_prompt",
    f"""WITH {ARTICLES}, {label_cte()},
picked AS (SELECT ingest_seq, string_agg(label, '; ' ORDER BY pos) FILTER (score >= 0.4) AS tags,
           max(label) FILTER (rank = 1) AS top FROM ranked GROUP BY 1)
SELECT ingest_seq, CASE WHEN {_FAILED} OR {_EMPTY} THEN 'none' ELSE coalesce(tags, top) END AS tags FROM picked""",
)
def _(spark, sf_dir):
    tagged = Z.add_selected_labels(_tagged(spark, sf_dir), LABELS, 0.4)
    tags = F.coalesce(Z.tags_for_prompt(tagged), F.lit("none"))
    return tagged.select("ingest_seq", tags.alias("tags"))


@query(
    "zeroshot_export",
    f"""WITH {ARTICLES}, {label_cte()},
picked AS (SELECT ingest_seq, '[' || string_agg('"' || label || '"', ',' ORDER BY rank) || ']' AS labels,
           max(label) FILTER (rank = 1) AS top FROM ranked GROUP BY 1)
SELECT id AS story_id, title, url, CAST(publish_date AS VARCHAR) AS publish_date, media_name, language,
  CASE WHEN {_FAILED} OR {_EMPTY} THEN '[]' ELSE labels END AS zeroshot_labels_json,
  CASE WHEN {_FAILED} THEN 'unknown' WHEN {_EMPTY} THEN '' ELSE top END AS zeroshot_top_label,
  CASE WHEN {_FAILED} THEN ' Timeout: story ' || id ELSE '' END AS zeroshot_error
FROM articles JOIN picked USING (ingest_seq)""",
)
def _(spark, sf_dir):
    exported = Z.label_export(_tagged(spark, sf_dir).drop("zeroshot_scores", "zeroshot_top_score"))
    return drop_text(exported).withColumn("publish_date", F.col("publish_date").cast("string"))
