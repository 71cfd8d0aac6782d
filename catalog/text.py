"""Scalar functions on text."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ARTICLES, WS, articles, norm, query, quoted
from storylake.constants import DEFAULT_HYPOTHESIS_TEMPLATE
from storylake.functions import text as X
from storylake.functions.prompts import SUMMARY_PROMPT, build_prompt
from storylake.operators.zeroshot import canonical_labels, decode_labels, decode_scores, hypothesis_texts


@query("normalize_text", f"WITH {ARTICLES} SELECT id, {norm('text')} AS normalized FROM articles")
def _(spark, sf_dir):
    return articles(spark, sf_dir).select("id", X.normalize_text(F.col("text")).alias("normalized"))


@query(
    "hash_text",
    f"""WITH {ARTICLES}
SELECT id, CASE WHEN {norm('text')} = '' THEN '' ELSE md5({norm('text')}) END AS text_hash
FROM articles""",
)
def _(spark, sf_dir):
    return articles(spark, sf_dir).select("id", X.hash_text(F.col("text")).alias("text_hash"))


@query(
    "truncate_text",
    f"""WITH {ARTICLES}
SELECT id, substr(text, 1, 500) AS cut, text AS uncut FROM articles""",
)
def _(spark, sf_dir):
    text = F.col("text")
    return articles(spark, sf_dir).select(
        "id", X.truncate(text, 500).alias("cut"), X.truncate(text, 0).alias("uncut")
    )


@query(
    "url_slug",
    f"""WITH {ARTICLES},
a AS (SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        strip_accents(lower(title)), '({WS}|_)+', '-', 'g'),
        '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS s FROM articles),
b AS (SELECT *, substr(s, 1, 16) AS c,
             length(substr(s, 1, 16)) - strpos(reverse(substr(s, 1, 16)), '-') AS h FROM a)
SELECT id, regexp_replace(
  CASE WHEN length(s) <= 16 THEN s
       WHEN strpos(c, '-') > 0 AND h > 8 THEN substr(c, 1, h) ELSE c END, '-+$', '') AS slug
FROM b""",
)
def _(spark, sf_dir):
    return articles(spark, sf_dir).select("id", X.url_slug(F.col("title")).alias("slug"))


_LANGUAGE_LABELS = ["de", "en", "es", "fr"]
_OVERRIDES = {"fr": " un texte en français ", "de": "  "}


@query(
    "hypothesis_text",
    f"""WITH {ARTICLES}
SELECT id, language, CASE language WHEN 'fr' THEN 'un texte en français'
  ELSE 'This text is about ' || language END AS hypothesis FROM articles""",
)
def _(spark, sf_dir):
    texts = hypothesis_texts(_LANGUAGE_LABELS, DEFAULT_HYPOTHESIS_TEMPLATE, _OVERRIDES)
    pairs = F.create_map(*[F.lit(part) for entry in texts.items() for part in entry])
    return articles(spark, sf_dir).select(
        "id", "language", F.try_element_at(pairs, F.col("language")).alias("hypothesis")
    )


@query(
    "label_mapping",
    f"""WITH {ARTICLES}
SELECT id, CASE language WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE language END
  || '|' || media_name AS labels FROM articles""",
)
def _(spark, sf_dir):
    mapped = canonical_labels(
        F.array("language", "media_name"), {"fr": "french", "de": "german"}
    )
    return articles(spark, sf_dir).select("id", F.array_join(mapped, "|").alias("labels"))


def _prompt_sql() -> str:
    parts = SUMMARY_PROMPT
    pieces = []
    for name, expr in (
        ("{focus}", "'the {title}'"),
        ("{tags}", "''"),
        ("{title}", "title"),
        ("{text}", "text"),
    ):
        before, parts = parts.split(name)
        pieces += [quoted(before), expr]
    return " || ".join([*pieces, quoted(parts)])


@query("build_prompt", f"WITH {ARTICLES} SELECT id, {_prompt_sql()} AS prompt FROM articles")
def _(spark, sf_dir):
    prompt = build_prompt(
        SUMMARY_PROMPT,
        focus=F.lit("the {title}"),
        tags=F.lit(None),
        title=F.col("title"),
        text=F.col("text"),
    )
    return articles(spark, sf_dir).select("id", prompt.alias("prompt"))


@query(
    "json_labels",
    f"""WITH {ARTICLES}
SELECT id, CASE WHEN id % 4 = 0 THEN '' ELSE language || '|' || media_name END AS labels,
       CASE WHEN id % 4 = 0 THEN 0 ELSE 2 END AS n_labels,
       CASE WHEN id % 4 = 0 THEN 0.0::DOUBLE ELSE 0.25::DOUBLE + (id % 8)::DOUBLE END AS score_sum
FROM articles""",
)
def _(spark, sf_dir):
    df = articles(spark, sf_dir)
    broken = F.col("id") % 4 == 0
    labels = F.when(broken, "not json").otherwise(F.to_json(F.array("language", "media_name")))
    numbers = F.array(F.lit(0.25), (F.col("id") % 8).cast("double"))
    scores = F.when(broken, "[0.25").otherwise(F.to_json(numbers))
    encoded = df.select("id", labels.alias("labels_json"), scores.alias("scores_json"))
    decoded = decode_labels(F.col("labels_json"))
    values = decode_scores(F.col("scores_json"))
    return encoded.select(
        "id",
        F.array_join(decoded, "|").alias("labels"),
        F.size(decoded).alias("n_labels"),
        F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("score_sum"),
    )
