"""Prompt text built from row fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default prompts.  Placeholders are replaced by row fields; other braces stay as they are.
ABOUTNESS_PROMPT = (
    "Decide how far the article deals with the subject {target}.\n"
    "Background: {context}\nTitle: {title}\nText: {text}\n"
    'Answer with JSON: {"is_about": true or false, "score": 0 to 1, "reason": "short"}'
)
SUMMARY_PROMPT = (
    "Summarise the article.\nFocus of this run: {focus}\nPredicted tags: {tags}\n"
    "Title: {title}\nText: {text}\n"
    'Answer with JSON: {"summary": "text or null", "is_confident": true or false}'
)
QUOTES_PROMPT = (
    'List every direct quote as JSON: {"quotes": [{"quote": "", "speaker": "", '
    '"pronoun": ""}]}.\nText: {text}'
)


def build_prompt(template: str, **fields: Column) -> Column:
    """Insert fields for ``{name}`` placeholders; null fields become empty.

    The template is cut at its placeholders here, so a field that itself contains
    ``{name}`` is never expanded a second time.
    """
    if not fields:
        return F.lit(template)
    pattern = "|".join(re.escape("{" + name + "}") for name in fields)
    parts: list[Column] = []
    position = 0
    for match in re.finditer(pattern, template):
        if match.start() > position:
            parts.append(F.lit(template[position : match.start()]))
        parts.append(F.coalesce(fields[match.group()[1:-1]].cast("string"), F.lit("")))
        position = match.end()
    if position < len(template):
        parts.append(F.lit(template[position:]))
    return F.concat(*parts)
