"""Validated parameters of the operators and jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from enum import Enum

from storylake.constants import DEFAULT_HYPOTHESIS_TEMPLATE, DEFAULT_LABELS


# Names of strategies and of kinds of targets.
class DedupStrategy(str, Enum):
    NONE = "none"
    TITLE = "title"
    TITLE_SOURCE = "title_source"


class TargetKind(str, Enum):
    GEOGRAPHY = "geography"
    PERSON = "person"
    ORGANIZATION = "organization"
    TOPIC = "topic"
    GENERIC = "generic"
    CUSTOM = "custom"


@dataclass(frozen=True)
class SearchTerms:
    """Structured replacement of an opaque query string."""

    all_of: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    #: (term, mentions, slop): the term occurs ``mentions`` times within ``slop`` tokens.
    near: tuple[tuple[str, int, int], ...] = ()

    def describe(self) -> str:
        parts = []
        if self.all_of:
            parts.append(" AND ".join(self.all_of))
        if self.any_of:
            parts.append("(" + " OR ".join(self.any_of) + ")")
        parts += [f"NOT {term}" for term in self.none_of]
        parts += ['"' + " ".join([term] * k) + f'"~{slop}' for term, k, slop in self.near]
        return " AND ".join(parts)


@dataclass(frozen=True)
class ArticleQuery:
    """What to scan, how to cut it and how to remove duplicates."""

    terms: SearchTerms = field(default_factory=SearchTerms)
    start_date: date | None = None
    end_date: date | None = None
    collection_ids: tuple[int, ...] = ()
    sources: tuple[str, ...] = ()
    dedup_strategy: DedupStrategy = DedupStrategy.NONE
    randomized: bool = False
    seed: int = 0
    max_articles: int = 0

    def __post_init__(self) -> None:
        object.__setattr__(self, "dedup_strategy", DedupStrategy(self.dedup_strategy))
        if self.start_date and self.end_date and self.start_date > self.end_date:
            raise ValueError("start_date lies after end_date")
        if self.max_articles < 0:
            raise ValueError("max_articles must not be negative")


def _unit_interval(name: str, value: float | None) -> None:
    if value is not None and not 0.0 <= value <= 1.0:
        raise ValueError(f"{name} must lie between 0 and 1")


def _at_least_one(name: str, value: int | None) -> None:
    if value is not None and value < 1:
        raise ValueError(f"{name} must be at least 1")


def clean_overrides(overrides: Mapping[str, str | None] | None) -> dict[str, str]:
    """Stripped keys and values; blank ones are left out."""
    return {
        str(key).strip(): str(value).strip()
        for key, value in (overrides or {}).items()
        if value is not None and str(key).strip() and str(value).strip()
    }


@dataclass(frozen=True)
class LabelParams:
    """Candidate labels of zero-shot tagging and how a row's labels are selected."""

    labels: tuple[str, ...] = DEFAULT_LABELS
    hypothesis_template: str = DEFAULT_HYPOTHESIS_TEMPLATE
    hypotheses: Mapping[str, str | None] | None = None
    multi_label: bool = True
    max_stories: int | None = None
    score_threshold: float | None = None
    top_n: int | None = None
    #: Characters of a text that are scored; None is the whole text.  Meant for model scorers.
    max_chars: int | None = None
    #: Tags handed on to a summary prompt; None is all of them.
    max_prompt_tags: int | None = None

    def __post_init__(self) -> None:
        labels = tuple(label.strip() for label in self.labels if label and label.strip())
        if not labels:
            raise ValueError("labels must hold at least one non-empty label")
        if "{}" not in self.hypothesis_template:
            raise ValueError('hypothesis_template must contain "{}"')
        overrides = clean_overrides(self.hypotheses)
        object.__setattr__(self, "labels", labels)
        object.__setattr__(self, "hypotheses", overrides or None)
        _unit_interval("score_threshold", self.score_threshold)
        _at_least_one("top_n", self.top_n)
        for name in ("max_stories", "max_chars", "max_prompt_tags"):
            _at_least_one(name, getattr(self, name))

    @property
    def selection_mode(self) -> str:
        if self.top_n is not None:
            return "top_n"
        return "top_label" if self.score_threshold is None else "threshold_ge"


@dataclass(frozen=True)
class AboutnessParams:
    """Subject against which articles are judged."""

    target: str
    kind: TargetKind = TargetKind.GENERIC
    context: str | None = None
    threshold: float = 0.5
    max_rows: int | None = None

    def __post_init__(self) -> None:
        if not self.target.strip():
            raise ValueError("target must not be blank")
        object.__setattr__(self, "kind", TargetKind(self.kind))
        _unit_interval("threshold", self.threshold)
