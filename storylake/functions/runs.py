"""Grouping inside one row: arrays sorted by a field and cut into runs of equal values.

For work that is local to a row and would else need a row per entry, to be gathered again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_value(df: DataFrame, name: str, value: Column, *kept: str | Column) -> DataFrame:
    """The kept columns and a computed one, which is a column for good.

    What leaves a generator is not merged into the expressions above it, which would compute it
    for every entry that refers to it, nor copied below it by filters on what follows.
    """
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def run_starts(ordered: Column, field: str) -> Column:
    """Where the runs of equal values of a field start in a sorted array."""

    def start(entry: Column, at: Column) -> Column:
        return F.when((at == 0) | (F.get(ordered, at - 1)[field] != entry[field]), at)

    return F.filter(F.transform(ordered, start), lambda at: at.isNotNull())


def run_length(ordered: Column, starts: Column, start: Column, number: Column) -> Column:
    return F.coalesce(F.get(starts, number + 1), F.size(ordered)) - start


def run(ordered: Column, starts: Column, start: Column, number: Column) -> Column:
    """The entries of a run, for ``transform`` over the starts."""
    return F.slice(ordered, start + 1, run_length(ordered, starts, start, number))
