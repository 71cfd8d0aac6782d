"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by their membership pattern (the set of sources they belong to).
Token capacity flows from patterns to source quotas; a pattern's first pass costs nothing, each
further pass costs more, so no pattern is repeated while another could serve once.  Within a
pattern documents stand in seeded order on a line of words, passes follow each other, and each
source takes the documents of its stretch.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storylake.llm.support import free_name, local_table, shared_table

#: Rows that a stretch of a pattern's line holds on average; bounds the rows of a window.
STRETCH_ROWS = 20_000

#: Parts in which equal rows are numbered.
SALTS = 64

#: Combinations of sources that the driver routes.
MOST_PATTERNS = 100_000

#: Rounds that bring a source closer to its target by one more document.
CORRECTIONS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def capped_shares(
    sizes: Mapping[object, int], weights: Mapping[object, float], most: float
) -> dict[object, float]:
    """Share the sum of ``sizes`` by weight; no share exceeds ``most`` times its own size.

    What a full share cannot take goes to the others by weight, until none is above.
    """
    left = float(sum(sizes.values()))
    shares: dict[object, float] = {}
    active = list(sizes)
    while active:
        total = sum(weights[s] for s in active)
        full = [s for s in active if left * weights[s] / total > most * sizes[s]]
        if not full:
            shares.update({s: left * weights[s] / total for s in active})
            break
        for s in full:
            shares[s] = float(most * sizes[s])
        left -= sum(shares[s] for s in full)
        active = [s for s in active if s not in shares]
    return shares


def route(
    patterns: Mapping[int, tuple[int, Sequence[object]]], quotas: Mapping[object, int], passes: int
) -> dict[int, dict[object, int]]:
    """Words that each pattern gives to each of its sources: a maximum flow of least cost.

    Costs grow by the pass, and every path leaves by one pass of one pattern, so shortest
    paths come in the order of passes: the flow of each pass is augmented, by breadth-first
    paths over the residual graph, before the next pass opens.
    """
    flow: dict[int, dict[object, int]] = {p: dict.fromkeys(s, 0) for p, (_, s) in patterns.items()}
    members: dict[object, list[int]] = {}
    for p, (_, sources) in patterns.items():
        for s in sources:
            members.setdefault(s, []).append(p)
    unmet = {s: quotas.get(s, 0) for s in members}
    for _ in range(passes):
        spare = {p: size for p, (size, _) in patterns.items()}
        for start in patterns:
            while spare[start] > 0:
                parent: dict[tuple[str, object], tuple[str, object] | None] = {("p", start): None}
                queue, end = deque([("p", start)]), None
                while queue and end is None:
                    kind, node = here = queue.popleft()
                    if kind == "p":
                        steps = [("s", s) for s in patterns[node][1]]
                    elif unmet[node] > 0:
                        end = here
                        break
                    else:
                        steps = [("p", p) for p in members[node] if flow[p][node] > 0]
                    for step in steps:
                        if step not in parent:
                            parent[step] = here
                            queue.append(step)
                if end is None:
                    break
                path = [end]
                while parent[path[-1]] is not None:
                    path.append(parent[path[-1]])
                path.reverse()
                amount = min(spare[start], unmet[end[1]])
                for (kind, node), (_, other) in zip(path, path[1:]):
                    if kind == "s":  # taken back from a pattern that finds another source
                        amount = min(amount, flow[other][node])
                for (kind, node), (_, other) in zip(path, path[1:]):
                    if kind == "p":
                        flow[node][other] += amount
                    else:
                        flow[other][node] -= amount
                spare[start] -= amount
                unmet[end[1]] -= amount
    return flow


def _placed(rows: DataFrame, seed: int) -> DataFrame:
    """Rows with their place ``u`` in seeded order.

    Rows of one id, size and pattern are numbered and placed apart.  They are equal, so it does not
    matter which one has which number, and the places do not depend on how rows are dealt.
    """
    again = shared_table(
        rows.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "mix-repeats"
    )
    several = F.col("id").isNull()
    if not again.isEmpty():
        rows = rows.join(again.withColumn("again", F.lit(True)), "id", "left")
        several = several | F.col("again").isNotNull()
    twins = rows.filter(several).withColumns(
        {"twin": F.xxhash64("id", "size", "pid"), "salt": F.pmod(F.xxhash64("row"), F.lit(SALTS))}
    )
    counts = twins.groupBy("twin", "salt").agg(F.count("*").alias("n"))
    before = W.partitionBy("twin").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("twin", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    number = F.col("first") + F.row_number().over(W.partitionBy("twin", "salt").orderBy("row"))
    numbered = twins.join(bases, ["twin", "salt"]).withColumn("u", F.xxhash64(F.lit(seed), "twin", number))
    alone = rows.filter(~several).withColumn("u", F.xxhash64(F.lit(seed), "id"))
    columns = ["id", "size", "sources", "pid", "row", F.col("u").bitwiseAND(F.lit((1 << 53) - 1)).alias("u")]
    return alone.select(*columns).union(numbered.select(*columns))


def mix(
    docs: DataFrame,
    id_col: str,
    size: Column,
    sources: Column,
    weights,
    passes: int = 3,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Choose documents so that each source comes near its target.

    ``sources`` is an array of source names; null is a source like any other, repeated names
    count once, a document without any is never taken.  ``weights`` maps the list of all
    sources (code point order, null last) to their weights.  The targets share the words of
    all sources by weight, capped at ``passes`` times a source's size.

    Returns (one row per input row: id, sources, size, copies, served: array of (source,
    copies)) and (one row per source: source, source_size, target, taken).  Documents of no
    words have no copies.  Order follows a seeded hash of the id; rows of a repeated or null id
    are documents of their own.  Empty tables give empty results; further columns are ignored.

    Patterns and sources are collected: they are counts by distinct combination, one row for
    each.  More than MOST_PATTERNS combinations raise ValueError.
    """
    result, summary = _mixed(docs, id_col, size, sources, weights, passes, seed)
    return result.drop("row"), summary


def _mixed(
    docs: DataFrame,
    id_col: str,
    size: Column,
    sources: Column,
    weights,
    passes: int = 3,
    seed: int = 0,
    row: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """As :func:`mix`, with the number of each row: ``row``, else one that is written here."""
    rows = shared_table(
        docs.select(
            F.col(id_col).alias("id"),
            size.cast("long").alias("size"),
            F.array_sort(F.array_distinct(sources)).alias("sources"),
            F.xxhash64(F.array_sort(F.array_distinct(sources))).alias("pid"),
            (F.monotonically_increasing_id() if row is None else row).alias("row"),
        ),
        "mix-rows",
    )
    rows = shared_table(_placed(rows, seed), "mix-sizes")
    spark = docs.sparkSession
    found = (
        rows.groupBy("pid", "sources")
        .agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        .limit(MOST_PATTERNS + 1)
        .collect()
    )
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} combinations of sources")
    # The flow depends on the order of the patterns.
    found.sort(key=lambda r: [(s is None, s or "") for s in r["sources"] or ()])
    if len({r["pid"] for r in found}) < len(found):
        raise ValueError("two patterns share a hash; give the sources other names")
    sizes: dict[object, int] = {}
    for r in found:
        for s in r["sources"] or ():
            sizes[s] = sizes.get(s, 0) + r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = capped_shares(sizes, dict(zip(names, weights(names))), passes)
    patterns = {r["pid"]: (r["size"], list(r["sources"] or ())) for r in found}
    flow = route(patterns, {s: math.floor(t) for s, t in targets.items()}, passes)

    info = []
    for r in found:
        at, parts = 0, []
        for s, amount in sorted(flow[r["pid"]].items(), key=lambda x: (x[0] is None, x[0] or "")):
            parts.append((s, at, at + amount))
            at += amount
        info.append((r["pid"], r["size"], parts))
    span = pa.struct([("source", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    facts = local_table(spark, info, {"pid": pa.int64(), "whole": pa.int64(), "parts": pa.list_(span)})

    stretches = max(1, math.ceil(sum(r["n"] for r in found) / STRETCH_ROWS))
    placed = rows.withColumn("stretch", F.shiftright(F.shiftright("u", 22) * stretches, 31))
    by_stretch = placed.groupBy("pid", "stretch").agg(F.sum("size").alias("words"))
    before = W.partitionBy("pid").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    starts = by_stretch.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).join(
        facts, "pid"
    )
    inside = W.partitionBy("pid", "stretch").orderBy("u", "row").rowsBetween(W.unboundedPreceding, -1)
    # Patterns of a third of all rows are split by stretch, in the window as in this join.
    on_line = placed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts.select("pid", "stretch", "base", "whole", "parts"), ["pid", "stretch"]
    )
    turns = F.array(*[F.lit(i) for i in range(passes)])

    def of_part(part: Column) -> Column:
        start = F.col("base") + F.col("within")
        fits = F.filter(
            turns,
            lambda turn: (start + turn * F.col("whole") >= part["start"])
            & (start + turn * F.col("whole") + F.col("size") <= part["stop"])
            & (F.col("size") > 0),
        )
        return F.struct(part["source"].alias("source"), F.size(fits).alias("copies"))

    chosen = shared_table(
        on_line.select("id", "sources", "size", "u", "row", F.transform("parts", of_part).alias("served")),
        "mix-chosen",
    )
    more = _corrections(chosen, targets, passes)
    added = local_table(spark, more, {"row": pa.int64(), "source": pa.string(), "extra": pa.int32()})
    total = F.aggregate("served", F.lit(0), lambda n, x: n + x["copies"])
    if more:
        # At most CORRECTIONS rows a source.
        extra = added.groupBy("row").agg(F.collect_list(F.struct("source", "extra")).alias("extras"))
        joined = chosen.join(F.broadcast(extra), "row", "left")

        def with_extra(part: Column) -> Column:
            matching = F.filter(
                F.coalesce("extras", F.array().cast("array<struct<source:string,extra:int>>")),
                lambda e: e["source"].eqNullSafe(part["source"]),
            )
            return F.struct(
                part["source"].alias("source"),
                F.aggregate(matching, part["copies"], lambda n, e: n + e["extra"]).alias("copies"),
            )

        chosen = joined.withColumn("served", F.transform("served", with_extra)).drop("extras")
    result = chosen.select("id", "sources", "size", total.alias("copies"), "served", "row")
    taken = (
        result.select("size", F.explode("served").alias("part"))
        .groupBy(F.col("part.source").alias("source"))
        .agg(F.sum(F.col("size") * F.col("part.copies")).alias("taken"))
    )
    wanted = local_table(
        spark,
        [(s, sizes[s], targets[s]) for s in names],
        {"name": pa.string(), "source_size": pa.int64(), "target": pa.float64()},
    )
    summary = wanted.join(taken, F.col("name").eqNullSafe(F.col("source")), "left").select(
        F.col("name").alias("source"),
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
    )
    return result, summary


def _corrections(chosen: DataFrame, targets: Mapping[object, float], passes: int) -> list[tuple]:
    """Documents to take once more: whole documents seldom fill a target to the word.

    In each round every source gets the document that brings it nearest, if one does.
    """
    spark = chosen.sparkSession
    picks: list[tuple] = []
    parts = chosen.select(
        "u",
        "row",
        "size",
        F.aggregate("served", F.lit(0), lambda n, x: n + x["copies"]).alias("copies"),
        F.explode("served").alias("part"),
    ).filter("size > 0")
    sums = parts.groupBy("part.source").agg(F.sum(F.col("size") * F.col("part.copies")).alias("taken"))
    missing = {s: t for s, t in targets.items()}
    for row in sums.collect():
        missing[row["source"]] -= row["taken"]
    for _ in range(CORRECTIONS):
        gaps = local_table(spark, missing.items(), {"name": pa.string(), "gap": pa.float64()})
        free = parts.filter(F.col("copies") < passes)
        if picks:
            taken = local_table(spark, [(p[0],) for p in picks], {"row": pa.int64()})
            free = free.join(F.broadcast(taken), "row", "left_anti")
        best = (
            free.join(F.broadcast(gaps), F.col("part.source").eqNullSafe(F.col("name")))
            .filter(F.abs(F.col("gap") - F.col("size")) < F.abs("gap"))
            .groupBy("name")
            .agg(
                F.min(
                    F.struct(
                        F.abs(F.col("gap") - F.col("size")).alias("off"),
                        "u",
                        "row",
                        "size",
                    )
                ).alias("best")
            )
            .collect()
        )
        new = set()
        for row in sorted(best, key=lambda r: (r["name"] is None, r["name"] or "")):
            pick = row["best"]["row"]
            if pick not in new:
                new.add(pick)
                picks.append((pick, row["name"], 1))
                missing[row["name"]] -= row["best"]["size"]
        if not new:
            break
    return picks


def mix_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them; columns unchanged."""
    key, turns = free_name(docs, "_key"), free_name(docs, "_turns")
    # Numbers of rows are fixed by being written with them; a repeated row is several documents.
    numbered = shared_table(docs.withColumn(key, F.monotonically_increasing_id()), "mix-documents")
    result, _ = _mixed(numbered, id_col, row=F.col(f"`{key}`"), **options)
    copies = result.filter("copies > 0").select(F.col("row").alias(key), F.col("copies").alias(turns))
    repeated = F.explode(F.sequence(F.lit(1), F.col(f"`{turns}`")))
    return (
        numbered.join(copies, key)
        .withColumn(turns, repeated)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
