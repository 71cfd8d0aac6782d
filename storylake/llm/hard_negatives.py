"""Hard negatives by coordinate pruning in length buckets, in the manner of LEMP's COORD.

Rows are integer vectors, written in order of their length, and searched in buckets.  A bucket
holds for every coordinate its (normalised) values in order.  A search asks a bucket for the rows
whose inner product with an anchor reaches a threshold:

* by Cauchy-Schwarz, no row does if ``|anchor| * |longest row|`` falls short;
* a row whose cosine reaches ``c`` has in coordinate f, where the unit anchor has ``a``, a value
  from ``a c - sqrt((1 - a^2)(1 - c^2))`` to ``a c + sqrt((1 - a^2)(1 - c^2))``.  The ranges of the
  anchor's largest coordinates, its focus, are looked up in the sorted lists, and only rows in
  all of them are candidates;
* candidates are scored exactly, in integers.

Positives are searched first: per task, the threshold of an anchor is the score of its worst
positive so far.  Their scores then fix the range of the negatives of each positive, whose lower
end, and the worst negative so far, are the thresholds of the second search.

Anchors are taken in blocks of bounded size, each block against all rows; a task returns at most
the asked number of rows per anchor, or per positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storylake.llm.support import releasing, shared_table

#: Anchors of a block: the vectors that are broadcast at once.
ANCHORS = 4096

#: Rows of a length bucket.
BUCKET = 1024

#: Coordinates whose feasible ranges are intersected.
FOCUS = 4

#: An anchor whose narrowest range holds more than this share of a bucket is scored with others, by
#: one product with the whole bucket.
DENSE = 0.25

#: Anchors of such a product, and hits that are handed on at once.
TOGETHER = 256
HITS = 1 << 16

#: Widens floating-point bounds, so that rounding never excludes a row.
_SLACK = 1e-9

#: Stands for a null id; it comes last among equal scores.
_NO_ID = np.int64(2**63 - 1)


@dataclass(frozen=True)
class Anchors:
    """Anchors of one dimension: their number in the block, id, label, vector and length."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray

    @classmethod
    def build(cls, number, ids, labels, vectors) -> Anchors:
        vectors = np.asarray(vectors, dtype=np.int64).reshape(len(ids), -1)
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        return cls(np.asarray(number), np.asarray(ids, np.int64), np.asarray(labels), vectors, lengths)

    @cached_property
    def units(self) -> np.ndarray:
        return self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]

    @cached_property
    def leading(self) -> np.ndarray:
        """Coordinates of every anchor, the largest first."""
        return np.argsort(-np.abs(self.units), axis=1, kind="stable")

    def some(self, chosen: np.ndarray) -> Anchors:
        return Anchors(*(x[chosen] for x in (self.number, self.ids, self.labels, self.vectors, self.lengths)))


class Bucket:
    """Vectors of similar length with their coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        self.units = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        # A line for each coordinate, with its values in order.
        lines = np.ascontiguousarray(self.units.T)
        self.order = np.argsort(lines, axis=1, kind="stable")
        self.sorted = np.take_along_axis(lines, self.order, axis=1)

    def scores(self, anchors: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        """Exact inner products (anchors x rows)."""
        theirs = self.vectors[rows]
        top = float(np.abs(anchors).max(initial=0)) * float(np.abs(theirs).max(initial=0))
        if top * max(anchors.shape[1], 1) < 2**52:
            return np.rint(anchors.astype(float) @ theirs.T.astype(float)).astype(np.int64)
        return anchors @ theirs.T

    def ranges(self, units: np.ndarray, lengths: np.ndarray, chosen: np.ndarray, need: np.ndarray):
        """For the chosen coordinates of each anchor: least and largest feasible value, and
        where in the coordinate's line they begin and end.  ``need`` is positive."""
        cosine = np.minimum(need / (lengths * self.longest) * (1 - _SLACK), 1.0)[:, None]
        unit = np.take_along_axis(units, chosen, axis=1)
        middle = unit * cosine
        spread = np.sqrt(np.maximum(1 - unit**2, 0) * (1 - cosine**2)) + _SLACK
        # Where the anchor's own value lies beyond the threshold, no value of its side is too large.
        low = np.where(-unit >= cosine, -2.0, middle - spread)
        high = np.where(unit >= cosine, 2.0, middle + spread)
        first, last = np.empty(chosen.shape, np.int64), np.empty(chosen.shape, np.int64)
        for f in np.unique(chosen).tolist():
            here = chosen == f
            first[here] = np.searchsorted(self.sorted[f], low[here], side="left")
            last[here] = np.searchsorted(self.sorted[f], high[here], side="right")
        return low, high, first, last

    def inside(self, chosen, low, high, first, last) -> np.ndarray:
        """Rows in all ranges of one anchor: those of the narrowest, if the others hold them too."""
        at = np.argmin(last - first)
        rows = np.sort(self.order[chosen[at], first[at] : last[at]])
        values = self.units[rows[:, None], chosen]
        return rows[((values >= low) & (values <= high)).all(axis=1)]

    def candidates(self, anchor: np.ndarray, length: float, need: float, focus: int) -> np.ndarray | None:
        """Rows whose focus coordinates allow one anchor a score of ``need``; None stands for all rows."""
        if need <= 0 or not anchor.size:
            return None
        unit = (anchor / length)[None]
        chosen = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :focus]
        found = self.ranges(unit, np.array([length]), chosen, np.array([need]))
        return self.inside(chosen[0], *(x[0] for x in found))


def scan(
    bucket: Bucket, anchors: Anchors, need: np.ndarray, focus: int = FOCUS, dense: float = DENSE
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors' indexes, rows, scores) of the rows of a bucket that score ``need`` or more.

    ``need`` is read when an anchor's turn comes, so a caller may raise it in between.
    """
    asking = anchors.lengths * bucket.longest * (1 + _SLACK) >= need
    bound = np.flatnonzero(asking & (need > 0)) if anchors.vectors.shape[1] else np.zeros(0, np.int64)
    chosen = anchors.leading[bound, :focus]
    found = bucket.ranges(anchors.units[bound], anchors.lengths[bound], chosen, need[bound])
    few = (found[3] - found[2]).min(axis=1, initial=len(bucket.ids)) <= dense * len(bucket.ids)
    hits, held = [], 0
    for at in np.flatnonzero(few).tolist():
        i = bound[at]
        rows = bucket.inside(chosen[at], *(x[at] for x in found))
        scores = bucket.scores(anchors.vectors[i : i + 1], rows)[0]
        enough = np.flatnonzero(scores >= need[i])
        hits.append((np.full(len(enough), i), rows[enough], scores[enough]))
        held += len(enough)
        if held >= HITS:
            yield tuple(np.concatenate(x) for x in zip(*hits, strict=True))
            hits, held = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*hits, strict=True))
    asking[bound[few]] = False
    together = np.flatnonzero(asking)
    for start in range(0, len(together), TOGETHER):
        some = together[start : start + TOGETHER]
        scores = bucket.scores(anchors.vectors[some], slice(None))
        at, rows = np.nonzero(scores >= need[some][:, None])
        if len(at):
            yield some[at], rows, scores[at, rows]


class _Best:
    """The k best (score, id) of each of several lists, and the least score that still counts."""

    def __init__(self, need: np.ndarray, k: int):
        self.k, self.need = k, need
        self.counts = np.zeros(len(need), np.int64)
        self.scores = np.zeros((len(need), k), np.int64)
        self.ids = np.zeros((len(need), k), np.int64)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer every (score, id) to its list; ``lists`` is ascending and not empty."""
        starts = np.flatnonzero(np.diff(lists, prepend=-1))
        touched, sizes = lists[starts], np.diff(starts, append=len(lists))
        # Of k parts of what a list is offered each has a best score; k entries reach the least of these.
        parts = starts[:, None] + sizes[:, None] * np.arange(self.k) // self.k
        least = np.maximum.reduceat(scores, parts.ravel()).reshape(parts.shape).min(axis=1)
        worth = scores >= np.repeat(least, sizes)
        lists, scores, ids = lists[worth], scores[worth], ids[worth]
        held = np.arange(self.k) < self.counts[touched][:, None]
        lists = np.concatenate([np.repeat(touched, self.counts[touched]), lists])
        scores = np.concatenate([self.scores[touched][held], scores])
        ids = np.concatenate([self.ids[touched][held], ids])
        order = np.lexsort((ids, -scores, lists))
        lists = lists[order]
        place = np.arange(len(lists)) - np.searchsorted(lists, lists)
        best = place < self.k
        lists, place, order = lists[best], place[best], order[best]
        self.scores[lists, place], self.ids[lists, place] = scores[order], ids[order]
        np.maximum.at(self.counts, lists, place + 1)
        full = touched[self.counts[touched] == self.k]
        self.need[full] = np.maximum(self.need[full], self.scores[full, self.k - 1])

    def batch(self, names: dict[str, np.ndarray]) -> pa.RecordBatch:
        held = np.arange(self.k) < self.counts[:, None]
        columns = {name: np.repeat(values, self.counts) for name, values in names.items()}
        columns |= {"id": self.ids[held], "score": self.scores[held]}
        return pa.RecordBatch.from_arrays(
            [pa.array(v.astype(np.int64)) for v in columns.values()], list(columns)
        )


def _same_size(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and vectors of a batch, the vectors of each dimension together."""
    ids = batch["id"].fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False)
    labels = batch["label"].to_numpy(zero_copy_only=False)
    offsets = batch["vec"].offsets.to_numpy()
    values = batch["vec"].values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield ids[at], labels[at], values[offsets[at][:, None] + np.arange(d)].reshape(len(at), d)


_LOWEST = np.iinfo(np.int64).min


def _positives(shared, k: int, bucket: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = {
            (d, label): anchors.some(np.flatnonzero(anchors.labels == label))
            for d, anchors in shared.value.items()
            for label in np.unique(anchors.labels).tolist()
        }
        best = {key: _Best(np.full(len(a.ids), _LOWEST), k) for key, a in groups.items()}
        for batch in batches:
            for ids, labels, vectors in _same_size(batch):
                for label in np.unique(labels).tolist():
                    key = (vectors.shape[1], label)
                    if key not in groups:
                        continue
                    anchors, mine = groups[key], np.flatnonzero(labels == label)
                    for start in range(0, len(mine), bucket):
                        rows = mine[start : start + bucket]
                        held = Bucket(ids[rows], labels[rows], vectors[rows])
                        for who, at, scores in scan(held, anchors, best[key].need):
                            other = held.ids[at] != anchors.ids[who]
                            if other.any():
                                best[key].add(who[other], scores[other], held.ids[at[other]])
        for key, anchors in groups.items():
            yield best[key].batch({"anchor": anchors.number})

    return run


def _negatives(shared, k: int, bucket: int):
    """shared: by dimension the anchors, and per range the anchor's index, its first and last score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        best = {d: _Best(low.copy(), k) for d, (_, _, _, low, _) in groups.items()}
        for batch in batches:
            for ids, labels, vectors in _same_size(batch):
                if vectors.shape[1] not in groups:
                    continue
                anchors, first, number, low, high = groups[vectors.shape[1]]
                found = best[vectors.shape[1]]
                for start in range(0, len(ids), bucket):
                    part = slice(start, start + bucket)
                    held = Bucket(ids[part], labels[part], vectors[part])
                    # An anchor looks for what any of its positives still needs.
                    need = np.minimum.reduceat(found.need, first[:-1])
                    for who, at, scores in scan(held, anchors, need):
                        other = held.labels[at] != anchors.labels[who]
                        who, at, scores = who[other], at[other], scores[other]
                        # The ranges of an anchor follow each other.
                        for nth in range(np.diff(first).max()):
                            has = np.flatnonzero(first[who] + nth < first[who + 1])
                            j = first[who[has]] + nth
                            fits = (scores[has] >= found.need[j]) & (scores[has] <= high[j])
                            if fits.any():
                                found.add(j[fits], scores[has[fits]], held.ids[at[has[fits]]])
        for d, (_, _, number, _, _) in groups.items():
            yield best[d].batch({"range": number})

    return run


def _vectors(table: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """id, label, vec and length of the rows that take part, longest first, each once."""
    whole = F.transform(
        F.col(vec_col).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint")
    )
    finite = F.forall(
        F.col(vec_col),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = (
        table.filter(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
        .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("vec"))
        .distinct()
    )
    return rows.withColumn("length", F.sqrt(squares))


def _block(rows: list) -> dict[int, Anchors]:
    """Anchors by dimension."""
    by_size: dict[int, list] = {}
    for number, row in enumerate(rows):
        by_size.setdefault(len(row["vec"]), []).append((number, row["id"], row["label"], row["vec"]))
    return {d: Anchors.build(*zip(*held, strict=True)) for d, held in by_size.items()}


def _ranges(anchors: dict[int, Anchors], positives: list, least: int, most: int) -> tuple[dict, list]:
    """What the second search is given, and (anchor, positive, positive score) of every range."""
    by_anchor: dict[int, list] = {}
    for row in positives:
        low, high = -(-least * row["score"] // 100), most * row["score"] // 100
        if low <= high:
            by_anchor.setdefault(row["anchor"], []).append((row["id"], row["score"], low, high))
    groups, named = {}, []
    for d, held in anchors.items():
        held = held.some(np.array([int(n) in by_anchor for n in held.number], dtype=bool))
        first, number, low, high = [0], [], [], []
        for anchor in held.number.tolist():
            for positive, score, a, b in by_anchor[anchor]:
                number.append(len(named))
                low.append(a)
                high.append(b)
                named.append((anchor, positive, score))
            first.append(len(number))
        if number:
            groups[d] = (held, np.array(first), np.array(number), np.array(low), np.array(high))
    return groups, named


def _top(found: DataFrame, by: str, k: int) -> DataFrame:
    order = W.partitionBy(by).orderBy(F.desc("score"), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    table: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    anchors: int = ANCHORS,
    bucket: int = BUCKET,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become ``floor(scale * x)`` and a score is the integer inner product with the
    anchor; higher scores come first, ties by smaller id, null ids last.  An anchor (``is_anchor``
    is a condition on ``id_col``) has as positives its first ``positives`` other rows of its
    label.  For each of them come the first ``negatives`` rows of other labels with
    ``least * positive_score <= 100 * negative_score <= most * positive_score``.

    Rows with a null label, a null vector or a null or non-finite component take no part.  Rows
    of the anchor's id are not its positives.  Repeated rows count once; rows that share an id
    but nothing else are rows of their own.  Vectors meet those of their dimension only.  Zero
    vectors score 0.  A positive without negatives in its range gives no rows, nor do empty
    tables; further columns are ignored.  Vectors so long that a score might not fit 64 bits
    raise ValueError.
    """
    spark = table.sparkSession
    prepared = _vectors(table, id_col, vec_col, label_col, scale)
    rows = shared_table(
        prepared.repartitionByRange(F.desc("length"), F.xxhash64("id")).sortWithinPartitions(F.desc("length")),
        "mined-vectors",
    )
    if (rows.agg(F.max("length")).first()[0] or 0) >= 3e9:
        raise ValueError("scores of these vectors do not fit 64 bits")
    asked = rows.withColumnRenamed("id", id_col).filter(is_anchor).withColumnRenamed(id_col, "id")
    blocks = max(1, -(-asked.count() // anchors))
    parts = []
    for block in range(blocks):
        here = asked.filter(F.pmod(F.xxhash64("id", "label", "vec"), F.lit(blocks)) == block)
        held = _block([r for r in here.select("id", "label", "vec").toLocalIterator()])
        found = rows.select("id", "label", "vec").mapInArrow(
            releasing(_positives(spark.sparkContext.broadcast(held), positives, bucket)),
            "anchor long, id long, score long",
        )
        # At most so many positives for each anchor of the block.
        best = shared_table(_top(found, "anchor", positives), "mined-positives").collect()
        groups, named = _ranges(held, best, least, most)
        found = rows.select("id", "label", "vec").mapInArrow(
            releasing(_negatives(spark.sparkContext.broadcast(groups), negatives, bucket)),
            "range long, id long, score long",
        )
        ids = {int(n): i for a in held.values() for n, i in zip(a.number, a.ids.tolist(), strict=True)}
        names = spark.createDataFrame(
            [(j, ids[a], p, score) for j, (a, p, score) in enumerate(named)],
            "range long, anchor_id long, positive_id long, positive_score long",
        )
        parts.append(shared_table(_top(found, "range", negatives).join(F.broadcast(names), "range"), "mined"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)

    def real(name: str) -> Column:
        return F.when(F.col(name) != int(_NO_ID), F.col(name))

    return out.select(
        "anchor_id",
        real("positive_id").alias("positive_id"),
        F.col("rank").cast("int"),
        real("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
