"""Ranked lexical search over norm buckets, in the manner of LEMP (Teflioudi and others, 2015).

A document is the vector of its impacts on the terms of the queries, a query the vector of its
term weights; a score is their inner product, all in integers.

1. One pass over the texts finds for each document its terms and, of the queries' terms, which
   ones it holds and how often.  Counts of documents and terms come from its table.
2. Impact vectors are written in order of their length, longest first.
3. The longest vectors are searched first and give each query a threshold, its k-th best score so
   far.  A vector for which ``|query| * |vector|`` is below the threshold of every query is not
   read (the length is a column that the scan prunes by); a bucket of vectors is skipped by every
   query for which its longest vector falls short.
4. Inside a bucket a query looks at as many of its heaviest coordinates as it takes for the rest
   to fall short of the threshold by Cauchy-Schwarz: only documents listed under one of them can
   reach it.  Of these, the exact part on those coordinates plus the bound of the rest decides;
   survivors are scored in full, in integers.

Queries are taken in blocks of bounded size, each against all documents; what a task returns is
at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from storylake.llm.support import releasing, shared_table, text_chunks, word_hashes

#: Queries of a block, and the characters of their texts; bounds what is broadcast.
QUERIES = 4096
QUERY_CHARS = 4_000_000

#: Documents of a norm bucket.
BUCKET = 1024

#: Share of the vectors, the longest ones, that are searched for the first thresholds.
FIRST_SHARE = 0.05

#: Widens floating-point bounds, so that rounding never excludes a document.
_SLACK = 1 + 1e-9

_IS_GAP = np.ones(256, dtype=bool)
_IS_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass(frozen=True)
class Queries:
    """Query vectors of one block as rows of (terms, weights), heaviest weight first.

    ``starts[i]:starts[i + 1]`` are the entries of query i; ``rest[j]`` is the length of what
    follows entry j in its query, entry j included.
    """

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    rest: np.ndarray

    @classmethod
    def build(cls, queries: list[np.ndarray], weight: np.ndarray) -> Queries:
        terms, weights, rest, starts = [], [], [], [0]
        for held in queries:
            held = held[weight[held] > 0]
            held = held[np.argsort(-weight[held], kind="stable")]
            w = weight[held]
            terms.append(held)
            weights.append(w)
            rest.append(np.sqrt(np.cumsum((w.astype(float) ** 2)[::-1])[::-1]))
            starts.append(starts[-1] + len(held))
        joined = [np.concatenate(x) if x else np.zeros(0) for x in (terms, weights, rest)]
        return cls(np.array(starts), joined[0].astype(np.int64), joined[1].astype(np.int64), joined[2])

    @property
    def lengths(self) -> np.ndarray:
        full = np.concatenate([self.rest, [0.0]])
        return np.where(np.diff(self.starts) > 0, full[self.starts[:-1]], 0.0)


def _text_terms(vocabulary):
    """Per row: id, number of terms, and the query terms it holds with how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for row, data, ends in text_chunks(batch["text"]):
                hashes, owner = word_hashes(data, ends, _IS_GAP)
                n_rows = len(ends) - 1
                at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                cell, tf = np.unique(owner[hit] * np.int64(len(known) or 1) + at[hit], return_counts=True)
                rows, terms = np.divmod(cell, len(known) or 1)
                offsets = pa.array(np.searchsorted(rows, np.arange(n_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(row, n_rows),
                        pa.array(np.bincount(owner, minlength=n_rows), pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32())),
                    ],
                    ["id", "n", "terms", "tfs"],
                )

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, ends in text_chunks(batch["text"]):
            hashes, owner = word_hashes(data, ends, _IS_GAP)
            n_rows = len(ends) - 1
            offsets = np.searchsorted(owner, np.arange(n_rows + 1))
            listed = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch["item_id"].slice(row, n_rows), listed], ["item_id", "hashes"]
            )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and values of a list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], values


class _Best:
    """The k best (score, id) of each query, and the score that a newcomer must reach."""

    def __init__(self, count: int, k: int, thresholds: np.ndarray):
        self.k = k
        self.need = np.maximum(thresholds, 1)
        self.scores = [np.zeros(0, np.int64)] * count
        self.ids = [np.zeros(0, np.int64)] * count

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]
        if len(order) == self.k:
            self.need[query] = max(self.need[query], int(scores[order[-1]]))


def search_bucket(
    queries: Queries, best: _Best, ids: np.ndarray, offsets: np.ndarray, terms: np.ndarray, impacts: np.ndarray
) -> None:
    """Offer the documents of one bucket to every query that they may concern."""
    if not len(terms):
        return
    rows = np.repeat(np.arange(len(ids)), np.diff(offsets))
    squares = np.bincount(rows, impacts.astype(float) ** 2, minlength=len(ids))
    longest = float(np.sqrt(squares.max())) * _SLACK
    order = np.argsort(terms, kind="stable")
    listed, by_term, value = terms[order], rows[order], impacts[order]
    first = np.searchsorted(listed, queries.terms, side="left")
    last = np.searchsorted(listed, queries.terms, side="right")
    for query in np.flatnonzero(queries.lengths * longest >= best.need).tolist():
        start, stop = queries.starts[query], queries.starts[query + 1]
        need = int(best.need[query])
        # Coordinates after these reach the threshold in no document of the bucket.
        focus = start + int(np.count_nonzero(queries.rest[start:stop] * longest >= need))
        score = np.zeros(len(ids), np.int64)
        square = np.zeros(len(ids))
        for j in range(start, focus):
            here = slice(first[j], last[j])
            score[by_term[here]] += queries.weights[j] * value[here]
            square[by_term[here]] += value[here].astype(float) ** 2
        going = np.flatnonzero(square)
        if focus < stop and len(going):
            bound = queries.rest[focus] * np.sqrt(np.maximum(squares[going] - square[going], 0)) * _SLACK
            going = going[score[going] + bound >= need]
            if len(going):
                for j in range(focus, stop):
                    here = slice(first[j], last[j])
                    score[by_term[here]] += queries.weights[j] * value[here]
        going = going[score[going] >= need]
        if len(going):
            best.add(query, score[going], ids[going])


#: Stands for a null id; it comes last among equal scores.
_NO_ID = np.int64(2**63 - 1)


def _search(shared, k: int, bucket: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, thresholds = shared.value
        best = _Best(len(queries.starts) - 1, k, thresholds)
        for batch in batches:
            ids = batch["id"].fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False)
            offsets, terms = _lists(batch["terms"])
            _, impacts = _lists(batch["impacts"])
            for row in range(0, len(ids), bucket):
                stop = min(row + bucket, len(ids))
                here = slice(offsets[row], offsets[stop])
                search_bucket(
                    queries, best, ids[row:stop], offsets[row : stop + 1] - offsets[row],
                    terms[here], impacts[here],
                )
        counts = [len(s) for s in best.scores]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(counts)), counts), pa.int32()),
                    pa.array(np.concatenate(best.ids), pa.int64()),
                    pa.array(np.concatenate(best.scores), pa.int64()),
                ],
                ["query", "id", "score"],
            )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query with their rank; a task sends at most k rows per query."""
    order = W.partitionBy("query").orderBy(F.desc("score"), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _impacts(vectors: DataFrame, documents: int, terms: int) -> DataFrame:
    """id, terms, impacts and length of the vectors; documents and terms are N and L."""
    held = vectors.filter(F.size("terms") > 0).withColumn("m", F.expr(f"50L + (50L * n * {documents}L) div {terms}L"))
    held = held.withColumn(
        "impacts",
        F.expr("transform(tfs, tf -> (1000000000L * tf) div (1000L * tf + 20L * m))"),
    )
    squares = F.aggregate("impacts", F.lit(0.0), lambda x, p: x + p.cast("double") * p.cast("double"))
    return held.select("id", "terms", "impacts", F.sqrt(squares).alias("length"))


def _block_search(spark, vectors: DataFrame, totals, asked: list[np.ndarray], vocabulary: int, k: int, bucket: int):
    """Best rows (query, id, score, rank) of one block of queries."""
    documents, terms = totals
    # One row per term of the queries.
    df = np.zeros(vocabulary, dtype=np.int64)
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for row in counted.toLocalIterator():
        df[row["term"]] = row["df"]
    weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * df + 1))).astype(np.int64)
    queries = Queries.build(asked, weight)
    ordered = shared_table(
        _impacts(vectors, documents, max(terms, 1))
        # Vectors of one length are spread as well.
        .repartitionByRange(F.desc("length"), F.xxhash64("id"))
        .sortWithinPartitions(F.desc("length")),
        "search-impacts",
    )
    schema = "query int, id long, score long"
    none = np.zeros(len(asked), dtype=np.int64)
    cut = ordered.select(F.percentile_approx("length", 1 - FIRST_SHARE, 1000).alias("cut")).first()["cut"]
    if cut is None:
        return spark.createDataFrame([], f"{schema}, rank int")
    longest = ordered.filter(F.col("length") >= cut).select("id", "terms", "impacts")
    first = longest.mapInArrow(releasing(_search(spark.sparkContext.broadcast((queries, none)), k, bucket)), schema)
    first = shared_table(_ranked(first, k), "search-first")
    thresholds = none.copy()
    for row in first.filter(F.col("rank") == k).select("query", "score").toLocalIterator():
        thresholds[row["query"]] = row["score"]
    asking = queries.lengths > 0
    # No query can reach its threshold with a shorter vector.
    least = np.min(np.maximum(thresholds, 1)[asking] / queries.lengths[asking], initial=np.inf) / _SLACK
    others = ordered.filter((F.col("length") < cut) & (F.col("length") >= float(least)))
    rest = others.select("id", "terms", "impacts").mapInArrow(
        releasing(_search(spark.sparkContext.broadcast((queries, thresholds)), k, bucket)), schema
    )
    return shared_table(_ranked(first.select("query", "id", "score").union(rest), k), "search-best")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    bucket: int = BUCKET,
    queries: int = QUERIES,
    query_chars: int = QUERY_CHARS,
) -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id, score.

    Terms are maximal runs of ASCII digits and letters and of all characters beyond ASCII, with
    A-Z lower-cased, told apart by 64-bit hashes.  With N documents that have a term, L terms in
    them, n in one of them, df documents that hold a term and tf occurrences in this one, a term
    weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))`` and scores ``(10**9 tf) div (1000 tf + 20 m)``
    for each unit, where ``m = 50 + (50 n N) div L``; a score sums over the distinct terms of the
    item.  Rows of score 0 are left out.  Equal scores go by id, a null id comes last.

    Null and empty texts have no terms: such documents and items give no rows, nor do items whose
    terms no document has.  Repeated documents each count and each get a rank.  A repeated item
    row counts once; items that share an id but not the text are ranked each on its own.  Empty
    tables give no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = shared_table(
        items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
        .filter(F.length("text") > 0)
        .distinct(),
        "search-items",
    )
    size = named.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // queries), -(-(size["chars"] or 0) // query_chars))
    item = StructField("item_id", named.schema["item_id"].dataType)
    parts = []
    for block in range(blocks):
        mine = named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        # The queries of a block; their number and size are bounded.
        found = mine.mapInArrow(
            _query_terms, StructType([item, StructField("hashes", ArrayType(LongType()))])
        )
        listed = [
            (r["item_id"], np.unique(np.array(r["hashes"], dtype=np.int64).view(np.uint64)))
            for r in found.toLocalIterator()
        ]
        known = np.unique(np.concatenate([h for _, h in listed])) if listed else np.zeros(0, np.uint64)
        asked = [np.searchsorted(known, h) for _, h in listed]
        vectors = shared_table(
            source.mapInArrow(
                releasing(_text_terms(spark.sparkContext.broadcast(known))),
                "id long, n long, terms array<int>, tfs array<int>",
            ),
            "search-vectors",
        )
        totals = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        best = _block_search(spark, vectors, totals, asked, len(known), k, bucket)
        names = spark.createDataFrame(
            [(i, name) for i, (name, _) in enumerate(listed)],
            StructType([StructField("query", IntegerType()), item]),
        )
        parts.append(best.join(F.broadcast(names), "query"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select(
        F.col("item_id").alias(item_col),
        F.col("rank").cast("int"),
        F.when(F.col("id") == int(_NO_ID), None).otherwise(F.col("id")).alias(id_col),
        "score",
    )
