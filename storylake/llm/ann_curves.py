"""Approximate nearest neighbours on shifted space-filling curves.

Each of several curves is a Hilbert ordering of a random, randomly shifted projection of the
vectors (after Liao, Lopez and Leutenegger, 2001).  Spark range-partitions every ordering into
blocks; a query looks at the blocks around its own key on every curve, and what it finds there
is merged and ranked by exact scores.

Equal vectors are one entry of the index.  Of an entry at most ``k + 1`` members can be among
the neighbours of a query, those of smallest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.llm.support import may_meet, shared_table

#: Vectors of a block; bounds the memory of a comparison.
BLOCK_VECTORS = 2048

#: Queries that are compared with a block at once.
QUERIES_AT_ONCE = 256

#: Places on curves that a task writes; they are a few numbers each.
TASK_PLACES = 100_000


@dataclass(frozen=True)
class Curves:
    """Orderings to search; cost and recall grow with ``number`` and ``window``.

    ``window`` is the share of an ordering on either side of a query that it looks at.  The
    defaults are for vectors without any structure, where near and far differ little: recall is
    then about 0.95.  Clustered vectors need far less.
    """

    number: int = 8
    dimensions: int = 8
    bits: int = 4
    window: float = 0.06
    seed: int = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer points (rows, ``bits`` bits a coordinate) along the Hilbert curve.

    Skilling's transposition (2004), for all points at once.
    """
    x = cells.astype(np.uint64).copy()
    n, d = x.shape
    level = np.uint64(1 << (bits - 1))
    while level > 1:
        below = level - np.uint64(1)
        for i in range(d):
            inverted = (x[:, i] & level) > 0
            swap = np.where(inverted, np.uint64(0), (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] ^= np.where(inverted, below, swap)
            x[:, i] ^= swap
        level >>= np.uint64(1)
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, dtype=np.uint64)
    level = np.uint64(1 << (bits - 1))
    while level > 1:
        flip ^= np.where((x[:, d - 1] & level) > 0, level - np.uint64(1), np.uint64(0))
        level >>= np.uint64(1)
    x ^= flip[:, None]
    keys = np.zeros(n, dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            keys = (keys << np.uint64(1)) | ((x[:, i] >> np.uint64(bit)) & np.uint64(1))
    return keys


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _projections(width: int, curves: Curves) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(curves.seed)
    d = min(curves.dimensions, width)
    turns = [np.linalg.qr(random.normal(size=(width, d)))[0] for _ in range(curves.number)]
    return np.stack(turns), random.uniform(-0.5, 0.5, size=(curves.number, d))


def _spread(vectors: DataFrame, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every projected coordinate, over all vectors."""
    number, width, d = turns.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((number * d, 3))
        for batch in batches:
            x = _matrix(batch["vector"], width)
            for i in range(number):
                y = x @ turns[i]
                part = slice(i * d, (i + 1) * d)
                total[part] += np.stack([np.full(d, float(len(y))), y.sum(0), (y**2).sum(0)], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(number * d)), *[pa.array(total[:, j]) for j in range(3)]],
            ["at", "n", "s", "q"],
        )

    rows = (
        vectors.select("vector")
        .mapInArrow(sums, "at long, n double, s double, q double")
        .groupBy("at")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        .orderBy("at")
        .collect()
    )
    n = np.array([max(r["n"], 1.0) for r in rows])
    mean = np.array([r["s"] for r in rows]) / n
    deviation = np.sqrt(np.maximum(np.array([r["q"] for r in rows]) / n - mean**2, 1e-12))
    return mean.reshape(number, d), deviation.reshape(number, d)


def _orderings(turns, shifts, mean, deviation, bits):
    """Curve and key of every vector, beside the other columns of its row."""
    number, width, d = turns.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["vector"], width)
            batch = batch.drop_columns(["vector"])
            for i in range(number):
                # Four deviations to either side, and the shift, fill the grid.
                y = (x @ turns[i] - mean[i]) / deviation[i] + shifts[i]
                cells = np.clip((y + 4.5) / 9, 0, 1 - 1e-9) * (1 << bits)
                keys = hilbert_keys(cells.astype(np.int64), bits).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), i, np.int32)), pa.array(keys), *batch.columns],
                    ["curve", "key", *batch.schema.names],
                )

    return run


def _nearest_columns(far: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` smallest values of every row, in order, ties to the smaller column.

    What a full stable sort would put first, but only values up to the k-th are sorted.
    """
    if k >= far.shape[1]:
        return np.argsort(far, axis=1, kind="stable")
    last = np.partition(far, k - 1, axis=1)[:, k - 1].copy()
    # Written so that NaN, which sorts last, stays in where numbers are too few.
    rows, columns = np.nonzero(~(far > last[:, None]))
    columns = columns[np.lexsort((far[rows, columns], rows))]
    first = np.searchsorted(rows, np.arange(len(far)))
    return columns[first[:, None] + np.arange(k)]


def _best_of_block(k: int):
    """The ``k`` best entries of a block for each query that visits it."""

    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query", "entry", "score"]
        if not entries.num_rows or not queries.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names)
        entries = entries.sort_by("entry")
        ids, asking = entries["entry"].to_numpy(), queries["query"].to_numpy()
        vectors = entries["vector"].combine_chunks()
        width = len(vectors.flatten()) // len(ids)
        x, q = _matrix(vectors, width), _matrix(queries["sought"].combine_chunks(), width)
        found, scores = [], []
        for start in range(0, len(q), QUERIES_AT_ONCE):
            part = q[start : start + QUERIES_AT_ONCE]
            far = part @ x.T
            near = _nearest_columns(np.negative(far, out=far), k)
            found.append(ids[near].ravel())
            # Products of matrices depend on their shapes in the last bit; these sums do not.
            scores.append((part[:, None, :] * x[near]).sum(axis=2).ravel())
        each = min(k, len(ids))
        return pa.table([np.repeat(asking, each), np.concatenate(found), np.concatenate(scores)], names)

    return run


def _members(
    sound: DataFrame, entries: DataFrame, k: int, copies: bool
) -> tuple[DataFrame, DataFrame]:
    """(entry, id) of the ``k + 1`` smallest members, and (query_id, query) of all that ask.

    The member of an entry with one id is known from the entry.  Rows are read again only for
    ``copies``, vectors under several ids.
    """
    alone = entries.filter("entry = last")
    members = alone.select("entry", F.col("entry").alias("id"))
    queries = alone.filter("asks").select(F.col("entry").alias("query_id"), F.col("entry").alias("query"))
    if not copies:
        return members, queries
    shared = entries.filter("entry < last").select("mark", "vector", "entry")
    rows = may_meet(sound, shared, "mark")
    order = W.partitionBy("mark", "vector").orderBy("id")
    least = (
        rows.select("mark", "vector", "id")
        .withColumn("place", F.dense_rank().over(order))
        .filter(F.col("place") <= k + 1)
        .distinct()
    )
    asked = rows.filter("asks").select("mark", "vector", F.col("id").alias("query_id")).distinct()
    return (
        members.union(least.join(shared, ["mark", "vector"]).select("entry", "id")),
        queries.union(
            asked.join(shared, ["mark", "vector"]).select("query_id", F.col("entry").alias("query"))
        ),
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    curves: Curves = Curves(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every query row.

    Nearest is the largest inner product in double precision, ties to the smaller id; a row is
    no neighbour of its own id.  Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do null ids and vectors of another length than most (of the
    smallest of equally frequent lengths).  A repeated row counts once.  An empty table, or one
    vector alone, gives no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Single precision is kept as it comes: half the bytes, and exact in double precision.
    single = vectors.select(vector_col).schema[0].dataType == T.ArrayType(T.FloatType())
    numbers = F.col(vector_col).cast("array<float>" if single else "array<double>")
    finite = F.forall(
        numbers, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    sound = (
        vectors.filter(F.col(id_col).isNotNull() & finite & F.exists(numbers, lambda v: v != 0))
        .select(F.col(id_col).cast("long").alias("id"), numbers.alias("vector"), is_query.alias("asks"))
        .withColumn("mark", F.xxhash64("vector"))
    )

    # Entries of the index.  Their smallest members need not tell them apart: ids may repeat.
    entries = shared_table(
        sound.groupBy("mark", "vector")
        .agg(
            F.min("id").alias("entry"),
            F.max("id").alias("last"),
            F.max(F.coalesce("asks", F.lit(False))).alias("asks"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumns({"width": F.size("vector"), "number": F.monotonically_increasing_id()}),
        "ann-entries",
    )
    lengths = entries.groupBy("width").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("n"), F.max(F.col("entry") < F.col("last")).alias("copies")
    )
    common = lengths.orderBy(F.desc("rows"), "width").first()
    if common is None:
        return empty
    width, n = common["width"], common["n"]
    entries = entries.filter(F.col("width") == width)
    members, queries = _members(sound.filter(F.size("vector") == width), entries, k, common["copies"])

    turns, shifts = _projections(width, curves)
    bits = min(curves.bits, 62 // turns.shape[2])
    mean, deviation = _spread(entries, turns)
    keyed = entries.select("number", "entry", "asks", "vector").mapInArrow(
        _orderings(turns, shifts, mean, deviation, bits),
        "curve int, key long, number long, entry long, asks boolean",
    )
    blocks = curves.number * max(1, math.ceil(n / BLOCK_VECTORS))
    placed = shared_table(
        keyed.repartitionByRange(blocks, "curve", "key", "entry")
        .select("curve", F.spark_partition_id().alias("block"), "number", "asks")
        .coalesce(1 + curves.number * n // TASK_PLACES),
        "ann-curves",
    )
    spans = placed.groupBy("curve").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    longest = spans.agg(F.max(F.col("high") - F.col("low") + 1)).first()[0]
    reach = max(1, math.ceil(curves.window * longest))
    # Vectors join the places here, and so move once for each curve.
    visits = (
        placed.filter("asks")
        .join(entries.filter("asks").select("number", "entry", "vector"), "number")
        .select(
            F.col("curve").alias("on"),
            F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("visited"),
            F.col("entry").alias("query"),
            F.col("vector").alias("sought"),
        )
    )
    found = (
        placed.join(entries.select("number", "entry", "vector"), "number")
        .select("curve", "block", "entry", "vector")
        .groupBy("curve", "block")
        .cogroup(visits.groupBy("on", "visited"))
        .applyInArrow(_best_of_block(k + 1), "query long, entry long, score double")
    )
    top = W.partitionBy("query").orderBy(F.desc("score"), "entry")
    merged = (
        found.groupBy("query", "entry")
        .agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(top))
        .filter(F.col("place") <= k + 1)
        .select("query", "entry", "score")
    )
    ranked = W.partitionBy("query").orderBy(F.desc("score"), "id")
    answers = (
        merged.join(members, "entry")
        .withColumn("place", F.row_number().over(ranked))
        .filter(F.col("place") <= k + 1)
        .select("query", "id", "score")
    )
    final = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        queries.join(answers, "query")
        .filter("id <> query_id")
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
