"""Helpers of several operators: shared tables, word hashing on whole Arrow batches, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylake.session import small_batches

#: The words of all operators here: runs of bytes other than these.
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Bytes of text hashed at once; bounds the memory of a worker, not the text.
CHUNK_BYTES = 1 << 18

#: Rows whose texts are copied out of an Arrow batch at once.
CHUNK_ROWS = 512


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage reliably: a lost executor re-reads files instead of repeating the work.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: Iterable[tuple], types: dict[str, pa.DataType]) -> DataFrame:
    """A few rows of the driver as a table.

    As Arrow they reach the JVM whole.  A list of rows would be an RDD, for which every executor
    starts a second daemon with workers of its own beside those of the other operators.
    """
    rows = list(rows)
    columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types.values())]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=list(types)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# --- components ---------------------------------------------------------------------------

#: Edges of a task that writes a round; without a limit, few edges would cost many small tasks.
TASK_EDGES = 100_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node of ``edges``; columns node, root.

    Alternates large-star and small-star (Kiveris et al., 2014), which needs a logarithmic
    number of rounds.  A hub costs a map-side combined minimum and a join that AQE may split.
    Edges with a null end are left out; an empty input gives an empty result.
    """
    table = shared_table(
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    nodes = table.select(F.explode(F.array("u", "v")).alias("node")).withColumn("root", F.col("node"))
    now = table.filter("u <> v")
    count = now.count()
    if not count:
        return nodes.distinct()
    before = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Not made distinct: it has no more rows than edges, and what follows is.
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        now = shared_table(small.coalesce(1 + count // TASK_EDGES), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == before:
            break
        before, count = state, state[0]
    reached = nodes.union(now.select("u", "v"))
    return reached.groupBy("node").agg(F.min("root").alias("root"))


# --- rows that may meet -------------------------------------------------------------------

#: Bits of the bitmap for each key, and of the largest bitmap (32 MB).
KEY_BITS = 32
MOST_BITS = 1 << 28


def may_meet(rows: DataFrame, wanted: DataFrame, col: str) -> DataFrame:
    """All rows of ``rows`` whose ``col`` occurs in ``wanted``, and few others.

    A bitmap of hashed keys goes to every task, so that a join that follows moves few rows in
    vain.  Its size follows ``wanted``, a table already written, up to MOST_BITS; beyond that
    more rows pass, and none is lost.  Rows with a null ``col`` are left out.
    """
    bits = 1 << 15
    keys = wanted.filter(F.col(col).isNotNull()).select(F.xxhash64(col).alias("_hash"))
    least = min(MOST_BITS, KEY_BITS * keys.count())
    while bits < least:
        bits *= 2
    place, part = free_name(rows, "_place"), free_name(rows, "_part")
    maps = (
        keys.select(F.pmod("_hash", F.lit(bits)).alias(place))
        .groupBy(F.bitmap_bucket_number(place).alias(part))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    )
    at = F.bitmap_bit_position(F.pmod(F.xxhash64(col), F.lit(bits)))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    here = F.bitmap_bucket_number(F.pmod(F.xxhash64(col), F.lit(bits)))
    found = rows.filter(F.col(col).isNotNull()).withColumn(part, here).join(F.broadcast(maps), part)
    found = found.filter(F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns])


# --- hashing words ------------------------------------------------------------------------

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_IS_GAP = np.zeros(256, dtype=bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive rows with about CHUNK_BYTES of text."""
    for start in range(0, len(column), CHUNK_ROWS):
        part = column.slice(start, CHUNK_ROWS).fill_null("")
        part = part.cast(pa.large_string()).cast(pa.large_binary())
        n = len(part)
        _, offsets, data = part.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[part.offset : part.offset + n + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < n:
            stop = int(np.searchsorted(ends, ends[row] + CHUNK_BYTES, side="right")) - 1
            stop = min(n, max(stop, row + 1))
            yield start + row, raw[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
            row = stop


def releasing(run):
    """``run`` over the batches of a task, giving memory back to the machine at its end.

    Python workers outlive their task and stand idle beside later stages.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
            if trim is not None:
                trim(0)

    return task


def word_spans(data: np.ndarray, ends: np.ndarray, gaps: np.ndarray = _IS_GAP):
    """First byte and end of every word of a chunk; words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = gaps[data]
    first = ~gap
    first[1:] &= gap[:-1]
    inner = ends[1:-1]
    inner = inner[inner < len(data)]
    first[inner] = ~gap[inner]
    last = ~gap
    last[:-1] &= gap[1:]
    inner = inner[inner > 0]
    last[inner - 1] = ~gap[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, ends: np.ndarray, gaps: np.ndarray = _IS_GAP):
    """64-bit hash (A-Z as a-z) and row of every word of a chunk, in order."""
    starts, stops = word_spans(data, ends, gaps)
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[_LOWER[data]] * up[: len(data)], out=total[1:])
    hashes = mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    return hashes, np.searchsorted(ends, starts, side="right") - 1


def shingle_sets(data: np.ndarray, ends: np.ndarray, k: int):
    """Distinct word ``k``-shingles of each row as (sorted hashes, row bounds).

    A row with fewer than ``k`` words has its whole sequence as one shingle, one without
    words has none.
    """
    words, rows = word_hashes(data, ends)
    n_rows = len(ends) - 1
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    counts = np.diff(bounds)
    weights = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    found, owner = [], []
    if len(words) >= k:
        full = np.zeros(len(words) - k + 1, dtype=np.uint64)
        for j in range(k):
            full += words[j : len(words) - k + 1 + j] * weights[j]
        whole = rows[: len(words) - k + 1] == rows[k - 1 :]
        found.append(mix(full[whole]))
        owner.append(rows[: len(words) - k + 1][whole])
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        value = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            value[has] += words[bounds[short[has]] + j] * weights[j]
        found.append(mix(value + counts[short].astype(np.uint64)))
        owner.append(short)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    hashes, owner = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[keep], owner[keep]
    return hashes, np.searchsorted(owner, np.arange(n_rows + 1))
