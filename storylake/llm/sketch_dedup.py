"""Near duplicates by fast similarity sketching, banding and exact verification.

A document is its set of distinct word shingles, as 64-bit hashes.  A sketch of ``t`` coordinates
is filled in rounds (Dahlgaard, Knudsen and Thorup, 2017): in round i < t every shingle is placed
in a bin by the i-th hash, in round i >= t in bin i - t, and a bin keeps the least (round, value).
A set stops when no bin is empty, at the latest after round 2t, so that every coordinate of every
non-empty set is filled; two sets agree in a coordinate with the probability of their Jaccard
similarity, and the agreeing share is as concentrated as with independent hashes.

1. One pass over the texts gives each row the size, a 128-bit signature and the bands of its set.
   Rows with one set are one class, told by its signature; only classes go on, by number.
2. Classes that agree in all coordinates of a band share a bucket.  The number of bands is set for
   a miss of at most ``miss`` at the threshold.  Buckets that overlap form canopies.
3. Canopies are compared on whole sets, in blocks; a canopy of several blocks is dealt into
   blocks twice, independently, so this part is linear in the classes.
4. What one block could not see is settled bucket by bucket: a bucket whose classes are one
   component needs nothing more; in the others the classes outside the bucket's largest
   component meet the classes of other components, pair by pair.  Shingles counted by bins bound
   what two sets can share; only pairs that this leaves are compared on whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylake.llm.near_join import block_links
from storylake.llm.support import (
    components,
    free_name,
    may_meet,
    mix,
    releasing,
    shared_table,
    shingle_sets,
    text_chunks,
)

#: Coordinates of a band.
BAND_ROWS = 8

#: Chance that a pair at the threshold shares no bucket.
MISS = 1e-6

#: Classes of a canopy block, and the shingles it may hold on average.
BLOCK = 256
BLOCK_TOKENS = 2_000_000

#: Bins in which the shingles of a set are counted, up to 255 each.
BINS = 256

#: Hash values computed at once while a sketch is filled.
_AT_ONCE = 1 << 16

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 40) - 1)


def bands_for(percent: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands of ``rows`` coordinates in which sets at the threshold all differ with chance ``miss``."""
    agree = (percent / 100) ** rows
    return 1 if agree >= 1 else math.ceil(math.log(miss) / math.log1p(-agree))


def fast_sketch(hashes: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """Sketches (rows x t) of the sets ``hashes[bounds[i]:bounds[i + 1]]``; empty sets stay empty.

    Several rounds are computed at once when few shingles are left; a later round never replaces
    a value of an earlier one, so the result does not depend on it.
    """
    sketch = np.full((len(bounds) - 1, t), _EMPTY, dtype=np.uint64)
    flat = sketch.reshape(-1)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    seeds = mix(np.arange(1, 2 * t + 1, dtype=np.uint64))
    done = 0
    while len(hashes) and done < 2 * t:
        now = np.arange(done, done + max(1, min(2 * t - done, _AT_ONCE // len(hashes))))
        placed = mix(hashes[None, :] ^ seeds[now][:, None])
        bins = ((placed >> np.uint64(40)) * np.uint64(t)) >> np.uint64(24)
        bins[now >= t] = (now[now >= t] - t).astype(np.uint64)[:, None]
        value = (now.astype(np.uint64)[:, None] << np.uint64(40)) | (placed & _LOW)
        np.minimum.at(flat, (rows * t + bins.astype(np.int64)).ravel(), value.ravel())
        done = int(now[-1]) + 1
        left = np.flatnonzero((sketch == _EMPTY).any(axis=1))
        unfilled = np.zeros(len(sketch), dtype=bool)
        unfilled[left] = True
        keep = unfilled[rows]
        hashes, rows = hashes[keep], rows[keep]
    return sketch


def band_hashes(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash per row and band."""
    parts = sketch.reshape(len(sketch), bands, -1)
    found = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for j in range(parts.shape[2]):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return found


def _signs(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """128-bit signature of every set."""
    both = np.empty((len(bounds) - 1, 2), dtype=np.uint64)
    for i, salted in enumerate((hashes + np.uint64(0x51ED), hashes ^ np.uint64(0xA5A5_0F0F))):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(salted), dtype=np.uint64)])
        both[:, i] = mix((sums[bounds[1:]] - sums[bounds[:-1]]) + np.diff(bounds).astype(np.uint64))
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(both), [None, pa.py_buffer(both)])
    return fixed.cast(pa.binary())


def _heads(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, ends in text_chunks(batch["text"]):
                hashes, bounds = shingle_sets(data, ends, k)
                n = np.diff(bounds)
                found = band_hashes(fast_sketch(hashes, bounds, bands * rows), bands)
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))])
                listed = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(found[n > 0].reshape(-1).view(np.int64))
                )
                part = batch.slice(row, len(n))
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["place"], pa.array(n), _signs(hashes, bounds), listed],
                    ["id", "place", "n", "sign", "bands"],
                )

    return run


def bin_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shingles of each set by bin (rows x BINS); counts stop at 255."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = owner * BINS + (hashes % np.uint64(BINS)).astype(np.int64)
    counts = np.bincount(places, minlength=(len(bounds) - 1) * BINS).reshape(-1, BINS)
    return np.minimum(counts, 255).astype(np.uint8)


def most_shared(bins_a, bins_b, n_a, n_b) -> np.ndarray:
    """Shingles that the sets of each pair can share, at most.

    Bins differ by no more shingles than the sets do, also where counts stop.
    """
    apart = np.abs(bins_a.astype(np.int16) - bins_b.astype(np.int16)).sum(axis=1, dtype=np.int64)
    return (n_a + n_b - apart) // 2


def _rows_of(column: pa.Array) -> np.ndarray:
    """Binary values of BINS bytes each, as rows."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, BINS)


def _may_link(percent: int):
    """Pairs whose sets can share enough, by their bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            both = most_shared(_rows_of(batch["bins_a"]), _rows_of(batch["bins_b"]), n_a, n_b)
            may = pa.array(100 * both >= percent * (n_a + n_b - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(may)

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, ends in text_chunks(batch["text"]):
                hashes, bounds = shingle_sets(data, ends, k)
                sets = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64))
                )
                bins = pa.array([b.tobytes() for b in bin_counts(hashes, bounds)], pa.binary())
                part = batch.slice(row, len(ends) - 1)
                found = pa.RecordBatch.from_arrays(
                    [part["key"], part["root"], part["blocks"], pa.array(np.diff(bounds)), bins, sets],
                    ["key", "root", "blocks", "n", "bins", "tokens"],
                )
                yield found.filter(pc.equal(part["sign"], _signs(hashes, bounds)))

    return run


def _compare_blocks(percent: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # Texts that clash in place and agree in their set give one key twice.
        block = block.drop_duplicates("key").sort_values("key")
        keys = block["key"].to_numpy()
        links = list(block_links([np.asarray(t) for t in block["tokens"]], percent))
        return pd.DataFrame(
            {"a": [keys[i] for i, _ in links], "b": [keys[j] for _, j in links]}, dtype="int64"
        )

    return run


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, key, n) of the buckets with several classes."""
    dealt = classes.select(F.explode("bands").alias("band"), "key", "n")
    several = dealt.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    # Shuffled at every size: the buckets grow with the table.
    return shared_table(dealt.join(several.select("band").hint("merge"), "band"), "sketch-buckets")


def _blocks(canopies: DataFrame, block: int) -> DataFrame:
    """The canopies with the number of blocks that each is compared in."""
    size = canopies.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("n") / F.lit(BLOCK_TOKENS)))
        .cast("int")
        .alias("blocks")
    )
    return canopies.join(size, "root")


def _dealt(sets: DataFrame) -> DataFrame:
    """Sets with their pass and block; those of a canopy of several blocks come twice."""
    return sets.withColumn(
        "pass", F.explode(F.expr("if(blocks > 1, array(0, 1), array(0))"))
    ).withColumn("block", F.pmod(F.xxhash64("key", "pass"), F.col("blocks")).cast("int"))


def _across_blocks(buckets: DataFrame, sets: DataFrame, reached: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one bucket that are not of one component yet."""
    whole = reached.select(F.col("node").alias("key"), F.col("root").alias("comp"))
    inside = buckets.join(whole, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    shares = inside.groupBy("band", "comp").agg(F.count("*").alias("members"))
    mixed = shared_table(
        shares.groupBy("band")
        .agg(F.count("*").alias("comps"), F.max_by("comp", F.struct("members", "comp")).alias("major"))
        .filter("comps > 1")
        .select("band", "major"),
        "sketch-majors",
    )
    inside = shared_table(inside.join(mixed, "band"), "sketch-mixed")
    minor, other = (
        part.select("band", *[F.col(c).alias(f"{c}_{s}") for c in ("key", "n", "comp")])
        for s, part in (("x", inside.filter("comp <> major")), ("y", inside))
    )
    pairs = (
        minor.join(other, "band")
        .filter("comp_x <> comp_y")
        .filter(f"100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y)")
        .select(F.least("key_x", "key_y").alias("a"), F.greatest("key_x", "key_y").alias("b"))
        .distinct()
    )
    large = sets.filter("blocks > 1")
    ours, theirs = (
        large.select(F.col("key").alias(s), F.col("bins").alias(f"bins_{s}"), F.col("n").alias(f"n_{s}"))
        for s in "ab"
    )
    pairs = shared_table(
        pairs.join(ours, "a").join(theirs, "b").mapInArrow(releasing(_may_link(percent)), "a long, b long"),
        "sketch-pairs",
    )
    few = may_meet(large.select("key", "n", "tokens"), pairs.select(F.explode(F.array("a", "b")).alias("key")), "key")
    ours, theirs = (
        few.select(F.col("key").alias(s), F.col("tokens").alias(f"set_{s}"), F.col("n").alias(f"n_{s}"))
        for s in "ab"
    )
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return (
        pairs.join(ours, "a")
        .join(theirs, "b")
        .filter(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both))
        .select("a", "b")
    )


def _linked(docs: DataFrame, classes: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """(key, root) of all classes: of linked ones the same root."""
    buckets = _buckets(classes)
    # Written first, so that the join can split a bucket of many classes.
    least = shared_table(buckets.groupBy("band").agg(F.min("key").alias("b")), "sketch-least")
    stars = buckets.join(least, "band").select(F.col("key").alias("a"), "b").distinct()
    canopies = components(stars).join(
        classes.select(F.col("key").alias("node"), "n", "place", "sign"), "node"
    ).withColumnRenamed("node", "key")
    canopies = shared_table(_blocks(canopies, block), "sketch-canopies")
    # Rows may clash in their place; only a set of the asked signature is taken.
    asked = canopies.select("place", "key", "sign", "root", "blocks")
    sets = shared_table(
        may_meet(docs.select("place", "text"), asked, "place")
        .join(asked.hint("merge"), "place")
        .withColumn("digest", F.md5("text"))
        .dropDuplicates(["place", "key", "digest"])
        .select("key", "root", "blocks", "sign", "text")
        .mapInArrow(
            releasing(_sets(k)),
            "key long, root long, blocks int, n long, bins binary, tokens array<long>",
        ),
        "sketch-sets",
    )
    edges = shared_table(
        _dealt(sets.select("root", "key", "blocks", "tokens"))
        .groupBy("root", "pass", "block")
        .applyInPandas(_compare_blocks(percent), "a long, b long"),
        "sketch-links",
    )
    reached = shared_table(components(edges), "sketch-reached")
    whole = classes.select("key").join(reached, F.col("key") == F.col("node"), "left")
    whole = whole.select("key", F.coalesce("root", "key").alias("root"))
    large = canopies.filter("blocks > 1").select("key")
    if large.isEmpty():
        return whole
    open_buckets = buckets.join(large, "key", "left_semi")
    more = shared_table(_across_blocks(open_buckets, sets, reached, percent), "sketch-more")
    if more.isEmpty():
        return whole
    # Few links join components that are known.
    for end in "ab":
        named = reached.select(F.col("node").alias(end), F.col("root").alias("known"))
        more = more.join(named, end, "left").withColumn(end, F.coalesce("known", end)).drop("known")
    joined = components(more).select(F.col("node").alias("root"), F.col("root").alias("least"))
    return whole.join(joined, "root", "left").select("key", F.coalesce("least", "root").alias("root"))


def _classified(docs, id_col, text_col, k, percent, rows, miss, block) -> DataFrame:
    """id, place, n, component_id of every row."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    id_type = docs.schema[id_col].dataType.simpleString()
    if id_type not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{id_col} must hold whole numbers, not {id_type}")
    bands = bands_for(percent, rows, miss)
    source = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(id_col, F.coalesce(text_col, F.lit(""))).alias("place"),
        F.col(text_col).alias("text"),
    )
    heads = shared_table(
        source.mapInArrow(
            releasing(_heads(k, bands, rows)),
            "id long, place long, n long, sign binary, bands array<long>",
        ),
        "sketch-heads",
    )
    # Numbers of classes are short, unique, and fixed by being written.
    classes = shared_table(
        heads.filter("n > 0")
        .groupBy("sign")
        .agg(
            F.min("id").alias("least_id"),
            F.min("place").alias("place"),
            F.min("n").alias("n"),
            F.first("bands").alias("bands"),
        )
        .withColumn("key", F.monotonically_increasing_id()),
        "sketch-classes",
    )
    named = classes.select("key", "sign", "least_id").join(
        _linked(source, classes, k, percent, block), "key"
    )
    roots = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    links = named.join(roots, "root").select("sign", "component_id")
    return heads.select("id", "place", "n", "sign").join(links, "sign", "left").select(
        "id", "place", "n",
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    rows: int = BAND_ROWS,
    miss: float = MISS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: the id, n_shingles, component_id, kept.

    Two rows link when ``100 * |both| >= percent * |either|`` over their sets of distinct
    lower-cased (A-Z) word ``k``-shingles; fewer words are one shingle.  component_id is the
    smallest id that links lead to, the own one included, and kept tells whether it is the own
    one.  Rows without words (null and empty texts too) have an empty set and link with nothing.
    Rows with a null id link like others but have no id to give: their component_id is null if
    no id can be reached, and they are kept then.  Repeated rows each come back.  An empty table
    gives no rows; further columns are ignored.  Every link is confirmed on whole sets; a pair at
    the threshold is missed with chance ``miss``, a closer one more rarely.
    """
    found = _classified(docs, id_col, text_col, k, percent, rows, miss, block)
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """Rows of ``docs`` that are kept, columns unchanged; several rows of one kept id all stay."""
    found = _classified(docs, id_col, text_col, k, percent, BAND_ROWS, MISS, BLOCK)
    place, own = free_name(docs, "_place"), free_name(docs, "_own")
    stay = found.filter(F.col("id").eqNullSafe(F.col("component_id"))).select(
        F.col("place").alias(place), F.col("id").alias(own)
    )
    marked = docs.withColumns(
        {place: F.xxhash64(id_col, F.coalesce(text_col, F.lit(""))), own: F.col(id_col).cast("long")}
    )
    same = (marked[place] == stay[place]) & marked[own].eqNullSafe(stay[own])
    return marked.join(stay.distinct(), same, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
