"""Near duplicates by an n-gram Jaccard join over token-combination prefixes.

A token is the 64-bit hash of a word shingle, a document is its set of tokens, and tokens have
one global order (that of their hashes).  With ``q(n)`` the tokens that a set of size n may
lack, linked sets share the first ``l`` tokens of their common part within prefixes of length
``q + l``.

1. The prefixes of all documents are counted.  A document of which too few prefix tokens stand
   anywhere else has no partner and goes no further.
2. Documents with one set are one class; a class goes on as its smallest member.
3. Prefix tokens of few classes (the rare class) are indexed alone.  Linked sets that share no
   rare token share enough frequent ones; sets with so many of those are indexed by
   combinations of two tokens that are neighbours in the global order, the rarest first.
4. Pairs that meet in rare tokens must share enough of them.  They and the classes that meet in
   a combination form canopies, which are compared on whole sets, block by block: no pair is a
   row unless it is a link, and of the links of two blocks only a spanning forest is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storylake.llm.support import (
    components,
    free_name,
    mix,
    releasing,
    shared_table,
    shingle_sets,
    text_chunks,
)

#: Prefix tokens of at most so many documents are rare; bounds the pairs that one row makes.
RARE_DOCUMENTS = 32

#: Documents of a canopy block.
BLOCK = 256


def _least_overlap(n, percent: int):
    """Tokens that a set of size n shares with any linked set, at least."""
    return (n * percent + 99) // 100


def _prefix(n, percent: int):
    """Tokens of its prefix that a set of size n shares with a set not smaller, and its length.

    The share is a choice: the longer a prefix, the more of it must be shared, the more
    documents drop out, and the more tokens are moved.
    """
    shared = np.maximum(1, n * 3 // 20)
    return shared, np.minimum(n, n - _least_overlap(n, percent) + shared)


def _prefix_sql(percent: int) -> tuple[str, str, str]:
    """The same over a column n, and in between the tokens shared with any linked set."""
    overlap = f"(({percent} * n + 99) div 100)"
    shared = "greatest(1, n * 3 div 20)"
    return (
        shared,
        f"greatest(1, {overlap} * 3 div 20)",
        f"least(n, n - {overlap} + {shared})",
    )


def _signatures(k: int):
    """Set size and a 128-bit signature of the set of every row."""

    def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values), dtype=np.uint64)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, ends in text_chunks(batch["text"]):
                hashes, bounds = shingle_sets(data, ends, k)
                part = batch.slice(row, len(ends) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["id"],
                        part["key"],
                        pa.array(np.diff(bounds)),
                        pa.array(summed(hashes + np.uint64(7), bounds)),
                        pa.array(summed(hashes ^ np.uint64(91), bounds)),
                    ],
                    ["id", "key", "n", "sign_a", "sign_b"],
                )

    return run


def _first_prefixes(k: int, percent: int):
    """Rows (key, token, local) of the first prefixes, combined within a batch.

    A token with several documents of the batch is known to be shared.  Its documents count it
    at once, in a row of their own (local > 0, the token stands for nothing), and it leaves as
    one row (local -1), whatever number of documents has it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_numpy(zero_copy_only=False)
            tokens, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for row, data, ends in text_chunks(batch["text"]):
                hashes, bounds = shingle_sets(data, ends, k)
                n = np.diff(bounds)
                _, length = _prefix(n, percent)
                place = np.arange(len(hashes)) - np.repeat(bounds[:-1], n)
                first = place < np.repeat(length, n)
                tokens.append(hashes[first])
                owner.append(np.repeat(np.arange(row, row + len(n)), n)[first])
            # 48 bits tell tokens apart well enough: a clash only lets a document go on.
            token = (np.concatenate(tokens) >> np.uint64(16)).view(np.int64)
            owner = np.concatenate(owner)
            values, index, count = np.unique(token, return_inverse=True, return_counts=True)
            together = count[index] > 1
            local = np.bincount(owner[together], minlength=len(keys))
            alone, many, heads = ~together, values[count > 1], np.flatnonzero(local)
            out_key = (keys[owner[alone]], np.zeros(len(many), np.int64), keys[heads])
            out_token = (token[alone], many, -1 - (keys[heads] & (2**62 - 1)))
            out_local = (np.zeros(int(alone.sum())), np.full(len(many), -1), local[heads])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out_key), pa.int64()),
                    pa.array(np.concatenate(out_token), pa.int64()),
                    pa.array(np.concatenate(out_local).astype(np.int32)),
                ],
                ["key", "token", "local"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, ends in text_chunks(batch["text"]):
                hashes, bounds = shingle_sets(data, ends, k)
                sets = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64))
                )
                part = batch.slice(row, len(ends) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["n"], sets], ["key", "n", "tokens"]
                )

    return run


def block_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` (arrays of distinct tokens).

    Tokens of one set only are dropped; the others become columns of 0/1 matrices of bounded
    width, whose products add up to all intersection sizes.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, index, count = np.unique(tokens, return_inverse=True, return_counts=True)
    useful = count[index] > 1
    owner, index = owner[useful], index[useful]
    order = np.argsort(index, kind="stable")
    owner, index = owner[order], index[order]
    if len(index):
        index = np.concatenate([[0], np.cumsum(index[1:] != index[:-1])])
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for start in range(0, int(index[-1]) + 1 if len(index) else 0, width):
        a, b = np.searchsorted(index, (start, start + width))
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[a:b], index[a:b] - start] = 1
        shared += part @ part.T
    shared = np.rint(shared).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = (100 * shared >= percent * union) & (union > 0)
    np.fill_diagonal(linked, False)
    left = np.arange(len(sets))
    while len(left):
        todo, seen = [left[0]], {int(left[0])}
        while todo:
            here = todo.pop()
            for there in np.flatnonzero(linked[here]).tolist():
                if there not in seen:
                    seen.add(there)
                    todo.append(there)
                    yield int(here), there
        left = left[~np.isin(left, list(seen))]


def _compare_blocks(percent: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # A document of a block paired with itself comes once; copies of a row count once.
        block = block.drop_duplicates("key").sort_values("key")
        keys = block["key"].to_numpy()
        links = list(block_links([np.asarray(t) for t in block["tokens"]], percent))
        return pd.DataFrame(
            {"a": [keys[i] for i, _ in links], "b": [keys[j] for _, j in links]}, dtype="int64"
        )

    return run


def _neighbours(tokens: Column) -> Column:
    """Combinations of two neighbouring tokens of an ordered array."""
    return F.zip_with(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )


def _share_combinations(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between sets that may link, from combinations of two neighbouring tokens.

    A token that one of two sets lacks parts two neighbours at most, so linked sets of sizes n
    and m with c common tokens share 3 c - n - m - 1 combinations.  Combinations are ordered by
    frequency, rare ones first, and each set indexes its first ones, of which linked sets must
    share one.  Common passages come last in that order and are indexed by sets of little else.
    """
    smallest = f"(n + ({percent} * n + 99) div 100)"
    shared = f"(({2 * percent - 100} * {smallest} + {99 + percent}) div {100 + percent} - 1)"
    combined = sets.select("key", "n", F.explode(_neighbours(F.col("tokens"))).alias("two"))
    counted = combined.groupBy("two").agg(F.count("*").alias("df")).filter("df > 1")
    indexed = (
        combined.join(counted, "two")
        .groupBy("key", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "two"))).alias("seen"))
        # Combinations of this set alone come first of all.
        .withColumn("alone", F.col("n") - 1 - F.size("seen"))
        .withColumn("first", F.greatest(F.expr(f"n - {shared} - alone"), F.lit(0)).cast("int"))
        .select("key", F.explode(F.slice("seen", F.lit(1), F.col("first"))["two"]).alias("two"))
    )
    centre = indexed.groupBy("two").agg(F.min("key").alias("centre"))
    return (
        indexed.join(centre, "two")
        .select(F.col("key").alias("a"), F.col("centre").alias("b"))
        .distinct()
    )


def link_classes(sets: DataFrame, percent: int, rare: int, block: int) -> DataFrame:
    """Edges (a, b) that connect the linked rows of ``sets`` (key, n, tokens as ordered set)."""
    common, least_common, length = (F.expr(e) for e in _prefix_sql(percent))
    prefix = sets.select(
        "key", "n", F.explode(F.slice("tokens", F.lit(1), length.cast("int"))).alias("token")
    )
    counted = prefix.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    seen = (
        prefix.join(counted, "token")
        .groupBy("key", "n")
        .agg(F.collect_list(F.struct("token", "df")).alias("seen"))
        .filter(F.size("seen") >= least_common)
    )
    rare_tokens = F.filter("seen", lambda t: t["df"] <= rare)["token"]
    seen = shared_table(
        seen.select(
            "key",
            "n",
            common.alias("common"),
            least_common.alias("least"),
            rare_tokens.alias("rare"),
            (F.size("seen") - F.size(rare_tokens)).alias("frequent"),
        ),
        "near-prefixes",
    )

    few = seen.select(
        F.explode("rare").alias("token"), "key", "n", "common", F.col("frequent").alias("more")
    )
    ours, theirs = (
        few.withColumnsRenamed({c: f"{c}_{side}" for c in ("key", "n", "common", "more")})
        for side in "ab"
    )
    pairs = (
        ours.join(theirs, "token")
        .filter("key_a < key_b")
        .filter(f"least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {percent}")
        .groupBy("key_a", "key_b")
        .agg(
            F.count("*").alias("both"),
            F.first(F.least("more_a", "more_b")).alias("more"),
            F.first(F.least("common_a", "common_b")).alias("common"),
        )
        .filter("both + more >= common")
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    )

    frequent = seen.filter("frequent >= least").select("key")
    together = _share_combinations(sets.join(frequent, "key", "left_semi"), percent)
    canopy = components(pairs.union(together))
    size = canopy.groupBy("root").agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")
    )
    placed = (
        canopy.join(size, "root")
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "root",
            F.least("mine", "theirs").alias("block_a"),
            F.greatest("mine", "theirs").alias("block_b"),
            F.col("node").alias("key"),
        )
    )
    return (
        placed.join(sets.select("key", "tokens"), "key")
        .groupBy("root", "block_a", "block_b")
        .applyInPandas(_compare_blocks(percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    rare: int = RARE_DOCUMENTS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: the id, n_shingles, component_id.

    Two rows link when ``100 * |both| >= percent * |either|`` over their sets of distinct
    lower-cased (A-Z) word ``k``-shingles; fewer words are one shingle.  component_id is the
    smallest id that links lead to, the own one included.  Rows without words have an empty set and
    link with nothing, also not with each other.  Rows with a null id link like others, but
    have no id to give: their component_id is null if no id can be reached.  Repeated rows
    each come back; an empty table gives no rows; further columns are ignored.
    """
    return _classified(docs, id_col, text_col, k, percent, rare, block).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of their component; columns unchanged.

    Rows without words stay, and so do rows with a null id that reach no id.
    """
    classified = _classified(docs, id_col, text_col, k, percent, RARE_DOCUMENTS, BLOCK)
    key = free_name(docs, "_key")
    stay = classified.filter(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("key").alias(key))
    kept = docs.withColumn(key, _row_key(id_col, text_col)).join(stay, key, "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _row_key(id_col: str, text_col: str) -> Column:
    """Repeated rows have one key, rows that differ in id or text do not."""
    return F.xxhash64(id_col, F.coalesce(text_col, F.lit("")))


def _classified(docs, id_col, text_col, k, percent, rare, block) -> DataFrame:
    """key, id, n, component_id for every row of ``docs``."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must be between 80 and 100")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        _row_key(id_col, text_col).alias("key"),
        F.col(text_col).alias("text"),
    )
    heads = shared_table(
        rows.mapInArrow(releasing(_signatures(k)), "id long, key long, n long, sign_a long, sign_b long"),
        "near-heads",
    )
    # Copies of one set count as one class, represented by one of its keys.
    sign = ["sign_a", "sign_b", "n"]
    classes = shared_table(
        heads.filter("n > 0")
        .groupBy(sign)
        .agg(F.min("id").alias("least_id"), F.min("key").alias("key")),
        "near-classes",
    )
    going = classes.join(_with_company(rows, heads, k, percent), "key", "left_semi")
    sets = shared_table(
        rows.select("key", "text")
        .join(going.select("key", "n"), "key")
        .dropDuplicates(["key"])
        .mapInArrow(releasing(_sets(k)), "key long, n long, tokens array<long>"),
        "near-sets",
    )
    edges = shared_table(link_classes(sets, percent, rare, block), "near-links")
    reached = components(edges)
    named = classes.join(reached, classes.key == reached.node, "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    roots = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    links = named.join(roots, "root").select(*sign, "component_id")
    return heads.join(links, sign, "left").select(
        "key",
        "id",
        "n",
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _with_company(rows: DataFrame, heads: DataFrame, k: int, percent: int) -> DataFrame:
    """Keys of documents that share enough first prefix tokens with any others."""
    tokens = rows.select("key", "text").mapInArrow(
        releasing(_first_prefixes(k, percent)), "key long, token long, local int"
    )
    # A token has one row for each batch at most, so no window holds a hot token's documents.
    whole = W.partitionBy("token").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heard = (
        tokens.withColumn("elsewhere", F.sum(F.when(F.col("local") == -1, 2).otherwise(1)).over(whole))
        .filter("local > 0 or (local = 0 and elsewhere > 1)")
        .groupBy("key")
        .agg(F.max("local").alias("local"), F.count_if(F.col("local") == 0).alias("shared"))
    )
    least = F.expr(_prefix_sql(percent)[1])
    return (
        heard.join(heads.select("key", "n").distinct(), "key")
        .filter((F.col("local") + F.col("shared") >= least) & (F.col("n") > 0))
        .select("key")
    )
