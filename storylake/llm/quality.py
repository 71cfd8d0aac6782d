"""Quality classifier on random-indexing word vectors.

Every word has a sparse random index vector, derived from its hash.  Its word vector is the sum
of the index vectors around it in the training texts (Kanerva et al., 2000; Sahlgren, 2005).
Written forms (case, punctuation, length, repetition) are a second kind of word with index
vectors of their own.  A document is the mean of its word vectors; a two-layer network turns
it into a logit, and a temperature fitted on rows kept out of training calibrates that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from storylake.llm.support import mix, releasing, text_chunks, word_hashes, word_spans

#: Rows of labels that a model is fitted on, at most; chosen by a hash of their id.
TRAINING_ROWS = 20_000

#: Word vectors are kept for so many hash buckets; with DIMENSIONS this bounds the model.
BUCKETS = 1 << 15
DIMENSIONS = 48
NONZEROS = 4
WINDOW = 2
HIDDEN = 32
FORMS = 1 << 8


def _index_vectors(n: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors: NONZEROS entries of +1 or -1 each."""
    vectors = np.zeros((n, DIMENSIONS), dtype=np.float32)
    for j in range(NONZEROS):
        bits = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(8) + np.uint64(j + 64 * seed))
        place = (bits % np.uint64(DIMENSIONS)).astype(np.int64)
        sign = np.where(bits >> np.uint64(63), 1.0, -1.0)
        vectors[np.arange(n), place] += sign.astype(np.float32)
    return vectors


_UPPER, _LOWER, _DIGIT = (np.zeros(256, dtype=np.int64) for _ in range(3))
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = 1, 1, 1
_ENDING = np.full(256, 5, dtype=np.int64)  # letters and bytes of longer characters
_ENDING[33:127] = 4
_ENDING[[ord(c) for c in "*$#%&"]] = 3
_ENDING[[ord(c) for c in "!|"]] = 2
_ENDING[[ord(c) for c in ".,;:?"]] = 1
_ENDING[48:58] = 0
_ENDING[65:91] = _ENDING[97:123] = 5


def chunk_words(data: np.ndarray, ends: np.ndarray):
    """Bucket, written form and row of every word of a chunk."""
    hashes, rows = word_hashes(data, ends)
    starts, stops = word_spans(data, ends)
    sums = [np.concatenate([[0], np.cumsum(table[data])]) for table in (_UPPER, _LOWER)]
    upper, lower = (s[stops] - s[starts] for s in sums)
    last = data[stops - 1]
    twice = (stops - starts > 1) & (data[np.maximum(stops - 2, 0)] == last) & (_ENDING[last] < 5)
    again = np.zeros(len(hashes), dtype=np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    size = np.digitize(stops - starts, (2, 4, 8))
    form = _ENDING[last] + 6 * twice + 12 * again + 24 * ((upper > 1) & (lower == 0)) + 48 * size
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), form, rows


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of index vectors around the words of a task, one row per bucket met."""
    words, forms = _index_vectors(BUCKETS, 1), _index_vectors(FORMS, 2)
    table = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float64)
    for batch in batches:
        for _, data, ends in text_chunks(batch["text"]):
            bucket, form, rows = chunk_words(data, ends)
            for step in range(1, WINDOW + 1):
                near = rows[step:] == rows[:-step]
                for here, there in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
                    at, by = bucket[here][near], words[bucket[there][near]] + forms[form[there][near]]
                    order = np.argsort(at, kind="stable")
                    if len(order):
                        first = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) > 0]))
                        table[at[order][first]] += np.add.reduceat(by[order], first, axis=0)
    met = np.flatnonzero(np.abs(table).sum(axis=1))
    flat = pa.array(table[met].reshape(-1))
    vectors = pa.ListArray.from_arrays(np.arange(len(met) + 1, dtype=np.int32) * DIMENSIONS, flat)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), vectors], ["bucket", "vector"])


def _summed(part: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for bucket, vectors in part.groupby("bucket")["vector"]:
        rows.append((bucket, np.sum(np.stack(vectors.to_list()), axis=0)))
    return pd.DataFrame(rows, columns=["bucket", "vector"])


@dataclass(frozen=True)
class QualityModel:
    words: np.ndarray  # unit word vectors by bucket
    forms: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.mean) / self.spread
        logit = np.tanh(x @ self.first + self.first_bias) @ self.second + self.second_bias
        return 1 / (1 + np.exp(-np.clip(logit / self.temperature, -40, 40)))


def pooled_rows(data, ends, words: np.ndarray, forms: np.ndarray) -> np.ndarray:
    """Mean word vector and mean form vector of each row; zeros without words."""
    bucket, form, rows = chunk_words(data, ends)
    n = len(ends) - 1
    count = np.bincount(rows, minlength=n)
    pooled = np.zeros((n, words.shape[1] + forms.shape[1]))
    full = np.flatnonzero(count)
    if len(full):
        first = np.searchsorted(rows, full)
        pooled[full, : words.shape[1]] = np.add.reduceat(words[bucket], first, axis=0)
        share = np.bincount(rows * FORMS + form, minlength=n * FORMS).reshape(n, FORMS)
        pooled[:, words.shape[1] :] = share @ forms
        pooled[full] /= count[full, None]
    return pooled


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each, as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _train(x: np.ndarray, y: np.ndarray, seed: int, epochs: int = 60):
    """Two layers by Adam on the log loss; returns the parameters."""
    random = np.random.default_rng(seed)
    shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ()]
    at = [random.normal(0, 1 / np.sqrt(s[0] if s else 1), s) if i in (0, 2) else np.zeros(s) for i, s in enumerate(shapes)]
    mean, power = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for start in range(0, len(x), 64):
            part = order[start : start + 64]
            hidden = np.tanh(x[part] @ at[0] + at[1])
            logit = np.clip(hidden @ at[2] + at[3], -40, 40)
            off = (1 / (1 + np.exp(-logit)) - y[part]) / len(part)
            back = np.outer(off, at[2]) * (1 - hidden**2)
            slopes = [
                x[part].T @ back + 1e-4 * at[0],
                back.sum(axis=0),
                hidden.T @ off + 1e-4 * at[2],
                off.sum(),
            ]
            step += 1
            for i, slope in enumerate(slopes):
                mean[i] = 0.9 * mean[i] + 0.1 * slope
                power[i] = 0.999 * power[i] + 0.001 * slope**2
                at[i] = at[i] - 0.003 * (mean[i] / (1 - 0.9**step)) / (
                    np.sqrt(power[i] / (1 - 0.999**step)) + 1e-8
                )
    return at


def _temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on rows kept out of training."""
    if not len(y):
        return 1.0
    choices = np.exp(np.linspace(-1.5, 2.5, 81))
    loss = [
        np.mean(np.logaddexp(0, -np.where(y > 0, logit, -logit) / t)) for t in choices
    ]
    return float(choices[int(np.argmin(loss))])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    training_rows: int = TRAINING_ROWS,
    seed: int = 7,
) -> QualityModel:
    """Fit on at most ``training_rows`` labelled rows (those of smallest hashed id).

    Rows of labels without id or label are left out; of several labels of an id the largest
    counts.  With no labelled row the model answers 0.5 throughout.  The word vectors and the
    pooled rows come to the driver: BUCKETS x DIMENSIONS and training_rows x 2 DIMENSIONS.
    """
    wanted = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(training_rows)
    )
    rows = docs.join(F.broadcast(wanted), docs[id_col] == wanted["_id"]).select(
        F.col("_id").alias("id"), "_label", F.col(text_col).alias("text")
    )
    partial = rows.select("text").mapInArrow(releasing(_contexts), "bucket long, vector array<double>")
    table = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float64)
    sums = partial.groupBy(F.pmod("bucket", F.lit(64)).alias("part")).applyInPandas(
        _summed, "bucket long, vector array<double>"
    )
    # As Arrow: as Python objects, the numbers would take several times their size in the driver.
    for batch in sums.toArrow().to_batches():
        table[batch["bucket"].to_numpy()] = _matrix(batch["vector"], DIMENSIONS)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    words = (table / np.maximum(length, 1e-9)).astype(np.float32)
    forms = _index_vectors(FORMS, 3) / np.sqrt(NONZEROS)
    shared = docs.sparkSession.sparkContext.broadcast((words, forms))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = shared.value
        for batch in batches:
            for row, data, ends in text_chunks(batch["text"]):
                pooled = pooled_rows(data, ends, *vectors)
                flat = pa.ListArray.from_arrays(
                    np.arange(len(pooled) + 1, dtype=np.int32) * pooled.shape[1],
                    pa.array(pooled.reshape(-1)),
                )
                part = batch.slice(row, len(pooled))
                yield pa.RecordBatch.from_arrays([part["id"], part["_label"], flat], ["id", "label", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    data = rows.mapInArrow(releasing(pool), f"id {kind}, label int, x array<double>").toArrow()
    width = words.shape[1] + forms.shape[1]
    heads = data.select(["id", "label"]).to_pandas().sort_values("id", kind="stable")
    parts = [_matrix(batch["x"], width) for batch in data.to_batches()]
    x = np.concatenate([np.zeros((0, width)), *parts])[heads.index]
    y = heads["label"].to_numpy(dtype=np.float64)
    del data, heads, parts
    mean, spread = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    x = (x - mean) / spread
    aside = np.arange(len(x)) % 5 == 4
    at = _train(x[~aside], y[~aside], seed) if len(x) else [np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0]
    logit = np.tanh(x[aside] @ at[0] + at[1]) @ at[2] + at[3]
    heat = _temperature(logit, y[aside])
    return QualityModel(words, forms, mean, spread, at[0], at[1], at[2], float(at[3]), heat)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add the calibrated probability of label 1 as column ``out``; map-only.

    Texts without words (null and empty ones too) get the score of a zero vector.  All other
    columns pass through, null ids and repeated rows as well; a column ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for texts in batches:
            scores = np.zeros(len(texts))
            for row, data, ends in text_chunks(texts):
                pooled = pooled_rows(data, ends, fitted.words, fitted.forms)
                scores[row : row + len(pooled)] = fitted.scores(pooled)
            yield pa.array(scores)

    # Only the text goes to the workers, and only the score comes back.
    task = releasing(run)
    task.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    score = F.arrow_udf(task, DoubleType()).asNondeterministic()
    return docs.drop(out).withColumn(out, score(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from: a fifth, by the CRC of their id as text."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0
