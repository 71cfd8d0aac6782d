"""Running row functions and models over a table, batch by batch in Arrow.

A scorer is a callable that maps a pandas frame of the input columns to a frame of the
output columns.  It is built by a factory once per Python worker, so models load once.
It reports failed rows in an ``error`` column.  It may also raise: the batch is then halved
until the failing rows are alone, which repeats calls, so scorers that are paid per call
should report instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylake.schema import ROW_KEY, require_columns
from storylake.session import keep_batches_small, materialize

Scorer = Callable[[pd.DataFrame], pd.DataFrame]
ScorerFactory = Callable[[], Scorer]

USAGE_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens")
USAGE_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in USAGE_FIELDS])
SUCCESS, FAILURE = "success", "failure"
#: Column in which a scorer reports the failure of single rows.
ERROR_FIELD = "error"


def add_column(
    df: DataFrame,
    func: Callable,
    input_cols: Sequence[str],
    output_col: str,
    return_type: str | T.DataType | None = None,
) -> DataFrame:
    """Add one column computed from others.

    Without ``return_type`` the function receives and returns Spark columns and stays in
    the JVM; with it, the function receives and returns pandas Series.
    """
    require_columns(df, *input_cols)
    columns = [F.col(name) for name in input_cols]
    if return_type is None:
        return df.withColumn(output_col, func(*columns))

    def run(*series: pd.Series) -> pd.Series:
        return func(*series)

    run.__annotations__ = {"series": pd.Series, "return": pd.Series}
    vectorized = F.pandas_udf(run, return_type)
    return df.withColumn(output_col, vectorized(*columns))


def _checked(result: pd.DataFrame, names: Sequence[str], rows: int) -> pd.DataFrame:
    missing = [name for name in names if name not in result.columns]
    if missing:
        raise ValueError(f"function result lacks the columns {missing}")
    if len(result) != rows:
        raise ValueError(f"function returned {len(result)} rows for {rows} input rows")
    return result.reset_index(drop=True)


def add_columns(
    df: DataFrame, scorer: Scorer, input_cols: Sequence[str], output_type: T.StructType
) -> DataFrame:
    """Add several columns from one call; a result without one of them is an error."""
    require_columns(df, *input_cols)
    names = output_type.names
    inputs = list(input_cols)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return _checked(scorer(frame.set_axis(inputs, axis=1)), names, len(frame))[names]

    run.__annotations__ = {"frame": pd.DataFrame, "return": pd.DataFrame}
    call = F.pandas_udf(run, output_type).asNondeterministic()
    added = df.withColumn("_added", call(F.struct(*input_cols)))
    kept = [name for name in df.columns if name not in names]
    return added.select(*kept, *[F.col(f"_added.{name}").alias(name) for name in names])


def _call(scorer: Scorer, frame: pd.DataFrame, names: Sequence[str]) -> tuple:
    """Results and errors per row.  A batch that raises is halved until the culprit is alone."""
    if frame.empty:
        return [], []
    try:
        result = _checked(scorer(frame), names, len(frame))
    except Exception as failure:  # noqa: BLE001 - any scorer error becomes a row error
        if len(frame) == 1:
            return [None], [f"{type(failure).__name__}: {failure}"]
        half = len(frame) // 2
        parts = [frame.iloc[:half], frame.iloc[half:]]
        calls = [_call(scorer, part.reset_index(drop=True), names) for part in parts]
        return calls[0][0] + calls[1][0], calls[0][1] + calls[1][1]
    rows = result.to_dict("records")
    errors = [_plain(row.get(ERROR_FIELD)) for row in rows]
    errors = [None if error is None else str(error) for error in errors]
    return [row if error is None else None for row, error in zip(rows, errors, strict=True)], errors


def outcome_type(output: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("status", T.StringType()),
            T.StructField("output", output),
            T.StructField("error", T.StringType()),
            T.StructField("usage", USAGE_TYPE),
        ]
    )


def _plain(value):
    """Missing scalars as None, so that they become SQL nulls."""
    if isinstance(value, (list, dict)) or value is None:
        return value
    return None if pd.isna(value) else value


def model_outcomes(
    df: DataFrame,
    factory: ScorerFactory,
    input_cols: Sequence[str],
    output_type: T.StructType,
    many: bool = False,
    reuse: bool = True,
    skip_blank: str | None = None,
) -> DataFrame:
    """Add ``outcome struct<status, output, error, usage>``: one outcome per input row.

    With ``many=True`` the scorer returns a frame with one column ``items`` of dict lists and
    ``output`` is an array of structs.  Scorers may also return token usage columns.  With
    ``reuse`` the article keys and outcomes, and nothing else, are written to the shared
    folder, so results derived from them (rows, errors, cost) never call the model again, also
    after the loss of an executor.  Rows whose
    ``skip_blank`` column is blank are not sent to the scorer and have a null outcome.
    Without ``reuse`` the session keeps to small batches from then on, as the caller runs the model.
    """
    require_columns(df, *input_cols)
    inputs = list(input_cols)
    names = ["items"] if many else output_type.names
    fields = output_type.names
    result = outcome_type(T.ArrayType(output_type) if many else output_type)

    def shape(row: dict | None, error: str | None) -> dict:
        if row is None:
            return {"status": FAILURE, "output": None, "error": error, "usage": None}
        if many:
            output = [{f: _plain(item.get(f)) for f in fields} for item in row["items"]]
        else:
            output = {f: _plain(row[f]) for f in fields}
        usage = {f: _plain(row.get(f)) for f in USAGE_FIELDS}
        usage = None if all(value is None for value in usage.values()) else usage
        return {"status": SUCCESS, "output": output, "error": None, "usage": usage}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        for frame in frames:
            frame = frame.set_axis([*inputs, "_skip"], axis=1)
            wanted = ~frame["_skip"].astype(bool)
            rows, errors = _call(scorer, frame.loc[wanted, inputs].reset_index(drop=True), names)
            shaped = iter([shape(row, error) for row, error in zip(rows, errors, strict=True)])
            none = dict.fromkeys(result.names)
            outcomes = [next(shaped) if want else none for want in wanted]
            yield pd.DataFrame(outcomes, columns=result.names, dtype=object)

    run.__annotations__ = {
        "frames": Iterator[pd.DataFrame],
        "return": Iterator[pd.DataFrame],
    }
    # Marked non-deterministic so that no rewrite evaluates a paid call twice.
    call = F.pandas_udf(run, result).asNondeterministic()
    if skip_blank is None:
        skip = F.lit(False)
    else:
        skip = F.coalesce(F.trim(F.col(skip_blank)) == "", F.lit(True))
    arguments = [F.col(name).alias(f"c{i}") for i, name in enumerate(inputs)]
    outcome = call(F.struct(*arguments, skip.alias("skip")))
    if not reuse:
        keep_batches_small(df.sparkSession)
        return df.withColumn("outcome", outcome)
    require_columns(df, ROW_KEY)
    written = materialize(df.select(ROW_KEY, outcome.alias("outcome")), "outcomes")
    kept = [name for name in df.columns if name != "outcome"]
    return df.select(*kept).join(written, ROW_KEY)


def _without(df: DataFrame, *names: str) -> list[str]:
    return [name for name in df.columns if name not in names]


def outcome_rows(
    outcomes: DataFrame, fields: Sequence[str], error_col: str | None = "llm_error"
) -> DataFrame:
    """1:1 result: input columns, output fields and the error; failed rows stay, with nulls."""
    kept = _without(outcomes, "outcome", *fields, error_col or "")
    columns: list[Column] = [F.col(name) for name in kept]
    columns += [F.col(f"outcome.output.{name}").alias(name) for name in fields]
    if error_col is not None:
        columns.append(F.col("outcome.error").alias(error_col))
    return outcomes.select(*columns)


def outcome_items(
    outcomes: DataFrame, fields: Sequence[str], error_col: str | None = "llm_error"
) -> DataFrame:
    """1:n result: each item on a copy of its input row; failed and empty rows give none."""
    kept = _without(outcomes, "outcome", *fields, error_col or "")
    rows = outcomes.select(*kept, F.explode("outcome.output").alias("_item"))
    columns: list[Column] = [F.col(name) for name in kept]
    columns += [F.col(f"_item.{name}").alias(name) for name in fields]
    if error_col is not None:
        columns.append(F.lit(None).cast("string").alias(error_col))
    return rows.select(*columns)


def outcome_table(outcomes: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row per input row with status, error and token usage."""
    return outcomes.select(
        *keys,
        F.col("outcome.status").alias("status"),
        F.col("outcome.error").alias("error"),
        *[F.col(f"outcome.usage.{name}").alias(name) for name in USAGE_FIELDS],
    )


def outcome_usage(outcomes: DataFrame) -> DataFrame:
    """The ``usage`` column that cost totals read; failed calls have none."""
    return outcomes.select(
        F.when(F.col("outcome.status") == SUCCESS, F.col("outcome.usage")).alias("usage")
    )


def model_map_one(
    df: DataFrame,
    factory: ScorerFactory,
    input_cols: Sequence[str],
    output_type: T.StructType,
    error_col: str | None = "llm_error",
) -> DataFrame:
    """Run a scorer 1:1 when only its rows are wanted."""
    scored = model_outcomes(df, factory, input_cols, output_type, reuse=False)
    return outcome_rows(scored, output_type.names, error_col)


def model_map_many(
    df: DataFrame,
    factory: ScorerFactory,
    input_cols: Sequence[str],
    output_type: T.StructType,
    error_col: str | None = "llm_error",
) -> DataFrame:
    """Run a scorer 1:n when only its items are wanted."""
    scored = model_outcomes(df, factory, input_cols, output_type, many=True, reuse=False)
    return outcome_items(scored, output_type.names, error_col)
