"""Session settings and the one place that decides where intermediate data may be written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are designed for.  AQE re-plans joins from measured sizes and
#: splits skewed join partitions; UTC keeps dates identical on every machine.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A speculative copy of a task would repeat paid model calls.
    "spark.speculation": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


#: Rows of an Arrow batch between Spark and Python while a table is written to the shared folder.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile moves at most BATCH_ROWS rows at once to Python and back.

    A batch of whole texts is held several times, in the executor's memory outside its heap and
    in the worker; the session's 10 000 rows take some hundred MB.  Results do not depend on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keep_batches_small(spark: SparkSession) -> None:
    """From now on Python gets at most BATCH_ROWS rows of this session at once.

    For tables that are not written here: Spark reads the setting when the caller runs them, so
    it has to stay.  A smaller value of the session is kept.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one in the warehouse.

    Both are paths of a Hadoop file system; nothing is written past it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = spark.sparkContext.getCheckpointDir()
    return configured or active or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; a run id replaces probing for free names."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later consumers never run it again, also when an executor is lost.  For
    narrow rows, and for results of model calls, which must not be repeated.  The files stay
    until the owner of the folder clears it.
    """
    path = new_output_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
