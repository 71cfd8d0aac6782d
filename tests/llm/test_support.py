"""Helpers of several operators."""

import os
import resource
from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline as P
from storylake.llm.support import local_table, releasing, shared_table
from storylake.session import BATCH_ROWS, materialize

SF_DIR = "/root/testdata/sf0.001"
KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("write", [shared_table, materialize])
def test_shared_tables_are_written_in_small_batches(spark, write):
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    before = spark.conf.get(KEY)
    table = write(spark.range(0, 5000, 1, 1).mapInArrow(rows, "n long"), "sizes")
    sizes = [r["n"] for r in table.collect()]
    assert sum(sizes) == 5000 and max(sizes) <= BATCH_ROWS
    assert spark.conf.get(KEY) == before


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")
def test_texts_are_encoded_in_small_batches(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    coded = P.encode(spark, docs, SF_DIR)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and coded.count() == docs.count()


def test_local_tables_need_no_python_on_executors(spark, capsys):
    span = pa.struct([("source", pa.string()), ("start", pa.int64())])
    types = {"pid": pa.int64(), "parts": pa.list_(span)}
    table = local_table(spark, [(1, [("a", 0), (None, 5)]), (2, [])], types)
    assert [f.simpleString() for f in table.schema] == [
        "pid:bigint",
        "parts:array<struct<source:string,start:bigint>>",
    ]
    assert {r["pid"]: [tuple(x) for x in r["parts"]] for r in table.collect()} == {1: [("a", 0), (None, 5)], 2: []}
    assert local_table(spark, [], types).count() == 0
    capsys.readouterr()
    table.explain()
    assert "ExistingRDD" not in capsys.readouterr().out


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="memory is read from /proc")
def test_a_task_gives_its_memory_back():
    def held_mb():
        return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize() >> 20

    last = []

    def run(batches):
        texts = [b"x" * (2000 + i % 2) for i in range(100_000)]
        last.append(b"x" * (2000 + len(texts) % 7))  # above the others, it keeps the heap from shrinking
        yield held_mb()

    before = held_mb()
    (most,) = releasing(run)([])
    assert most - before > 150 and held_mb() - before < 60
