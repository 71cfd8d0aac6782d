import os
import sys

import pytest
from pyspark.sql import SparkSession

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(TESTS))
# Python workers import the scorers that tests define.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(TESTS), TESTS, os.environ.get("PYTHONPATH", "")]
)

from storylake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "8g")
    )
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def stories(spark):
    """Small article table from (title, text, media_name, day, language) tuples."""

    def make(*rows):
        data = []
        for seq, row in enumerate(rows):
            row = {"title": None, "text": None, "media_name": "m", "day": 1, "language": "en"} | row
            date = None if row["day"] is None else f"2024-01-{row['day']:02d}"
            url = row.get("url", f"http://m.example.org/{seq}")
            data.append(
                (seq, f"s{seq}", row["title"], row["text"], url, row["media_name"], row["language"], date)
            )
        frame = spark.createDataFrame(
            data,
            "ingest_seq long, id string, title string, text string, url string, "
            "media_name string, language string, publish_date string",
        )
        return frame.withColumn("publish_date", frame.publish_date.cast("date"))

    return make
