"""From raw documents to token ids in five stages, each written as Parquet and read again.

Every stage works on all that its predecessor kept.  Stages take (spark, docs, sf_dir); all but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylake.llm import bpe_automaton, exact_dedup, mixing, near_join, quality
from storylake.llm.queries import BYTE_BPE, GOOD_QUALITY, cyclic_weights
from storylake.llm.support import free_name, shared_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Empty and null texts are scored like others.  The classifier learns from the labels table.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~quality.held_out())
    model = quality.fit_quality(docs, labels)
    score = free_name(docs, "_score")
    return quality.score_quality(docs, model, out=score).filter(F.col(score) >= GOOD_QUALITY).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of smallest id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five words, 0.8) the document of smallest id."""
    return near_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times."""
    return mixing.mix_documents(
        docs,
        size=mixing.word_count(F.col("text")),
        sources=F.array("source"),
        weights=cyclic_weights,
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text.

    Written here, so that the texts go to the encoder in small batches.
    """
    path = public_tokenizers.path(BYTE_BPE)
    coded = bpe_automaton.encode_and_check(docs.select("doc_id", "lang", "source", "text"), path)
    coded = coded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", "intact")
    return shared_table(coded, "encoded")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
