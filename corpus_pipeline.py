"""A corpus pipeline: documents to a sharded training mixture.

Each stage works on all rows that its predecessor kept, and each is written
as Parquet and read again as the next one's ``docs``:

1. toxicity: documents that the nnPU classifier scores 0.7 or more go;
2. near duplicates: of each group of documents whose five-word shingle sets
   have a similarity of 0.8 or more, the one with the smallest id stays;
3. decontamination: documents that hold a benchmark item, with up to a tenth
   of its words edited, go;
4. mixing: sources are repeated or thinned to their target weights (a
   document may appear twice or not at all);
5. sharding: every row of the mixture is assigned to one of 24 shards and a
   slot there, each shard holding the same proportions of sources.

The first four return the columns of ``documents``; the last returns the
assignment: those columns without the text, which stays in the fourth table
under the same ``doc_id``, and ``size, text_crc32, law, shard, slot``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.adapter import table
from sparkmart.llm.decontaminate import decontaminate
from sparkmart.llm.mixing import mix
from sparkmart.llm.near_dedup import deduplicate
from sparkmart.llm.sharding import interleave_shards
from sparkmart.llm.toxicity import drop_toxic
from sparkmart.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs, k=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = interleave_shards(docs, n_shards=24, extra=("lang", "n_chars"))
    return out.select(
        "doc_id", "lang", "source", "n_chars", "size", "text_crc32", "law", "shard", "slot"
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The classifier and the near-duplicate components are beyond SQL; the tests
# hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = os.path.join(base, f"{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
