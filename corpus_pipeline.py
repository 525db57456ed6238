"""Corpus pipeline: documents in, a clean and weighted mixture out.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on; its
result is written as Parquet under the shared checkpoint folder and read
again for the next one, so a lost executor costs no more than the stage it
was working on.  All stages but the last return the columns of ``documents``.

1. language ID: drops documents without letters or far from every language;
2. MinHash near-duplicates: one document of each group stays;
3. substring deduplication: repeated paragraphs are cut out, the first stays;
4. benchmark decontamination: spans of benchmark windows are cut out;
5. mixing: the copies and parts that source weights and quality call for.

No DuckDB statement: the language model and the sampling hash have none; the
tests hold every stage against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import decontaminate, language_id, minhash, mixing, paragraphs
from vellum.llm.common import prepare, read_table
from vellum.session import ensure_checkpoint_dir

STAGES = [
    ("language_id", language_id.stage_language),
    ("minhash_near_dedup", minhash.stage_near_duplicates),
    ("substring_dedup", paragraphs.stage_substrings),
    ("benchmark_decontamination", decontaminate.stage_decontaminate),
    ("mixing", mixing.stage_mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
