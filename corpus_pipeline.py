"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, mixing.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs. All
stages but the last return the columns of documents; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinelake.llm import stages
from cinelake.llm.scratch import Scratch, clear, mark

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing_stage),
]

#: Scores of trained models and hashed signatures have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        before = mark()
        done = scratch.keep(stage(spark, docs, sf_dir), name)
        clear(spark, before)  # what the stage's operators kept, and the table that it read
        scratch.release(done)
        docs = done
    return docs
