"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of docs and nothing else, whatever their names; nulls, empty tables and repeated rows are
treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import decontam, langid, linededup, mixing, neardup

MIN_SCORE = 0.5
SLACK_BITS, ALLOWANCE = 32, 1.1  # the slack is for a text of a few bytes


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, no language with at least half of the posterior, or a code too long.

    The posterior only compares the learned languages. So a text also needs a code of at most SLACK_BITS and ALLOWANCE times
    the most bits a byte that a training document takes under a model of the other half of the training documents: unlearned
    languages and letter junk cost far more. Where no row that may be learned from has a label, there is nothing to judge by:
    then only texts without a letter (and null ones) go.
    """
    chosen = langid.learned(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    if chosen is None:
        return docs.where(F.coalesce(F.col("text").rlike(langid.LETTER), F.lit(False)))
    half = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(2))
    halves = [chosen.where(half == k) for k in (0, 1)]
    counts = [langid.counted(x, "text", "lang") or {} for x in halves]
    added = ("__lang_pred", "__score", "__bits")
    judged = langid.identify(docs, langid.merged(counts), "text", tuple(docs.columns), added)
    judged = judged.where((F.col("__lang_pred") != "und") & (F.col("__score") >= MIN_SCORE))
    if all(counts):
        most = 1.0
        for x, other in zip(halves, counts[::-1]):
            own = langid.identify(x, other, "text", ("text",), added).where("__lang_pred != 'und'")
            most = max(most, own.agg(F.max((F.col("__bits") - SLACK_BITS) / F.octet_length("text"))).first()[0] or 0.0)
        judged = judged.where(F.col("__bits") <= SLACK_BITS + ALLOWANCE * most * F.octet_length("text"))
    return judged.select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines; a document that loses lines and has nothing but white space left goes. n_chars follows the text."""
    out = linededup.dedup_lines(docs, exact_chars=linededup.ALL_LINES, added=("__lines", "__dropped"))
    lost = F.col("__dropped") > 0
    out = out.where(~lost | F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(lost, size).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near-duplicates; texts without words stay."""
    return neardup.keep_first(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that holds a window of the benchmark, however small its share of the text."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontam.decontaminate(docs, bench).where("n_hit > 0").select(F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", decontam.row_key("doc_id", "text"))
    return keyed.join(bad, "__key", "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the columns of documents with size, source_size, target, copies and taken."""
    return mixing.mix_sources(docs)
