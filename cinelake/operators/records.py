"""Transcripts, OCR results and captions: per-scene text, statistics, ranking, envelopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions import text


def clean_segments(rows: DataFrame) -> DataFrame:
    """Transcript rows with trimmed text and times to 3 digits, empty ones left out."""
    out = rows.withColumn("text", text.clean_segment_text(F.col("text"))).where("text is not null")
    return out.withColumn("start", F.bround("start", 3)).withColumn("end", F.bround("end", 3))


def transcript_summary(rows: DataFrame) -> DataFrame:
    """One row per video: segments, last end, spoken time."""
    return rows.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("total_segments"), F.coalesce(F.max("end"), F.lit(0.0)).alias("total_duration_s"),
        F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0.0)).alias("spoken_s"), F.count_distinct("speaker_id").alias("n_speakers"),
    )


def ocr_scene_text(blocks: DataFrame, min_conf: float = 0.5, redact: bool = True) -> DataFrame:
    """blocks(scene_id, ord, text, confidence) -> scene text: sure blocks in order, sanitised, redacted if asked, gated."""
    sure = blocks.where(F.col("confidence") >= min_conf)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda b: b["text"]), " ")
    kept = sure.groupBy("scene_id").agg(joined.alias("t"), F.avg("confidence").alias("c"), F.count(F.lit(1)).alias("n"))
    out = blocks.select("scene_id").distinct().join(kept, "scene_id", "left")
    clean = text.sanitize_ocr(F.coalesce("t", F.lit("")))
    clean = text.gate_text(text.redact_pii(clean) if redact else clean)
    return out.select("scene_id", clean.alias("ocr_text_raw"), F.length(clean).alias("ocr_char_count"), F.coalesce("c", F.lit(0.0)).alias("avg_confidence"), F.coalesce("n", F.lit(0)).cast("long").alias("n_blocks"))


def rank_segments(rows: DataFrame, dictionary: Mapping[str, Sequence[str]], weights: Mapping[str, float]) -> DataFrame:
    """Segments with their tags and a score (ours): weighted tag hits, and hits for each second."""
    tags = text.matched_categories(F.col("text"), dictionary)
    table = F.create_map(*(F.lit(x) for t in dictionary for x in (t, float(weights.get(t, 1.0)))))
    hits = F.aggregate(F.col("tags"), F.lit(0.0), lambda s, t: s + table[t])
    length = F.greatest(F.col("end") - F.col("start"), F.lit(0.001))
    return rows.withColumn("tags", tags).withColumn("score", hits + F.size("tags") / length)


def ocr_counters(scenes: DataFrame) -> DataFrame:
    """Scene texts (see ocr_scene_text) with video_id -> one row per video: scenes, frames with and without text, the mean
    confidence of all kept blocks (0 without any), status."""
    text_kept = F.length("ocr_text_raw") > 0
    blocks = F.sum("n_blocks")
    return scenes.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("scenes"), F.count_if(text_kept).alias("frames_processed"), F.count_if(~text_kept).alias("frames_skipped"),
        F.coalesce(F.sum(F.col("avg_confidence") * F.col("n_blocks")) / F.nullif(blocks, F.lit(0)), F.lit(0.0)).alias("avg_confidence"),
        F.lit("success").alias("status"),
    )


def run_results(segments: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per video of the speech flow: segments, spoken time, status and error. runs(video_id, error) names all videos that
    were tried; one without segments and without an error succeeded, with the remark that it holds no speech."""
    per = segments.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(F.col("end") - F.col("start")).alias("total_duration"))
    out = per.withColumn("failure", F.lit(None).cast("string")) if runs is None else runs.select("video_id", F.col("error").alias("failure")).join(per, "video_id", "left")
    n = F.coalesce("n_segments", F.lit(0).cast("long"))
    return out.select(
        "video_id", n.alias("n_segments"), F.coalesce("total_duration", F.lit(0.0)).alias("total_duration"),
        F.when(F.col("failure").isNotNull(), "error").otherwise("success").alias("status"),
        F.when(F.col("failure").isNotNull(), F.col("failure")).when(n == 0, "no speech detected").alias("error"),
    )


def transcript_documents(segments: DataFrame, version: str = "1.0") -> DataFrame:
    """One JSON document per video: its segments in order, their number and the last end."""
    fields = [c for c in segments.columns if c != "video_id"]
    rows = F.array_sort(F.collect_list(F.struct("start", *(c for c in fields if c != "start"))))
    per = segments.groupBy("video_id").agg(rows.alias("segments"), F.count(F.lit(1)).alias("total_segments"), F.max("end").alias("total_duration_s"))
    return per.select("video_id", F.to_json(F.struct(F.lit(version).alias("schema_version"), "video_id", "total_segments", "total_duration_s", "segments")).alias("document"))


def perf_rows(stages: DataFrame) -> DataFrame:
    """stages(run, stage, seconds) -> one row per run with a map of the stages' seconds and their total, to 3 digits."""
    per = stages.groupBy("run", "stage").agg(F.bround(F.sum("seconds"), 3).alias("s"))
    return per.groupBy("run").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "s")))).alias("stages"), F.bround(F.sum("s"), 3).alias("total_s"))


def run_status(n_segments: Column) -> Column:
    """Silence and failure look alike upstream, so the status says only what is known."""
    return F.when(n_segments > 0, "success").otherwise("empty")


def envelope(rows: DataFrame, name: str, key: str, order: str, version: str = "1.0") -> DataFrame:
    """One JSON document per key: version header and the ordered records."""
    fields = [c for c in rows.columns if c != key]
    records = F.array_sort(F.collect_list(F.struct(order, *(c for c in fields if c != order))))
    return rows.groupBy(key).agg(records.alias(name)).select(key, F.to_json(F.struct(F.lit(version).alias("schema_version"), F.col(key), F.col(name))).alias("document"))
