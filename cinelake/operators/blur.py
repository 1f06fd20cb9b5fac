"""Privacy blur planning: stride detections, carry-forward, manifests, mask grids, progress model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions import text

# Detection categories, and the detector's queries of each category.
CATEGORIES = ("face", "license_plate", "logo", "card_object", "object")
QUERIES = {
    "license_plate": (
        "car license plate", "vehicle number plate on bumper", "white rectangular plate with numbers on car", "korean license plate",
        "small license plate on vehicle", "white license plate with korean characters", "yellow license plate on vehicle",
        "green license plate on vehicle", "blue license plate on vehicle", "license plate on front bumper",
        "license plate on rear bumper",
    ),
    "logo": (
        "brand logo", "company logo", "brand logo on product", "brand logo on product surface", "logo mark on product",
        "brand symbol on product", "product branding", "brand marking on packaging", "logo printed on product packaging",
        "logo on paper packaging", "logo on metallic packaging", "brand name on foil pouch", "label with brand name on product",
        "logo on product label", "circular logo on product label", "sticker label on product", "colorful label patch on product",
        "brand name on metal container", "logo on tin can", "gold logo on dark container", "logo on glass container",
        "logo on plastic product", "brand name on device surface", "logo engraved on product",
    ),
    "card_object": (
        "credit card", "debit card", "bank card", "ID card", "resident registration card", "driver license", "passport",
        "health insurance card", "business card", "name card", "membership card",
    ),
}


def validate(
    categories: Sequence[str], stride: int, threshold: float, min_face_confidence: float = 0.5, masks: bool = False, mask_dir: str | None = None
) -> None:
    """Raises ValueError for a configuration that cannot be run."""
    unknown = set(categories) - set(CATEGORIES)
    if unknown:
        raise ValueError(f"unknown categories: {sorted(unknown)}")
    if stride < 1 or not 0 <= threshold <= 1 or not 0 <= min_face_confidence <= 1:
        raise ValueError("stride is 1 or more, threshold and min_face_confidence are in 0 to 1")
    if masks and not mask_dir:
        raise ValueError("masks need mask_dir")


def label_category(label: Column, queries: Mapping[str, Sequence[str]] = QUERIES) -> Column:
    """The first category that lists the label, case and outer spaces ignored; else "object"."""
    known: dict[str, str] = {}
    for category, labels in queries.items():
        for q in labels:
            known.setdefault(q.lower(), category)
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair)) if known else F.create_map().cast("map<string,string>")
    return F.coalesce(table[F.lower(text.strip(label))], F.lit("object"))


def query_list(categories: Sequence[str], custom: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(query, category) in the order of the configuration, custom ones last."""
    return [(q, c) for c in categories if c in QUERIES for q in QUERIES[c]] + [(q, "object") for q in custom]


def fresh_detections(detections: DataFrame, stride: int, threshold: float) -> DataFrame:
    """Detections of inferred frames at or above the threshold."""
    return detections.where((F.col("frame_idx") % stride == 0) & (F.col("confidence") >= threshold))


def carried_detections(frames: DataFrame, fresh: DataFrame, stride: int) -> DataFrame:
    """Every frame with the detections of the last inferred frame."""
    f = frames.withColumn("src", F.col("frame_idx") - F.col("frame_idx") % stride)
    d = fresh.withColumnRenamed("frame_idx", "src")
    return f.join(d, ["video_id", "src"]).withColumn("from_cache", F.col("src") != F.col("frame_idx")).drop("src")


def manifest_records(detections: DataFrame) -> DataFrame:
    """Detections rounded as the manifest stores them: confidence to 4 digits, box to 5, and t_ms where there is one to 1."""
    out = detections.withColumn("confidence", F.bround("confidence", 4)).withColumn("bbox_norm", F.transform("bbox_norm", lambda v: F.bround(v, 5)))
    return out.withColumn("t_ms", F.bround("t_ms", 1)) if "t_ms" in out.columns else out


def run_figures(runs: DataFrame) -> DataFrame:
    """runs(video_id, frame_count, fps, total_ms, infer_ms, infer_calls) rounded as the manifest's head stores them, with avg_fps
    (frames a second of work, 0 without any)."""
    avg = F.coalesce(F.try_divide(F.col("frame_count") * 1000.0, F.col("total_ms")), F.lit(0.0))
    return runs.withColumn("fps", F.bround("fps", 3)).withColumn("avg_fps", F.bround(avg, 2)).withColumn("total_ms", F.bround("total_ms", 1)).withColumn("infer_ms", F.bround("infer_ms", 1))


def inference_counters(frames: DataFrame, stride: int) -> DataFrame:
    """frames(video_id, frame_idx, infer_ms, error) -> calls, failed calls and time of the detector, which runs on every
    stride-th frame; a call that fails counts too."""
    run = frames.where(F.col("frame_idx") % stride == 0)
    return run.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("infer_calls"), F.count_if(F.col("error").isNotNull()).alias("failed_calls"), F.coalesce(F.sum("infer_ms"), F.lit(0.0)).alias("infer_ms")
    )


def manifest_documents(detections: DataFrame, runs: DataFrame) -> DataFrame:
    """One JSON manifest per video: the run's figures, a count per category, and the detections by frame."""
    rows = manifest_records(detections)
    fields = [c for c in rows.columns if c != "video_id"]
    per = rows.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("frame_idx", *(c for c in fields if c != "frame_idx")))).alias("detections"))
    out = run_figures(runs).join(summary_map(detections), "video_id", "left").join(per, "video_id", "left")
    rest = [F.col(c) for c in run_figures(runs).columns if c != "video_id"]
    found = F.coalesce("detections", F.array().cast(per.schema["detections"].dataType))
    counts = F.coalesce("summary", F.create_map().cast("map<string,bigint>"))
    document = F.struct(F.lit("1").alias("schema_version"), "video_id", *rest, counts.alias("summary"), found.alias("detections"))
    return out.select("video_id", F.to_json(document).alias("document"))


def summary(detections: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """One row per video with a count per category, 0 where there is none."""
    return detections.groupBy("video_id").agg(*(F.count_if(F.col("category") == c).alias(c) for c in categories))


def summary_map(detections: DataFrame) -> DataFrame:
    """One row per video with a map of the categories it has."""
    counts = detections.groupBy("video_id", "category").count()
    return counts.groupBy("video_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "count")))).alias("summary"))


def summary_rollup(detections: DataFrame) -> DataFrame:
    """Counts by video and category with subtotals (a convenience of ours)."""
    return detections.rollup("video_id", "category").agg(F.count(F.lit(1)).alias("n"))


def mask_grid(frames: DataFrame, rects: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row for every frame and configured category, with its rectangles or none; other categories are ignored."""
    grid = frames.select("video_id", "frame_idx", F.explode(F.array(*map(F.lit, dict.fromkeys(categories)))).alias("category"))
    own = rects.groupBy("video_id", "frame_idx", "category").agg(F.array_sort(F.collect_list("rect")).alias("rects"))
    return grid.join(own, ["video_id", "frame_idx", "category"], "left").withColumn("n_rects", F.greatest(F.size("rects"), F.lit(0)))


def progress_pct(index: Column, total: Column) -> Column:
    """Share of the detecting phase: 2 at its start, at most 95."""
    return F.when(total > 0, F.least(2.0 + index / total * 93.0, F.lit(95.0)))
