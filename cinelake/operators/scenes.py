"""Scene boundaries and scene documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions import text
from cinelake.operators import signals

FOLD = 256
PRESETS = {"default": 30_000, "fine": 15_000, "coarse": 60_000, "visual_only": None}


def resolve_preset(name: str) -> int | None:
    """Target duration of a preset; None: visual cuts alone."""
    if name not in PRESETS:
        raise ValueError(f"Unknown preset: {name}")
    return PRESETS[name]


def min_gap(cuts: Column, total: Column, min_ms: int) -> Column:
    """0, the cuts that keep the least distance from the last kept one, and the total in any case."""
    # The kept cuts grow in chunks of FOLD that are closed when full, so that a cut copies a chunk and the list of chunks only.
    sorted_cuts = F.array_sort(F.array_distinct(F.filter(cuts, lambda c: (c > 0) & (c < total))))
    longs = "array<bigint>"
    start = F.struct(
        F.array().cast(f"array<{longs}>").alias("done"), F.array(F.lit(0).cast("long")).alias("open"), F.lit(0).cast("long").alias("last")
    )

    def step(acc: Column, c: Column) -> Column:
        full = F.size(acc["open"]) >= FOLD
        taken = F.struct(
            F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(full, F.array(c)).otherwise(F.concat(acc["open"], F.array(c))).alias("open"), c.alias("last"),
        )
        return F.when(c - acc["last"] >= min_ms, taken).otherwise(acc)

    kept = F.aggregate(sorted_cuts, start, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["open"]))
    return F.concat(kept, F.array(total.cast("long")))


def max_duration(bounds: Column, max_ms: int) -> Column:
    """Points every max_ms inside spans longer than that; 0 or less: none."""
    if max_ms <= 0:
        return bounds
    starts = F.slice(bounds, F.lit(1), F.size(bounds) - 1)
    ends = F.slice(bounds, F.lit(2), F.size(bounds) - 1)
    parts = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda z: F.when(z["e"] > z["s"], F.sequence(z["s"], z["e"] - 1, F.lit(max_ms).cast("long"))).otherwise(F.array(z["s"])))
    return F.concat(F.flatten(parts), F.array(F.element_at(bounds, -1)))


def boundaries(cuts: Column, total: Column, min_ms: int = 500, max_ms: int = 45_000) -> Column:
    return max_duration(min_gap(cuts, total, min_ms), max_ms)


def intervals(df: DataFrame, bounds: str) -> DataFrame:
    """One row per non-empty pair of neighbours: index, start_ms, end_ms. Dropped pairs leave gaps in the index."""
    b = F.col(bounds)
    pairs = F.when(F.size(b) > 1, F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda i: F.struct((i - 1).alias("index"), b[i - 1].alias("start_ms"), b[i].alias("end_ms"))))
    rest = [c for c in df.columns if c != bounds]
    return df.select(*rest, F.explode(pairs).alias("p")).select(*rest, "p.*").where("end_ms > start_ms")


def scene_rows(df: DataFrame, bounds: str = "boundaries") -> DataFrame:
    """(video_id, total_ms, boundaries) -> scene rows with id and keyframe time."""
    rows = intervals(df, bounds)
    middle = F.col("start_ms") + F.floor((F.col("end_ms") - F.col("start_ms")) / 2).cast("long")
    latest = F.greatest(F.col("start_ms"), F.greatest(F.col("total_ms") - 500, F.lit(0)))
    return rows.select(
        "video_id", text.scene_id(F.col("video_id").cast("string"), F.col("index")).alias("scene_id"), "index", "start_ms", "end_ms",
        F.least(middle, latest).alias("keyframe_timestamp_ms"),
    )


def assign_segments(segments: DataFrame, scenes: DataFrame) -> DataFrame:
    """Each segment to the scene of its greatest overlap (ties: the earlier scene); without overlap it is left out."""
    s = segments.withColumn("seg_start", (F.col("start") * 1000).cast("long")).withColumn("seg_end", (F.col("end") * 1000).cast("long"))
    sc = scenes.select(F.col("video_id").alias("sv"), "scene_id", F.col("index").alias("scene_index"), "start_ms", "end_ms")
    over = F.least("seg_end", "end_ms") - F.greatest("seg_start", "start_ms")
    met = signals.overlap_join(s, sc, ("video_id", "sv"), ("seg_start", "seg_end"), ("start_ms", "end_ms"), 60_000)
    best = F.min(F.struct((-over).alias("neg"), "scene_index", "scene_id")).alias("best")
    return met.groupBy("video_id", "ord").agg(best, F.any_value("text").alias("text"), F.any_value("start").alias("start")).select(
        "video_id", "ord", "start", "text", F.col("best.scene_id").alias("scene_id")
    )


def scene_documents(
    scenes: DataFrame, segments: DataFrame, dictionary: Mapping[str, Sequence[str]], products: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Scenes with their transcript and tags; scenes without speech stay, with empty ones.

    Tags are looked for in each segment (a term across two segments is none) and united: keyword_tags are the categories of the
    dictionary, product_tags and product_entities the categories and terms of the products (by default the same dictionary).
    """
    products = dictionary if products is None else products
    said = F.coalesce("text", F.lit(""))
    a = assign_segments(segments, scenes).select(
        "scene_id", F.struct("start", "ord", F.trim(said).alias("text")).alias("said"), text.matched_categories(said, dictionary).alias("tags"),
        text.matched_categories(said, products).alias("kinds"), text.matched_terms(said, [t for ts in products.values() for t in ts]).alias("terms"),
    )
    words = F.filter(F.transform(F.array_sort(F.collect_list("said")), lambda x: x["text"]), lambda x: F.length(x) > 0)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    per = a.groupBy("scene_id").agg(
        F.array_join(words, " ").alias("raw"), F.count(F.lit(1)).alias("n"), *(union(c).alias(c) for c in ("tags", "kinds", "terms"))
    )
    none = F.array().cast("array<string>")
    out = scenes.join(per, "scene_id", "left")
    raw = F.coalesce("raw", F.lit(""))
    return out.select(
        "video_id", "scene_id", "index", "start_ms", "end_ms", "keyframe_timestamp_ms", raw.alias("transcript_raw"), F.lower(raw).alias("transcript_norm"),
        F.length(raw).cast("long").alias("transcript_char_count"), F.coalesce("n", F.lit(0).cast("long")).alias("speech_segment_count"),
        F.coalesce("tags", none).alias("keyword_tags"), F.coalesce("kinds", none).alias("product_tags"), F.coalesce("terms", none).alias("product_entities"),
        none.alias("people_cluster_ids"),
    )


def merge_ocr(scenes: DataFrame, ocr: DataFrame, max_scenes: int = 50) -> DataFrame:
    """Adds ocr_text_raw and ocr_char_count; a video of more than max_scenes scenes is left as it is."""
    from pyspark.sql import Window

    few = F.count(F.lit(1)).over(Window.partitionBy("video_id")) <= max_scenes
    out = scenes.join(ocr.select("scene_id", F.col("ocr_text_raw").alias("__ocr")), "scene_id", "left").withColumn("__few", few)
    found = F.when(F.col("__few"), F.coalesce("__ocr", F.lit(""))).otherwise("")
    return out.withColumn("ocr_text_raw", found).withColumn("ocr_char_count", F.length(found)).drop("__ocr", "__few")
