"""Split signals from speech: pauses, speaker turns, visual cuts, and interval overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def millis(seconds: Column) -> Column:
    """Seconds to whole milliseconds, toward zero."""
    return (seconds * 1000).cast("long")


def speech_pauses(segments: DataFrame, min_gap_ms: int = 300) -> DataFrame:
    """segments(video_id, ord, start, end) -> video_id, timestamp_ms, strength, source: the middle of each long gap."""
    w = Window.partitionBy("video_id").orderBy("start", "ord")
    gap = segments.withColumn("end_ms", millis(F.col("end"))).withColumn("gap", F.lead(millis(F.col("start"))).over(w) - F.col("end_ms"))
    return gap.where(F.col("gap") >= min_gap_ms).select(
        "video_id", (F.col("end_ms") + F.floor(F.col("gap") / 2)).cast("long").alias("timestamp_ms"),
        F.least(F.lit(1.0), F.col("gap") / 2000.0).alias("strength"), F.lit("speech_pause").alias("source"),
    )


def speaker_turns(segments: DataFrame) -> DataFrame:
    """A signal wherever the next segment with a known speaker has another one."""
    w = Window.partitionBy("video_id").orderBy("start", "ord")
    known = segments.where(F.col("speaker_id").isNotNull())
    known = known.withColumn("next", F.lead("speaker_id").over(w)).withColumn("end_ms", millis(F.col("end")))
    known = known.withColumn("next_ms", F.lead(millis(F.col("start"))).over(w)).where(F.col("next") != F.col("speaker_id"))
    gap = F.col("next_ms") - F.col("end_ms")
    return known.select(
        "video_id", F.when(gap >= 0, (F.col("end_ms") + F.floor(gap / 2)).cast("long")).otherwise(F.col("next_ms")).alias("timestamp_ms"),
        F.when(gap >= 0, F.lit(1.0)).otherwise(F.lit(0.7)).alias("strength"), F.lit("speaker_turn").alias("source"),
    )


def cuts_from_log(lines: DataFrame) -> DataFrame:
    """lines(video_id, line) of the scene filter's log -> distinct video_id, cut_ms above 0."""
    at = F.regexp_extract("line", r"pts_time:\s*([0-9.]+)", 1)
    cuts = lines.where(F.col("line").contains("showinfo") & (F.length(at) > 0))
    return cuts.select("video_id", millis(at.cast("double")).alias("cut_ms")).where("cut_ms > 0").distinct()


def overlap_join(left: DataFrame, right: DataFrame, key: tuple[str, str], a: tuple[str, str], b: tuple[str, str], width: float) -> DataFrame:
    """Pairs of left and right rows with equal keys whose intervals a = (start, end) and b overlap.

    Both sides are dealt into time buckets of ``width``, so a long recording is many join keys and its rows meet only those
    near them; a pair that shares several buckets counts in the first one.
    """

    def dealt(rows: DataFrame, at: tuple[str, str], name: str) -> DataFrame:
        first, last = (F.floor(f(at[0], at[1]) / F.lit(width)).cast("long") for f in (F.least, F.greatest))
        return rows.withColumn(name + "0", first).withColumn(name, F.explode(F.sequence(first, last)))

    both = dealt(left, a, "__l").join(dealt(right, b, "__r"), (F.col(key[0]) == F.col(key[1])) & (F.col("__l") == F.col("__r")))
    met = both.where((F.col(a[0]) < F.col(b[1])) & (F.col(b[0]) < F.col(a[1])) & (F.col("__l") == F.greatest("__l0", "__r0")))
    return met.drop("__l", "__r", "__l0", "__r0")


def attribute_speakers(segments: DataFrame, turns: DataFrame) -> DataFrame:
    """segments(video_id, ord, start, end), turns(video_id, ord, start, end, speaker_id) -> segments with the speaker of
    the greatest total overlap; ties go to the speaker of the first overlapping turn; none overlaps: null."""
    t = turns.select(F.col("video_id").alias("tv"), F.col("ord").alias("tord"), F.col("start").alias("ts"), F.col("end").alias("te"), F.col("speaker_id").alias("who"))
    s = segments.drop("speaker_id")
    over = F.least("end", "te") - F.greatest("start", "ts")
    met = overlap_join(s, t, ("video_id", "tv"), ("start", "end"), ("ts", "te"), 600.0)
    each = met.groupBy("video_id", "ord", "who").agg(F.sum(over).alias("total"), F.min(F.struct("ts", "tord")).alias("first"))
    best = each.where("total > 0").groupBy("video_id", "ord").agg(F.min_by("who", F.struct(-F.col("total"), F.col("first"))).alias("speaker_id"))
    return s.join(best, ["video_id", "ord"], "left")


def combine_signals(cuts: DataFrame, signals: DataFrame, totals: DataFrame, target_ms: int, min_ms: int = 500, max_ms: int = 45_000) -> DataFrame:
    """(video_id, boundaries): visual cuts, and in every span above the target its strongest signal, nearest to the
    target; then the least gap and the longest duration (see scenes)."""
    from cinelake.operators import scenes

    base = totals.join(cuts.groupBy("video_id").agg(F.array_sort(F.collect_set("cut_ms")).alias("cuts")), "video_id", "left")
    base = base.withColumn("cuts", scenes.boundaries(F.coalesce("cuts", F.array().cast("array<bigint>")), F.col("total_ms"), min_ms, 0))
    spans = scenes.intervals(base, "cuts").select("video_id", F.col("start_ms").alias("s"), F.col("end_ms").alias("e")).where(F.col("e") - F.col("s") > target_ms)
    inside = spans.join(signals, "video_id").where((F.col("timestamp_ms") > F.col("s")) & (F.col("timestamp_ms") < F.col("e")))
    order = F.struct(-F.col("strength"), F.abs(F.col("timestamp_ms") - F.col("s") - target_ms), F.col("timestamp_ms"))
    extra = inside.groupBy("video_id", "s").agg(F.min_by("timestamp_ms", order).alias("cut_ms")).select("video_id", "cut_ms")
    every = cuts.select("video_id", "cut_ms").unionByName(extra)
    base = totals.join(every.groupBy("video_id").agg(F.collect_set("cut_ms").alias("cuts")), "video_id", "left")
    return base.select("video_id", "total_ms", scenes.boundaries(F.coalesce("cuts", F.array().cast("array<bigint>")), F.col("total_ms"), min_ms, max_ms).alias("boundaries"))
