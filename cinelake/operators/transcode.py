"""Probe parsing, transcode decisions, encode commands and composition timelines as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBE_SCHEMA = (
    "struct<streams:array<struct<codec_type:string,codec_name:string,width:int,height:int,r_frame_rate:string,bit_rate:string>>,"
    "format:struct<bit_rate:string,duration:string>>"
)


def frame_rate(c: Column) -> Column:
    """"num/den" or a number, to 3 digits; 0 where it makes no sense."""
    parts = F.split(c, "/")
    ratio = F.try_divide(parts[0].try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"))
    value = F.when(F.size(parts) == 2, ratio).otherwise(c.try_cast("double"))
    return F.coalesce(F.bround(value, 3), F.lit(0.0))


def parse_probe(rows: DataFrame, col: str = "probe_json") -> DataFrame:
    """Probe columns from the prober's JSON: first video and first audio stream; fails without a video stream."""
    p = F.from_json(col, PROBE_SCHEMA)
    first = lambda kind: F.get(F.filter(F.col("__p.streams"), lambda s: s["codec_type"] == kind), F.lit(0))
    kbps = lambda c: F.floor(F.coalesce(c.try_cast("long"), F.lit(0)) / 1000).cast("int")
    out = rows.withColumn("__p", p).withColumn("__v", first("video")).withColumn("__a", first("audio"))
    rest = F.greatest(kbps(F.col("__p.format.bit_rate")) - F.when(F.col("__a").isNull(), 0).otherwise(kbps(F.col("__a.bit_rate"))), F.lit(0))
    own = kbps(F.col("__v.bit_rate"))
    fail = F.raise_error(F.lit("no video stream")).cast("int")
    cols = {
        "width": F.when(F.col("__v").isNull(), fail).otherwise(F.coalesce("__v.width", F.lit(0))),
        "height": F.coalesce("__v.height", F.lit(0)),
        "frame_rate": F.coalesce(frame_rate(F.col("__v.r_frame_rate")), F.lit(0.0)),
        "codec_name": F.coalesce("__v.codec_name", F.lit("unknown")),
        "bitrate_kbps": F.when(own == 0, rest).otherwise(own),
        "duration_ms": (F.coalesce(F.col("__p.format.duration").try_cast("double"), F.lit(0.0)) * 1000).cast("long"),
        "has_audio": F.col("__a").isNotNull(),
        "audio_codec": F.col("__a.codec_name"),
        "audio_bitrate_kbps": F.when(F.col("__a").isNotNull(), kbps(F.col("__a.bit_rate"))),
    }
    return out.select(*rows.columns, *(c.alias(n) for n, c in cols.items()))


# Codec names that count as H.264.
H264 = ("h264", "h264_qsv", "h264_nvenc")


def decision(codec: Column, width: Column, height: Column, kbps: Column, max_height: int = 720, max_kbps: int = 2500) -> Column:
    """struct<should_transcode, reason, should_cap_bitrate>."""
    codec_ok, height_ok, rate_ok = codec.isin(*H264), height <= max_height, kbps <= max_kbps
    failing = F.concat_ws(
        ", ",
        F.when(~codec_ok, F.format_string("codec=%s", codec)),
        F.when(~height_ok, F.format_string(f"height=%d > {max_height}", height)),
        F.when(~rate_ok, F.format_string(f"bitrate=%dkbps > {max_kbps}kbps", kbps)),
    )
    keep, cap = codec_ok & height_ok & rate_ok, codec_ok & height_ok & ~rate_ok
    reason = (
        F.when(keep, F.format_string(f"Already H.264 %dx%d @ %dkbps (within {max_kbps}kbps cap)", width, height, kbps))
        .when(cap, F.format_string(f"H.264 %dx%d but bitrate %dkbps exceeds {max_kbps}kbps cap", width, height, kbps))
        .otherwise(F.concat(F.lit("Requires transcode: "), failing))
    )
    return F.struct((~keep).alias("should_transcode"), reason.alias("reason"), cap.alias("should_cap_bitrate"))


def proxy_command(src: Column, dst: Column, height: Column, has_audio: Column, cap_only: Column, max_height: int = 720) -> Column:
    """The encoder's argument list: scaled unless only the bit rate is capped."""
    lit = lambda *xs: F.array(*map(F.lit, xs))
    rate = lit("-maxrate", "2500k", "-bufsize", "5000k")
    capped = F.concat(lit("-c:v", "libx264", "-preset", "fast"), rate, lit("-crf", "23"))
    scaled = F.concat(lit("-c:v", "libx264", "-preset", "fast", "-crf", "23"), rate, lit("-vf", f"scale=-2:{max_height}"))
    audio = F.when(has_audio, lit("-c:a", "aac", "-b:a", "128k")).otherwise(lit("-an"))
    video = F.when(cap_only & (height <= max_height), capped).otherwise(scaled)
    return F.concat(F.array(F.lit("ffmpeg"), F.lit("-y"), F.lit("-i"), src), video, audio, F.concat(lit("-movflags", "+faststart"), F.array(dst)))


def audio_route(size_bytes: Column) -> Column:
    """Uploads above 25 MiB go as 64 kbit/s MP3, others as WAV."""
    return F.when(size_bytes > 25 * 1024 * 1024, "mp3_64k").otherwise("wav_16k_mono")


def keyframe_plan(scenes: DataFrame) -> DataFrame:
    """Scenes in seek order, one batch per video, each with its place in the original order."""
    order = F.array_sort(F.collect_list(F.struct(F.col("keyframe_timestamp_ms").alias("ts"), "index", "scene_id")))
    return scenes.groupBy("video_id").agg(order.alias("plan")).select("video_id", F.posexplode("plan").alias("seek_rank", "p")).select("video_id", "seek_rank", "p.*")


def timeline(specs: DataFrame) -> DataFrame:
    """specs(spec_id, scene_clips) -> clip rows on the timeline, and where each ends."""
    c = specs.select("spec_id", F.posexplode("scene_clips").alias("clip_idx", "c")).select("spec_id", "clip_idx", "c.*")
    length = F.col("end_ms") - F.col("start_ms")
    return c.withColumn("duration_ms", length).withColumn("timeline_end_ms", F.col("timeline_start_ms") + length)


def label_route(has_subtitles: Column, n_overlays: Column, clips: Column) -> Column:
    """The name of the last stream: overlays end in vout, subtitles in final, plain clips in their last canvas."""
    return F.when(n_overlays > 0, "vout").when(has_subtitles, "final").otherwise(F.concat(F.lit("canvas"), clips))


def media_paths(clips: DataFrame, listing: DataFrame) -> DataFrame:
    """Clips with the first file of their video, by order of extension; fails where there is none."""
    best = listing.groupBy("video_id").agg(F.min_by("path", "ext_ord").alias("path"))
    out = clips.join(best, "video_id", "left")
    return out.withColumn("path", F.coalesce("path", F.raise_error(F.concat(F.lit("no media for "), F.col("video_id").cast("string")))))
