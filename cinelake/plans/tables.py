"""The driver's tables in the roles of media records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A small sample dictionary of our own: category -> terms.
DICTIONARY = {"action": ("click", "purchase"), "trouble": ("error", "fail"), "visit": ("view", "signup")}
DOC_DICTIONARY = {"art": ("the", "der", "le "), "licence": ("licensed", "license"), "secret": ("password", "token"), "spam": ("scum", "!!")}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as segments: a user is a recording, an event starts a segment of ``value`` tenths of a second or more."""
    e = read(spark, sf_dir, "events")
    start = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") / 1000.0
    speaker = F.when(F.col("event_type") != "error", F.col("event_type"))
    return e.select(
        F.col("user_id").alias("video_id"), F.col("event_id").alias("ord"), start.alias("start"),
        (start + F.floor(F.col("value") * 1000) / 1000.0).alias("end"), speaker.alias("speaker_id"),
        F.concat_ws(" ", F.col("event_type"), F.lit("at"), F.col("event_id").cast("string")).alias("text"),
    )


SPEECH_SQL = """speech AS (
  SELECT user_id AS video_id, event_id AS ord,
    date_diff('millisecond', TIMESTAMP '2024-01-01 00:00:00', date_trunc('millisecond', ts)) / 1000.0::DOUBLE AS "start",
    date_diff('millisecond', TIMESTAMP '2024-01-01 00:00:00', date_trunc('millisecond', ts)) / 1000.0::DOUBLE + floor(value * 1000) / 1000.0::DOUBLE AS "end",
    CASE WHEN event_type <> 'error' THEN event_type END AS speaker_id,
    event_type || ' at ' || event_id::VARCHAR AS text
  FROM events)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker turns for the same recordings: every event with a speaker, longer by two minutes."""
    s = speech(spark, sf_dir).where(F.col("speaker_id").isNotNull())
    return s.select("video_id", "ord", "start", (F.col("end") + 120).alias("end"), "speaker_id")


def lineitem_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as detections: order = recording, box and confidence from its numbers by modulo."""
    li = read(spark, sf_dir, "lineitem")
    q, p, s = F.col("l_quantity").cast("int"), F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        (F.col("l_orderkey") % 500).alias("video_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), (p % 40).alias("frame_idx"),
        (p % 97 * 10).cast("int").alias("x"), (s % 53 * 10).cast("int").alias("y"), (q * 4 + 5).alias("w"), (q * 3 + 5).alias("h"),
        F.bround(F.col("l_discount") * 10, 2).alias("confidence"),
        F.element_at(F.array(*map(F.lit, LABELS)), (p % len(LABELS) + 1).cast("int")).alias("label"),
    )


LABELS = ("Brand Logo", "credit card", " passport ", "something else", "logo on tin can", "car license plate")
BOX_SQL = """boxes AS (
  SELECT l_orderkey % 500 AS video_id, l_orderkey * 10 + l_linenumber AS ord, l_partkey % 40 AS frame_idx,
    (l_partkey % 97 * 10)::INT AS x, (l_suppkey % 53 * 10)::INT AS y, (l_quantity::INT * 4 + 5) AS w, (l_quantity::INT * 3 + 5) AS h,
    round_even(l_discount * 10, 2)::DOUBLE AS confidence,
    (['Brand Logo', 'credit card', ' passport ', 'something else', 'logo on tin can', 'car license plate'])[(l_partkey % 6 + 1)::INT] AS label
  FROM lineitem)"""


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as probe rows."""
    p = read(spark, sf_dir, "part")
    codec = F.when(F.col("p_type") == "ECONOMY", "h264").when(F.col("p_type") == "STANDARD", "hevc").otherwise(F.lower("p_type"))
    return p.select(
        F.col("p_partkey").alias("video_id"), codec.alias("codec_name"), (F.col("p_size") * 32).alias("width"), (F.col("p_size") * 18).alias("height"),
        F.floor("p_retailprice").cast("int").alias("kbps0"),
    ).withColumn("bitrate_kbps", (F.col("kbps0") * 2).cast("int")).drop("kbps0")


PROBE_SQL = """probes AS (
  SELECT p_partkey AS video_id, CASE WHEN p_type = 'ECONOMY' THEN 'h264' WHEN p_type = 'STANDARD' THEN 'hevc' ELSE lower(p_type) END AS codec_name,
    p_size * 32 AS width, p_size * 18 AS height, (floor(p_retailprice)::INT * 2) AS bitrate_kbps
  FROM part)"""
