"""Readers and writers of the record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = "start double, end double, start_s double, end_s double, text string, confidence double, speaker_id string"
SCENE = "scene_id string, index int, start_ms bigint, end_ms bigint, keyframe_timestamp_ms bigint, keyframe_path string"
FACE_BOX = "struct<x:int,y:int,w:int,h:int,det_conf:double>"


def _json(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    full = T._parse_datatype_string(schema)
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("ignoreMissingFiles", True)
    try:
        return reader.option("multiLine", multiline).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], full)
        raise


def normalise_segments(rows: DataFrame) -> DataFrame:
    """Either spelling of the times, defaults for what is missing; the speaker is kept."""
    return rows.select(
        *(c for c in ("video_id", "ord") if c in rows.columns),
        F.coalesce("start", "start_s", F.lit(0.0)).alias("start"), F.coalesce("end", "end_s", F.lit(0.0)).alias("end"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("confidence", F.lit(1.0)).alias("confidence"), "speaker_id",
    )


def read_speech(spark: SparkSession, path: str) -> DataFrame:
    """Segments of speech results; a missing file has none."""
    rows = _json(spark, path, f"video_id string, segments array<struct<{_struct(SEGMENT)}>>")
    rows = rows.select("video_id", F.posexplode("segments").alias("ord", "s")).select("video_id", F.col("ord").cast("long"), "s.*")
    return normalise_segments(rows)


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Scenes under either key; rows whose id is not a text are left out."""
    item = f"array<struct<{_struct(SCENE)}>>"
    rows = _json(spark, path, f"video_id string, scenes {item}, boundaries {item}")
    return rows.select("video_id", F.inline(F.coalesce("scenes", "boundaries"))).where("scene_id is not null")


def read_face_lines(spark: SparkSession, path: str) -> DataFrame:
    """Detections, one JSON object a line; blank lines are skipped."""
    schema = f"video_id string, ts double, image_path string, bboxes array<{FACE_BOX}>"
    return _json(spark, path, schema, multiline=False).where("bboxes is not null")


def read_face_document(spark: SparkSession, path: str) -> DataFrame:
    """The same from one JSON document with a ``detections`` list."""
    item = f"struct<ts:double,image_path:string,bboxes:array<{FACE_BOX}>>"
    return _json(spark, path, f"video_id string, detections array<{item}>").select("video_id", F.inline("detections"))


def read_composition(spark: SparkSession, path: str) -> DataFrame:
    clip = "struct<scene_id:string,video_id:string,start_ms:bigint,end_ms:bigint,timeline_start_ms:bigint>"
    part = "array<struct<text:string,start_ms:bigint,end_ms:bigint>>"
    layer = "array<struct<kind:string,id:string,start_ms:bigint,end_ms:bigint,layer_index:int>>"
    rows = _json(spark, path, f"spec_id string, scene_clips array<{clip}>, subtitles {part}, overlays {layer}")
    return rows.withColumn("overlays", F.array_sort("overlays", lambda a, b: a["layer_index"] - b["layer_index"]))


def list_pictures(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, content) of the pictures in a folder, by path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,bmp,JPG,JPEG,PNG,BMP}").load(folder)
    return files.select("path", F.col("length").alias("size"), "content").orderBy("path")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, line): the video is the file's name."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.text(path).select(name.alias("video_id"), F.col("value").alias("line"))


def _struct(schema: str) -> str:
    return ",".join(":".join(f.strip().split(" ", 1)) for f in schema.split(", "))


def write_lines(rows: DataFrame, path: str) -> None:
    """JSON lines, nulls kept. Spark's committer makes the folder appear at once or not at all."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_documents(rows: DataFrame, path: str, key: str, document: str = "document") -> None:
    """One JSON document per row, in a folder per key."""
    rows.select(key, document).write.mode("overwrite").partitionBy(key).text(path)


def flag(spark: SparkSession, name: str, default: bool = False) -> bool:
    """A switch in the session's settings: "true" or "1"."""
    return spark.conf.get(f"spark.cinelake.{name}", str(default)).strip().lower() in ("true", "1")


def reference_pictures(spark: SparkSession, explicit: list[str], folder: str | None = None) -> DataFrame:
    """(path, ord): the given paths, then the folder's pictures by name; a path that comes twice counts once."""
    given = spark.createDataFrame([(p, i) for i, p in enumerate(explicit) if p], "path string, ord bigint")
    if folder is not None:
        from pyspark.sql import Window

        listed = list_pictures(spark, folder).select("path")
        listed = listed.select("path", (F.row_number().over(Window.orderBy("path")) + len(explicit)).cast("long").alias("ord"))
        given = given.unionByName(listed)
    return given.groupBy("path").agg(F.min("ord").alias("ord"))


def with_boxes(pictures: DataFrame, found: DataFrame) -> DataFrame:
    """Every picture with its boxes; one that could not be read, or holds none, stays with an empty list."""
    none = F.array().cast(found.schema["bboxes"].dataType)
    return pictures.join(found.select("path", "bboxes"), "path", "left").withColumn("bboxes", F.coalesce("bboxes", none))


# Extensions of media files, in the order in which they are looked for.
MEDIA_EXTENSIONS = (".mp4", ".mov", ".mkv", ".webm", ".avi")


def list_media(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, path, ext_ord) of the media files of a folder that are not empty, for transcode.media_paths."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{mp4,mov,mkv,webm,avi}").load(folder).select("path")
    place = F.array_position(F.array(*map(F.lit, MEDIA_EXTENSIONS)), F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return files.select(F.regexp_replace(name, r"\.[^.]+$", "").alias("video_id"), "path", place.alias("ext_ord"))


def valid_keyframes(scenes: DataFrame, pictures: DataFrame) -> DataFrame:
    """scenes(scene_id, ...) with ``keyframe_valid``: there is a picture of a safe name and a sane size. pictures(path, size,
    width, height). Scenes without one stay."""
    from cinelake.functions import geometry

    name = F.regexp_extract("path", r"([^/]+)\.jpg$", 1)
    ok = pictures.where(geometry.valid_picture(F.col("size"), F.col("width"), F.col("height"))).select(name.alias("scene_id")).distinct()
    return scenes.join(ok.withColumn("__ok", F.lit(True)), "scene_id", "left").withColumn("keyframe_valid", F.coalesce("__ok", F.lit(False))).drop("__ok")


def write_files(rows: DataFrame, path: str, key: str, document: str = "document", ending: str = ".json") -> None:
    """One file per row, ``path/key.json``, of its JSON document. Written aside first; each file then appears by a rename."""
    spark = rows.sparkSession
    aside = path.rstrip("/") + ".tmp"
    rows.select(F.col(key).cast("string").alias("__key"), F.col(document).alias("value")).write.mode("overwrite").partitionBy("__key").text(aside)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(aside)
    fs = at.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    for folder in fs.listStatus(at):  # renames only: no document passes through the driver
        if folder.isDirectory():
            name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.getPath().getName()).split("=", 1)[1]
            target = jvm.org.apache.hadoop.fs.Path(path, name + ending)
            for part in fs.listStatus(folder.getPath()):
                fs.delete(target, False)
                fs.rename(part.getPath(), target)
    fs.delete(at, True)


def write_document(rows: DataFrame, path: str, document: str = "document") -> None:
    """The one document of rows as one file, replaced at once."""
    import os

    folder, name = os.path.split(path)
    stem, ending = os.path.splitext(name)
    write_files(rows.select(F.lit(stem).alias("__name"), document), folder or ".", "__name", document, ending)
