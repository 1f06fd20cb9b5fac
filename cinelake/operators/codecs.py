"""Decoder and encoder commands as columns, and the way to run them on the executors.

A command is an array of strings, so a plan of commands can be looked at before anything runs. ``run_commands`` runs one per row
in a folder of its own, which goes when the command ends; a command that fails gives its status and message, not an exception.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _argv(*parts: str | Column) -> Column:
    return F.array(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _seconds(ms: Column) -> Column:
    """Milliseconds as seconds with three digits."""
    return F.format_string("%d.%03d", F.floor(ms / 1000).cast("long"), F.pmod(ms, F.lit(1000)).cast("long"))


# Fixed values below: the arguments that decoders and encoders are called with.


def probe(path: Column) -> Column:
    """Streams and format as JSON, for transcode.parse_probe."""
    return _argv("ffprobe", "-v", "quiet", "-print_format", "json", "-show_format", "-show_streams", path)


def duration(path: Column) -> Column:
    return _argv("ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "default=noprint_wrappers=1:nokey=1", path)


def duration_ms(stdout: Column) -> Column:
    """Whole milliseconds, toward zero, of what the duration command says; null where it says nothing of the kind."""
    return (F.trim(F.regexp_replace(stdout, r"\s+", "")).try_cast("double") * 1000).cast("long")


def scene_log(path: Column, threshold: float = 0.3) -> Column:
    """The scene filter, whose log signals.cuts_from_log reads."""
    return _argv("ffmpeg", "-i", path, "-filter:v", f"select='gt(scene,{threshold})',showinfo", "-f", "null", "-")


def keyframe(path: Column, ms: Column, out: Column) -> Column:
    """One picture by a seek."""
    return _argv("ffmpeg", "-y", "-ss", _seconds(ms), "-i", path, "-frames:v", "1", "-q:v", "2", out)


def keyframe_batch(path: Column, times: Column, pattern: Column) -> Column:
    """All pictures in one pass: times in ms, ascending; the pattern numbers the pictures from 1."""
    wanted = F.array_join(F.transform(times, lambda ms: F.concat(F.lit("eq(t\\,"), _seconds(ms), F.lit(")"))), "+")
    chosen = F.concat(F.lit("select='"), wanted, F.lit("'"))
    return _argv("ffmpeg", "-y", "-i", path, "-vf", chosen, "-vsync", "0", "-q:v", "2", pattern)


def audio_wav(path: Column, out: Column) -> Column:
    return _argv("ffmpeg", "-i", path, "-vn", "-acodec", "pcm_s16le", "-ar", "16000", "-ac", "1", "-y", out)


def audio_mp3(path: Column, out: Column) -> Column:
    """For uploads above the limit of transcode.audio_route."""
    return _argv("ffmpeg", "-i", path, "-vn", "-acodec", "libmp3lame", "-ar", "16000", "-ac", "1", "-b:a", "64k", "-y", out)


def clip(path: Column, start_ms: Column, end_ms: Column, out: Column) -> Column:
    """A part of a recording, encoded anew so that it starts at its very frame."""
    cut = _argv("ffmpeg", "-y", "-ss", (start_ms / 1000.0), "-i", path, "-t", ((end_ms - start_ms) / 1000.0))
    coded = _argv("-c:v", "libx264", "-preset", "fast", "-crf", "18", "-c:a", "aac", "-b:a", "128k", "-avoid_negative_ts", "make_zero", out)
    return F.concat(cut, coded)


RESULT = "status int, stdout string, stderr string"


def run_commands(rows: DataFrame, command: str = "command", timeout_s: float = 600.0) -> DataFrame:
    """rows with status (null for a program that is missing or out of time), stdout and stderr of each row's command."""

    @F.pandas_udf(RESULT)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import subprocess
        import tempfile

        def one(argv: list[str]) -> tuple[int | None, str, str]:
            with tempfile.TemporaryDirectory() as folder:
                try:
                    done = subprocess.run(list(argv), capture_output=True, timeout=timeout_s, cwd=folder, stdin=subprocess.DEVNULL)
                except (OSError, subprocess.TimeoutExpired) as e:
                    return None, "", f"{type(e).__name__}: {e}"
                return done.returncode, done.stdout.decode("utf-8", "replace"), done.stderr.decode("utf-8", "replace")

        for part in parts:
            yield pd.DataFrame([one(x) for x in part], columns=["status", "stdout", "stderr"]).astype({"status": "Int32"})

    return rows.withColumn("__r", run(F.col(command))).select(*rows.columns, "__r.*")


def log_lines(done: DataFrame, key: str = "video_id") -> DataFrame:
    """(video_id, line) of the messages of commands that succeeded, for signals.cuts_from_log."""
    return done.where("status = 0").select(F.col(key).alias("video_id"), F.explode(F.split("stderr", "\n")).alias("line"))


def keyframe_results(plan: DataFrame, batch: DataFrame, single: DataFrame) -> DataFrame:
    """plan(video_id, scene_id, path) with the picture's path, null where no command made it: the batch's where the whole batch
    of the video succeeded, else that of the scene's own command. batch(video_id, status), single(scene_id, status)."""
    b = batch.select("video_id", (F.col("status") == 0).alias("__b"))
    s = single.select("scene_id", (F.col("status") == 0).alias("__s"))
    out = plan.join(b, "video_id", "left").join(s, "scene_id", "left")
    made = F.coalesce("__b", F.lit(False)) | F.coalesce("__s", F.lit(False))
    return out.withColumn("keyframe_path", F.when(made, F.col("path"))).drop("__b", "__s")


def read_frames(path: str) -> Iterator[tuple[int, object]]:
    """(index, picture) of every frame until the end. Needs OpenCV."""
    import cv2

    video = cv2.VideoCapture(path)
    try:
        n = 0
        while True:
            ok, frame = video.read()
            if not ok:
                return
            yield n, frame
            n += 1
    finally:
        video.release()


def frames_at(path: str, times_s: list[float]) -> list:
    """The picture at each time, null where there is none. Needs OpenCV."""
    import cv2

    video = cv2.VideoCapture(path)
    out = []
    try:
        for t in times_s:
            video.set(cv2.CAP_PROP_POS_MSEC, float(t) * 1000.0)
            ok, frame = video.read()
            out.append(frame if ok else None)
    finally:
        video.release()
    return out


# Codecs tried for a written video, in order.
WRITER_CODECS = ("mp4v", "avc1", "x264")


def open_writer(path: str, fps: float, width: int, height: int):
    """A writer of the first codec that works. Needs OpenCV."""
    import cv2

    for codec in WRITER_CODECS:
        writer = cv2.VideoWriter(path, cv2.VideoWriter_fourcc(*codec), fps, (width, height))
        if writer.isOpened():
            return writer
        writer.release()
    raise RuntimeError(f"no codec can write {path}")
