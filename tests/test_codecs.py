"""Commands as columns, run on the executors with stand-in programs."""

import os
import stat
import sys
import types

import pytest
from pyspark.sql import functions as F

from cinelake import cli
from cinelake.operators import codecs, signals


@pytest.fixture
def programs(tmp_path):
    """Stand-ins that tell their arguments, write their last argument, or fail."""
    body = """#!/bin/sh
case "$*" in *bad*) echo broken >&2; exit 3;; esac
case "$0" in *ffprobe) echo 12.3456;; esac
echo "[Parsed_showinfo_1] pts_time:4.5" >&2
case "$*" in *showinfo*) ;; *.jpg*) for last; do :; done; echo x > "$last";; esac
"""
    for name in ("ffmpeg", "ffprobe"):
        (tmp_path / name).write_text(body)
        os.chmod(tmp_path / name, os.stat(tmp_path / name).st_mode | stat.S_IXUSR)
    return tmp_path


def placed(command, folder):
    """The command with its program in the folder."""
    return F.concat(F.array(F.concat(F.lit(f"{folder}/"), command[0])), F.slice(command, F.lit(2), F.size(command) - 1))


def test_command_columns(spark):
    c = F.lit
    row = spark.range(1).select(
        codecs.keyframe(c("v.mp4"), c(61_005), c("o.jpg")).alias("key"), codecs.keyframe_batch(c("v.mp4"), F.array(c(5), c(1500)), c("_%04d.jpg")).alias("batch"),
        codecs.clip(c("v"), c(1500), c(4000), c("o")).alias("clip"), codecs.scene_log(c("v")).alias("log"), codecs.audio_mp3(c("a"), c("b")).alias("mp3"),
    ).first()
    assert row["key"][2:6] == ["-ss", "61.005", "-i", "v.mp4"] and row["key"][-1] == "o.jpg"
    assert row["batch"][5] == "select='eq(t\\,0.005)+eq(t\\,1.500)'" and row["batch"][-1] == "_%04d.jpg"
    assert row["clip"][3] == "1.5" and row["clip"][7] == "2.5" and row["log"][4] == "select='gt(scene,0.3)',showinfo" and "64k" in row["mp3"]


def test_commands_run_and_fail_by_row(spark, programs):
    rows = spark.createDataFrame([("a", "a.mp4"), ("b", "bad.mp4")], "video_id string, path string")
    done = codecs.run_commands(rows.withColumn("command", placed(codecs.duration(F.col("path")), programs)))
    got = {r["video_id"]: (r["status"], r["ms"]) for r in done.withColumn("ms", codecs.duration_ms(F.col("stdout"))).collect()}
    assert got == {"a": (0, 12345), "b": (3, None)}
    done = codecs.run_commands(rows.withColumn("command", placed(codecs.scene_log(F.col("path")), programs)))
    assert [tuple(r) for r in signals.cuts_from_log(codecs.log_lines(done)).collect()] == [("a", 4500)]
    gone = codecs.run_commands(rows.limit(1).withColumn("command", F.array(F.lit("/no/such/program")))).first()
    assert gone["status"] is None and "FileNotFoundError" in gone["stderr"]
    late = codecs.run_commands(rows.limit(1).withColumn("command", F.array(F.lit("sleep"), F.lit("5"))), timeout_s=0.2).first()
    assert late["status"] is None and "Timeout" in late["stderr"]


def test_keyframes_fall_back_to_single_commands(spark, programs, tmp_path):
    plan = spark.createDataFrame([("v", "v_1", 10), ("bad", "b_1", 10), ("bad", "b_bad", 20)], "video_id string, scene_id string, ms bigint")
    plan = plan.withColumn("path", F.concat(F.lit(f"{tmp_path}/"), F.col("scene_id"), F.lit(".jpg")))
    batch = plan.groupBy("video_id").agg(F.array_sort(F.collect_list("ms")).alias("times"))
    batch = codecs.run_commands(batch.withColumn("command", placed(codecs.keyframe_batch(F.col("video_id"), F.col("times"), F.lit("_%04d.jpg")), programs)))
    single = codecs.run_commands(plan.withColumn("command", placed(codecs.keyframe(F.lit("v"), F.col("ms"), F.col("path")), programs)))
    got = {r["scene_id"]: r["keyframe_path"] for r in codecs.keyframe_results(plan, batch, single).collect()}
    assert got["v_1"] and got["b_1"] and got["b_bad"] is None and os.path.exists(got["b_1"])


def test_command_line_with_a_video(spark, programs, monkeypatch):
    monkeypatch.setattr(codecs, "duration", lambda p, f=codecs.duration: placed(f(p), programs))
    monkeypatch.setattr(codecs, "scene_log", lambda p, t=0.3, f=codecs.scene_log: placed(f(p, t), programs))
    assert cli.main(["scenes", "detect", "--video-id", "v", "--video", "v.mp4", "--out", str(programs / "o.json")]) == 0
    assert '"end_ms":12345' in (programs / "o.json").read_text()
    with pytest.raises(RuntimeError, match="broken"):
        cli.main(["scenes", "detect", "--video-id", "v", "--video", "bad.mp4", "--out", str(programs / "o.json")])


def test_frames_and_writer(monkeypatch):
    class Capture:
        def __init__(self, path):
            self.left = 3

        def read(self):
            self.left -= 1
            return self.left >= 0, f"frame{2 - self.left}"

        def set(self, what, ms):
            self.left = 1 if ms < 5000 else 0

        def release(self):
            pass

    class Writer:
        def __init__(self, path, codec, fps, size):
            self.codec = codec

        def isOpened(self):
            return self.codec == "avc1"

        def release(self):
            pass

    cv2 = types.SimpleNamespace(VideoCapture=Capture, VideoWriter=Writer, VideoWriter_fourcc=lambda *c: "".join(c), CAP_PROP_POS_MSEC=0)
    monkeypatch.setitem(sys.modules, "cv2", cv2)
    assert [n for n, _ in codecs.read_frames("v")] == [0, 1, 2]
    assert [x is None for x in codecs.frames_at("v", [1.0, 9.0])] == [False, True]
    assert codecs.open_writer("o", 30.0, 4, 4).codec == "avc1"
    monkeypatch.setattr(codecs, "WRITER_CODECS", ("mp4v",))
    with pytest.raises(RuntimeError):
        codecs.open_writer("o", 30.0, 4, 4)
