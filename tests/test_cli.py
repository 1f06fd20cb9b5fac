"""The commands on record files, the sinks and sources behind them, and the engines' adapters."""

import http.server
import json
import sys
import threading
import types

import pytest
from pyspark.sql import functions as F

from cinelake import cli
from cinelake.functions import geometry
from cinelake.operators import adapters, blur, models, records, scenes
from cinelake.sources import io


@pytest.fixture
def files(tmp_path):
    (tmp_path / "v.log").write_text("[Parsed_showinfo_1] pts_time:20.0\n[Parsed_showinfo_1] pts_time:20.2\n[Parsed_showinfo_1] pts_time:90\n")
    said = [{"start": 1, "end": 3, "text": "hello there"}, {"start": 5, "end": 9, "text": "buy now", "speaker_id": "A"}, {"start": 21, "end": 30, "text": " "}]
    (tmp_path / "speech.json").write_text(json.dumps({"video_id": "v", "segments": said}))
    (tmp_path / "words.json").write_text(json.dumps({"cta": ["buy"], "greeting": ["hello"]}))
    blocks = [{"scene_id": "v_scene_000", "ord": 0, "text": "CALL 010-1234-5678", "confidence": 0.9}, {"scene_id": "v_scene_000", "ord": 1, "text": "no", "confidence": 0.1}]
    (tmp_path / "blocks.json").write_text("\n".join(map(json.dumps, blocks)))
    return tmp_path


def run(*argv):
    assert cli.main([str(a) for a in argv]) == 0


def test_scene_commands(spark, files):
    base = ["--video-id", "v", "--cuts", files / "v.log", "--duration-ms", 100_000]
    run("scenes", "detect", *base, "--out", files / "scenes.json")
    told = json.loads((files / "scenes.json").read_text())
    assert [(s["start_ms"], s["end_ms"]) for s in told["scenes"]] == [(0, 20_000), (20_000, 65_000), (65_000, 90_000), (90_000, 100_000)]
    run("scenes", "assemble", "--video-id", "v", "--boundaries-json", files / "scenes.json", "--speech-result", files / "speech.json", "--dictionary", files / "words.json", "--out", files / "docs.json")
    docs = json.loads((files / "docs.json").read_text())["scenes"]
    assert docs[0]["transcript_raw"] == "hello there buy now" and docs[0]["keyword_tags"] == ["cta", "greeting"] and len(docs) == 4
    run("scenes", "pipeline", *base, "--speech-result", files / "speech.json", "--ocr-blocks", files / "blocks.json", "--redact-pii", "--out", files / "all.json")
    first = json.loads((files / "all.json").read_text())["scenes"][0]
    assert first["ocr_text_raw"] == "CALL [KR_PHONE]" and first["transcript_norm"].startswith("hello")
    with pytest.raises(ValueError, match="Unknown preset"):
        cli.main([str(x) for x in ("scenes", "pipeline", *base, "--split-preset", "x", "--out", files / "n.json")])


def test_speech_commands(spark, files):
    run("speech", "transcribe", "--video-id", "v", "--segments", files / "speech.json", "--out", files / "t.json")
    told = json.loads((files / "t.json").read_text())
    assert told["num_segments"] == 2 and told["total_duration_s"] == 9.0 and [s["text"] for s in told["segments"]] == ["hello there", "buy now"]
    run("speech", "pipeline", "--video-id", "v", "--segments", files / "speech.json", "--dictionary", files / "words.json", "--transcript", files / "transcript.json", "--out", files / "r.json")
    told = json.loads((files / "r.json").read_text())
    assert told["status"] == "success" and told["total_duration"] == 6.0 and [s["text"] for s in told["segments"]] == ["hello there", "buy now"]
    assert json.loads((files / "transcript.json").read_text())["total_segments"] == 2
    run("speech", "pipeline", "--video-id", "v", "--segments", files / "none.json", "--out", files / "r.json")
    assert json.loads((files / "r.json").read_text())["error"] == "no speech detected"


def test_ocr_blur_faces_commands(spark, files):
    run("scenes", "detect", "--video-id", "v", "--cuts", files / "v.log", "--duration-ms", 100_000, "--out", files / "scenes.json")
    run("ocr", "pipeline", "--video-id", "v", "--scenes-result", files / "scenes.json", "--ocr-blocks", files / "blocks.json", "--out", files / "o.json")
    told = json.loads((files / "o.json").read_text())
    assert (told["frames_processed"], told["frames_skipped"], told["avg_confidence"]) == (1, 3, 0.9) and told["scenes"][0]["ocr_text_raw"] == "CALL 010-1234-5678"
    found = [{"video_id": "v", "frame_idx": i, "label": " Passport", "confidence": 0.87654, "bbox_norm": [0.1, 0.2, 0.3, 0.4]} for i in range(7)]
    (files / "d.json").write_text("\n".join(map(json.dumps, found)))
    run("blur", "process", "--video-id", "v", "--detections", files / "d.json", "--frames", 100, "--fps", 29.97, "--manifest", files / "m.json")
    told = json.loads((files / "m.json").read_text())
    assert told["summary"] == {"card_object": 2} and [d["frame_idx"] for d in told["detections"]] == [0, 5] and told["avg_fps"] == 29.97 and told["infer_calls"] == 20
    with pytest.raises(ValueError):
        cli.main([str(x) for x in ("blur", "process", "--video-id", "v", "--detections", files / "d.json", "--frames", 9, "--categories", "nope", "--manifest", files / "m.json")])
    (files / "e.json").write_text("\n".join(json.dumps({"image_path": f"{i}.jpg", "embedding": [1.0, float(i)]}) for i in range(3)))
    run("faces", "register", "--identity-id", "p", "--embeddings", files / "e.json", "--top", 2, "--out", files / "p.json")
    told = json.loads((files / "p.json").read_text())
    assert told["embedding_dim"] == 2 and told["intra_class"]["count"] == 3 and len(told["exemplars"]) == 2 and len(told["sources"]) == 3


def test_face_and_ocr_models_by_name(spark, files, monkeypatch):
    pictures = files / "pics"
    pictures.mkdir()
    for name in ("b.jpg", "a.PNG", "bad.jpg"):
        (pictures / name).write_bytes(b"x")
    face = {"x": 1, "y": 1, "w": 50, "h": 50, "det_conf": 0.9}

    def detector():
        def one(path):
            if "bad" in path:
                raise OSError("unreadable")
            return [face, {**face, "w": 3}]

        return lambda paths: [one(p) for p in paths]

    for kind, factory in (("face_detector", detector), ("face_embedder", lambda: lambda xs: [[1.0, 0.0] for _ in xs]), ("ocr", lambda: lambda xs: [[{"text": "hi", "confidence": 0.5}] for _ in xs])):
        monkeypatch.setitem(models._REGISTRY, (kind, "own"), (factory, ()))
    monkeypatch.setattr(models, "create", lambda kind, name, **o: models_registry[kind]())
    models_registry = {k: f for (k, n), (f, _) in models._REGISTRY.items() if n == "own"}
    pictures_df = io.list_pictures(spark, str(pictures)).select("path")
    found = io.with_boxes(pictures_df, pictures_df.where("path like '%b.jpg'").withColumn("bboxes", F.array(F.lit(1))))
    assert sorted(len(r["bboxes"]) for r in found.collect()) == [0, 0, 1]  # unreadable pictures stay


def test_composition_and_doctor(spark, files, capsys):
    for name in ("a.mkv", "a.mov", "b.avi"):
        (files / name).write_bytes(b"x")
    clips = [{"scene_id": "s", "video_id": v, "start_ms": 0, "end_ms": 1000, "timeline_start_ms": 1000 * i} for i, v in enumerate(("a", "b"))]
    (files / "spec.json").write_text(json.dumps({"spec_id": "x", "scene_clips": clips, "subtitles": [{"text": "t", "start_ms": 0, "end_ms": 5}], "overlays": []}))
    run("composition", "render", "--spec", files / "spec.json", "--media-dir", files, "--out", files / "plan.json")
    told = json.loads((files / "plan.json").read_text())
    assert [c["path"].rsplit("/", 1)[1] for c in told["clips"]] == ["a.mov", "b.avi"] and told["output_label"] == "final" and told["clips"][1]["timeline_end_ms"] == 2000
    capsys.readouterr()
    run("doctor", "--json")
    told = json.loads(capsys.readouterr().out)
    assert told["dependencies"]["pyspark"] and told["summary"]["total"] == len(told["dependencies"])


def test_sources_of_pictures_and_media(spark, files):
    for name in ("c.jpg", "a.jpg", "n.txt"):
        (files / name).write_bytes(b"x")
    listed = f"file:{files}/a.jpg"
    got = [r["path"] for r in io.reference_pictures(spark, ["z.jpg", listed, "", "z.jpg"], str(files)).orderBy("ord").collect()]
    assert got == ["z.jpg", listed, f"file:{files}/c.jpg"]
    sc = spark.createDataFrame([("v_scene_000",), ("v_scene_001",), ("v_scene_002",)], "scene_id string")
    pics = spark.createDataFrame([("/k/v_scene_000.jpg", 10, 100, 100), ("/k/v_scene_001.jpg", 10, 1, 9000)], "path string, size bigint, width int, height int")
    assert {r["scene_id"]: r["keyframe_valid"] for r in io.valid_keyframes(sc, pics).collect()} == {"v_scene_000": True, "v_scene_001": False, "v_scene_002": False}


def test_documents_per_key(spark, tmp_path):
    rows = spark.createDataFrame([("v1", 1.0, 2.0, "a"), ("v1", 0.0, 1.0, "b"), ("v 2/x", 0.0, 5.0, "c")], "video_id string, start double, end double, text string")
    io.write_files(records.transcript_documents(rows.where("video_id != 'v 2/x'").unionByName(rows.where("video_id = 'v 2/x'").withColumn("video_id", F.lit("v 2")))), str(tmp_path / "out"), "video_id")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".json") == ["v 2.json", "v1.json"]
    told = json.loads((tmp_path / "out/v1.json").read_text())
    assert [s["text"] for s in told["segments"]] == ["b", "a"] and told["total_duration_s"] == 2.0 and told["total_segments"] == 2
    perf = records.perf_rows(spark.createDataFrame([("r", "load", 1.23456), ("r", "infer", 2.0), ("r", "infer", 1.0)], "run string, stage string, seconds double")).first()
    assert perf["stages"] == {"infer": 3.0, "load": 1.235} and perf["total_s"] == 4.235


def test_statuses_and_counters(spark):
    segs = spark.createDataFrame([("a", 0.0, 2.0), ("a", 3.0, 4.0)], "video_id string, start double, end double")
    runs = spark.createDataFrame([("a", None), ("b", None), ("c", "file not found")], "video_id string, error string")
    got = {r["video_id"]: (r["status"], r["error"], r["total_duration"]) for r in records.run_results(segs, runs).collect()}
    assert got == {"a": ("success", None, 3.0), "b": ("success", "no speech detected", 0.0), "c": ("error", "file not found", 0.0)}
    frames = spark.createDataFrame([("v", i, 2.0, "boom" if i == 5 else None) for i in range(11)], "video_id string, frame_idx bigint, infer_ms double, error string")
    r = blur.inference_counters(frames, 5).first()
    assert (r["infer_calls"], r["failed_calls"], r["infer_ms"]) == (3, 1, 6.0)
    with pytest.raises(ValueError):
        blur.validate(["face"], 1, 0.5, masks=True)
    with pytest.raises(ValueError):
        blur.validate(["face"], 1, 0.5, min_face_confidence=2)


def test_geometry_of_shrinks_durations_and_overlays(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    c = lambda *xs: [F.lit(x) for x in xs]
    assert tuple(one(geometry.shrink_pixels(*c(10, 20, 30, 6), 4))) == (14, 24, 22, -2)
    assert one(geometry.duration_seconds(*c(300, 30.0))) == 10.0 and one(geometry.duration_seconds(*c(0, 30.0))) == 0.0
    box = one(geometry.overlay_layout(F.lit("a\nb"), F.array(F.lit(40), F.lit(60)), F.lit(20), F.lit(1.25), F.lit(5), geometry.shadow_padding(*c(2, -3, 4, 1)), F.lit(6)))
    assert (box["row_advance"], box["width"], box["height"], box["origin"]) == (25, 60 + 10 + 36, 50 + 10 + 36, 23) and box["highlight_box"] == [18, 18, 88, 78]


def test_many_cuts_in_one_recording(spark):
    cuts = spark.range(100_000).agg(F.collect_list(F.col("id") * 300 + 1).alias("cuts"))
    kept = cuts.select(scenes.min_gap(F.col("cuts"), F.lit(40_000_000), 500).alias("k")).first()["k"]
    want = [0]
    for i in range(100_000):
        if i * 300 + 1 - want[-1] >= 500:
            want.append(i * 300 + 1)
    assert kept == [*want, 40_000_000]


def test_engines_behind_their_adapters(monkeypatch):
    class Segment(types.SimpleNamespace):
        pass

    class WhisperModel:
        def __init__(self, model, device, compute_type):
            pass

        def transcribe(self, path, language, beam_size):
            return [Segment(start=0.00049, end=1.5, text=" hi ", avg_logprob=0.0), Segment(start=2, end=3, text="  ", avg_logprob=-1)], None

    monkeypatch.setitem(sys.modules, "faster_whisper", types.SimpleNamespace(WhisperModel=WhisperModel))
    assert adapters.faster_whisper()(["a.wav"]) == [[{"start": 0.0, "end": 1.5, "text": "hi", "confidence": 1.0}]]

    class PaddleOCR:
        def __init__(self, **options):
            pass

        def ocr(self, path):
            return [[([[0, 0], [4, 0], [4, 2], [0, 2]], ("sign", 0.9))]] if path == "a" else None

    monkeypatch.setitem(sys.modules, "paddleocr", types.SimpleNamespace(PaddleOCR=PaddleOCR))
    assert [len(x) for x in adapters.paddle()(["a", "b"])] == [1, 0]
    for kind, name in (("stt", "whisper"), ("diarizer", "pyannote"), ("object_detector", "owlv2"), ("image_embedder", "siglip2")):
        if models.missing(models._REGISTRY[kind, name][1]):
            with pytest.raises(ImportError):
                models.create(kind, name)
    assert not any(f is models.stub_caption for (_, name), (f, _) in models._REGISTRY.items() if name != "stub")
    models.check_ocr_version("2.7.3")
    with pytest.raises(RuntimeError):
        models.check_ocr_version("1.9")
    assert models.choose_face_detector("haar") == "haar"


def test_http_captions_retry_and_break():
    answers = [500, 200, 404, 404, 404, 404, 404, 200]
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            told = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append(told["messages"][0]["content"][0]["text"])
            status = answers.pop(0)
            body = json.dumps({"choices": [{"message": {"content": "a caption"}}]}).encode() if status == 200 else b""
            self.send_response(status)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    now, waits = [0.0], []
    client = adapters.HttpCaptions(f"http://127.0.0.1:{server.server_port}", prompt="say", clock=lambda: now[0], sleep=waits.append)
    try:
        assert client.caption(b"x") == "a caption" and waits == [2.0]
        assert [client.caption(b"x") for _ in range(5)] == [None] * 5 and len(seen) == 7
        assert client.caption(b"x") is None and len(seen) == 7  # open: no call
        now[0] = 61.0
        assert client.caption(b"x") == "a caption" and len(seen) == 8 and set(seen) == {"say"}
    finally:
        server.shutdown()
