"""Commands over record files: ``python -m cinelake <group> <command>``.

Inputs are the files that decoders and models leave (logs of the scene filter, speech and OCR results, detections, specs); the
commands run the operators on them and write one document. Commands that need a model take any registered one by name.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions import text
from cinelake.operators import blur, codecs, faces, models, records, scenes, signals, transcode
from cinelake.sources import io

VERSION = "1.0"
MODULES = ("cv2", "insightface", "onnxruntime", "whisper", "faster_whisper", "torch", "openai", "paddleocr", "pyspark", "pyarrow")
PROGRAMS = ("ffmpeg", "ffprobe")


def _spark() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.appName("cinelake").getOrCreate()


def _write(args: argparse.Namespace, began: float, **parts: F.Column | DataFrame | object) -> None:
    """One document of the parts: columns of literals, and tables as lists in their own order."""
    spark = _spark()
    out = spark.range(1).select(F.lit(VERSION).alias("schema_version"))
    for name, part in parts.items():
        if isinstance(part, DataFrame):
            rows = part.agg(F.array_sort(F.collect_list(F.struct(*part.columns))).alias(name))
            out = out.join(rows, how="cross")  # one row each
        else:
            out = out.withColumn(name, F.lit(part))
    out = out.withColumn("timing_s", F.lit(round(time.time() - began, 3)))
    io.write_document(out.select(F.to_json(F.struct(*out.columns)).alias("document")), args.out)
    print(f"Wrote {args.out}")


def doctor(args: argparse.Namespace) -> int:
    """Which modules and programs are there, and which flows they allow."""
    found = models.dependencies(MODULES, PROGRAMS)
    try:
        backend = models.choose_stt()
    except ImportError:
        backend = "none"
    told = {
        "python": sys.version, "dependencies": found, "speech_backend": backend,
        "flows": {"speech": backend != "none" and found["ffmpeg"], "faces": found["cv2"], "scenes": found["ffmpeg"], "ocr": found["paddleocr"]},
        "summary": {"available": sum(found.values()), "total": len(found), "all_ok": all(found.values())},
    }
    if args.out:
        with open(args.out, "w") as f:
            json.dump(told, f, indent=2)
    if args.json:
        print(json.dumps(told, indent=2))
    elif not args.out:
        for name, ok in found.items():
            print(f"  {name:15} [{'OK' if ok else 'MISSING'}]")
        print(f"  {told['summary']['available']}/{len(found)} available, speech backend: {backend}")
    return 0 if args.json or args.out or told["summary"]["all_ok"] else 1


def _ran(args: argparse.Namespace, command) -> DataFrame:
    """The one command's result; its failure ends the run."""
    rows = _spark().createDataFrame([(args.video_id, args.video)], "video_id string, path string")
    done = codecs.run_commands(rows.withColumn("command", command(F.col("path"))))
    told = done.first()
    if told["status"] != 0:
        raise RuntimeError(f"{told['command'][0]} failed: {told['stderr'].strip()}")
    return _spark().createDataFrame([told], done.schema)


def _totals(args: argparse.Namespace) -> DataFrame:
    if args.duration_ms is None:
        return _ran(args, codecs.duration).select("video_id", codecs.duration_ms(F.col("stdout")).alias("total_ms"))
    return _spark().createDataFrame([(args.video_id, args.duration_ms)], "video_id string, total_ms bigint")


def _cuts(args: argparse.Namespace) -> DataFrame:
    if args.cuts is None:
        return signals.cuts_from_log(codecs.log_lines(_ran(args, lambda p: codecs.scene_log(p, args.threshold))))
    return signals.cuts_from_log(io.read_log(_spark(), args.cuts)).select(F.lit(args.video_id).alias("video_id"), "cut_ms")


def _speech(args: argparse.Namespace) -> DataFrame:
    rows = io.read_speech(_spark(), args.speech_result) if args.speech_result else io.read_speech(_spark(), "/nonexistent.json")
    return rows.withColumn("video_id", F.lit(args.video_id))


def scenes_detect(args: argparse.Namespace) -> int:
    began = time.time()
    found = signals.combine_signals(_cuts(args), _no_signals(), _totals(args), 0, args.min_ms, args.max_ms)
    _write(args, began, video_id=args.video_id, scenes=_ordered(scenes.scene_rows(found)))
    return 0


def _no_signals() -> DataFrame:
    return _spark().createDataFrame([], "video_id string, timestamp_ms bigint, strength double, source string")


def _ordered(rows: DataFrame) -> DataFrame:
    first = [c for c in ("index", "ord") if c in rows.columns]
    return rows.select(*first, *(c for c in rows.columns if c not in first))


def _dictionary(path: str | None) -> dict[str, list[str]]:
    if path is None:
        return {}
    with open(path) as f:
        return {str(k): [str(x) for x in v] for k, v in json.load(f).items()}


def scenes_assemble(args: argparse.Namespace) -> int:
    began = time.time()
    found = io.read_scenes(_spark(), args.boundaries_json).withColumn("video_id", F.lit(args.video_id))
    _write(args, began, video_id=args.video_id, scenes=_ordered(scenes.scene_documents(found, _speech(args), _dictionary(args.dictionary))))
    return 0


def scenes_pipeline(args: argparse.Namespace) -> int:
    began = time.time()
    speech = _speech(args)
    target = args.split_target_duration_ms or scenes.resolve_preset(args.split_preset)
    found = _no_signals() if target is None else signals.speech_pauses(speech).unionByName(signals.speaker_turns(speech))
    bounds = signals.combine_signals(_cuts(args), found, _totals(args), target or 0)
    documents = scenes.scene_documents(scenes.scene_rows(bounds), speech, _dictionary(args.dictionary))
    if args.ocr_blocks:
        documents = scenes.merge_ocr(documents, _ocr(args))
    _write(args, began, video_id=args.video_id, scenes=_ordered(documents))
    return 0


def _ocr(args: argparse.Namespace) -> DataFrame:
    blocks = _spark().read.schema("scene_id string, ord bigint, text string, confidence double").json(args.ocr_blocks)
    return records.ocr_scene_text(blocks, redact=args.redact_pii)


def _transcribed(args: argparse.Namespace) -> DataFrame:
    if args.segments:
        return io.read_speech(_spark(), args.segments).withColumn("video_id", F.lit(args.video_id))
    spark, name = _spark(), models.choose_stt(args.backend)
    item = "array<struct<start:double,end:double,text:string,confidence:double>>"
    audio = spark.createDataFrame([(args.video_id, args.audio)], "video_id string, audio string")
    options = {"model": args.model} if args.model else {}
    done = models.apply_model(audio, "stt", name, "audio", item, **options)
    return done.select("video_id", F.posexplode("result").alias("ord", "s")).select("video_id", F.col("ord").cast("long"), "s.*", F.lit(None).cast("string").alias("speaker_id"))


def speech_transcribe(args: argparse.Namespace) -> int:
    began = time.time()
    rows = records.clean_segments(_transcribed(args))
    head = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("end"), F.lit(0.0)).alias("last")).first()
    _write(args, began, video_id=args.video_id, num_segments=head["n"], total_duration_s=head["last"], segments=_ordered(rows))
    return 0


def speech_pipeline(args: argparse.Namespace) -> int:
    began = time.time()
    rows = records.clean_segments(_transcribed(args))
    if args.transcript:
        io.write_document(records.transcript_documents(rows).select("document"), args.transcript)
    ranked = records.rank_segments(rows, _dictionary(args.dictionary), {})
    run = records.run_results(rows, _spark().createDataFrame([(args.video_id, None)], "video_id string, error string")).first()
    order = ranked.select(F.bround(-F.col("score"), 6).alias("order"), *ranked.columns)
    _write(args, began, video_id=args.video_id, status=run["status"], error=run["error"], total_duration=run["total_duration"], segments=order)
    return 0


def faces_detect(args: argparse.Namespace) -> int:
    pictures = io.list_pictures(_spark(), args.pictures).select(F.regexp_replace("path", "^file:", "").alias("path"))
    box = "array<struct<x:int,y:int,w:int,h:int,det_conf:double>>"
    done = models.apply_model(pictures, "face_detector", args.detector, "path", box)
    found = io.with_boxes(pictures, done.where("result is not null").select("path", F.col("result").alias("bboxes")))
    rows = faces.keep_faces(found.select(F.lit(args.video_id).alias("video_id"), F.col("path").alias("image_path"), "bboxes"), args.min_size, args.min_confidence)
    io.write_lines(rows, args.out)
    print(f"Wrote {args.out}")
    return 0


def faces_embed(args: argparse.Namespace) -> int:
    found = io.read_face_lines(_spark(), args.detections)
    each = found.select("video_id", "image_path", F.posexplode("bboxes").alias("ord", "box"))
    done = models.apply_model(each, "face_embedder", args.embedder, "image_path", "array<double>")
    io.write_lines(done.where("result is not null").withColumnRenamed("result", "embedding").drop("error"), args.out)
    print(f"Wrote {args.out}")
    return 0


def faces_register(args: argparse.Namespace) -> int:
    rows = _spark().read.schema("image_path string, embedding array<double>").json(args.embeddings).withColumn("identity_id", F.lit(args.identity_id))
    io.write_document(faces.identity_documents(rows, args.top), args.out)
    print(f"Wrote {args.out}")
    return 0


def ocr_pipeline(args: argparse.Namespace) -> int:
    began = time.time()
    wanted = io.read_scenes(_spark(), args.scenes_result).select("scene_id", "keyframe_timestamp_ms")
    texts = wanted.join(_ocr(args), "scene_id", "left")
    for name, empty in (("ocr_text_raw", ""), ("ocr_char_count", 0), ("avg_confidence", 0.0), ("n_blocks", 0)):
        texts = texts.withColumn(name, F.coalesce(name, F.lit(empty)))
    head = records.ocr_counters(texts.withColumn("video_id", F.lit(args.video_id))).first()
    counters = {k: head[k] for k in ("frames_processed", "frames_skipped", "avg_confidence", "status")} if head else {"status": "success"}
    _write(args, began, video_id=args.video_id, **counters, scenes=texts)
    return 0


def ocr_extract(args: argparse.Namespace) -> int:
    began = time.time()
    picture = _spark().createDataFrame([(args.image,)], "path string")
    done = models.apply_model(picture, "ocr", args.engine, "path", "array<struct<text:string,confidence:double>>")
    blocks = done.select(F.posexplode("result").alias("ord", "b")).select("ord", "b.*")
    _write(args, began, image=args.image, blocks=blocks)
    return 0


def blur_process(args: argparse.Namespace) -> int:
    categories = tuple(x.strip() for x in args.categories.split(",") if x.strip())
    blur.validate(categories, args.stride, args.threshold, args.min_face_confidence)
    schema = "video_id string, frame_idx bigint, label string, confidence double, bbox_norm array<double>"
    found = _spark().read.schema(schema).json(args.detections)
    custom = tuple(x.strip() for x in (args.custom_queries or "").split(",") if x.strip())
    found = found.withColumn("category", F.when(F.lower(text.strip(F.col("label"))) == "face", "face").otherwise(blur.label_category(F.col("label"))))
    fresh = blur.fresh_detections(found, args.stride, args.threshold).where(F.col("category").isin(*categories, *(["object"] if custom else [])))
    head = [(args.video_id, args.frames, args.fps, args.frames * 1000.0 / args.fps, 0.0, -(-args.frames // args.stride))]
    runs = _spark().createDataFrame(head, "video_id string, frame_count bigint, fps double, total_ms double, infer_ms double, infer_calls bigint")
    io.write_document(blur.manifest_documents(fresh.where(F.col("video_id") == args.video_id), runs).select("document"), args.manifest)
    print(f"Wrote {args.manifest}")
    return 0


def composition_render(args: argparse.Namespace) -> int:
    began = time.time()
    spec = io.read_composition(_spark(), args.spec)
    clips = transcode.timeline(spec)
    clips = transcode.media_paths(clips, io.list_media(_spark(), args.media_dir)).select("clip_idx", "video_id", "path", "start_ms", "end_ms", "timeline_start_ms", "timeline_end_ms")
    n_overlays, has_subtitles, n = spec.select(F.coalesce(F.size("overlays"), F.lit(0)), F.coalesce(F.size("subtitles"), F.lit(0)) > 0, F.size("scene_clips")).first()
    route = _spark().range(1).select(transcode.label_route(F.lit(has_subtitles), F.lit(n_overlays), F.lit(str(n)))).first()[0]
    _write(args, began, output_label=route, clips=clips)
    return 0


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cinelake", description=__doc__)
    groups = top.add_subparsers(dest="group", required=True)

    def command(group: argparse._SubParsersAction, name: str, run, *options: tuple[str, dict], out: bool = True) -> None:
        p = group.add_parser(name, help=run.__doc__)
        p.set_defaults(run=run)
        for flag, how in options:
            p.add_argument(flag, **how)
        if out:
            p.add_argument("--out", required=True)

    def group(name: str) -> argparse._SubParsersAction:
        return groups.add_parser(name).add_subparsers(dest="command", required=True)

    must, number, real = {"required": True}, {"type": int}, {"type": float}
    video, blocks = ("--video-id", must), ("--redact-pii", {"action": "store_true"})
    cuts = [video, ("--video", {}), ("--threshold", {**real, "default": 0.3}), ("--cuts", {}), ("--duration-ms", number)]
    speech, words = ("--speech-result", {}), ("--dictionary", {})
    command(groups, "doctor", doctor, ("--json", {"action": "store_true"}), ("--out", {}), out=False)
    g = group("scenes")
    command(g, "detect", scenes_detect, *cuts, ("--min-ms", {**number, "default": 500}), ("--max-ms", {**number, "default": 45_000}))
    command(g, "assemble", scenes_assemble, video, ("--boundaries-json", must), speech, words)
    command(g, "pipeline", scenes_pipeline, *cuts, speech, words, ("--split-preset", {"default": "default"}), ("--split-target-duration-ms", number), ("--ocr-blocks", {}), blocks)
    g = group("speech")
    said = [video, ("--audio", {}), ("--segments", {}), ("--backend", {"default": "auto"}), ("--model", {})]
    command(g, "transcribe", speech_transcribe, *said)
    command(g, "pipeline", speech_pipeline, *said, words, ("--transcript", {}))
    g = group("faces")
    command(g, "detect", faces_detect, video, ("--pictures", must), ("--detector", {"default": "haar"}), ("--min-size", {**number, "default": 40}), ("--min-confidence", {**real, "default": 0.5}))
    command(g, "embed", faces_embed, ("--detections", must), ("--embedder", {"default": "insightface"}))
    command(g, "register", faces_register, ("--identity-id", must), ("--embeddings", must), ("--top", {**number, "default": 5}))
    g = group("ocr")
    command(g, "pipeline", ocr_pipeline, video, ("--scenes-result", must), ("--ocr-blocks", must), blocks)
    command(g, "extract", ocr_extract, ("--image", must), ("--engine", {"default": "paddle"}))
    g = group("blur")
    figures = [("--frames", {**must, **number}), ("--fps", {**real, "default": 30.0}), ("--stride", {**number, "default": 5})]
    limits = [("--threshold", {**real, "default": 0.35}), ("--min-face-confidence", {**real, "default": 0.5})]
    command(g, "process", blur_process, video, ("--detections", must), ("--manifest", must), *figures, *limits,
            ("--categories", {"default": "face,license_plate,card_object"}), ("--custom-queries", {}), out=False)
    command(group("composition"), "render", composition_render, ("--spec", must), ("--media-dir", must))
    return top


def main(argv: Sequence[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if "cuts" in args and args.video is None and (args.cuts is None or args.duration_ms is None):
        parser.error("needs --video, or --cuts and --duration-ms")
    return args.run(args)
