"""Golden cases of the record operators, and order-dependent operators against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelake.functions import geometry, text, vectors
from cinelake.operators import blur, faces, images, models, products, records, scenes, signals, transcode
from cinelake.sources import io
from cinelake.streaming import progress


def one(spark, column, **cols):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items()) or [F.lit(1)])
    return df.select(column.alias("v")).first()["v"]


def seg(spark, rows):
    full = [(1, i, float(r[0]), float(r[1]), r[2] if len(r) > 2 else None, f"t{i}") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "video_id bigint, ord bigint, start double, end double, speaker_id string, text string")


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(0, 5), (6, 10)], [(5500, 0.5)]), ([(0, 5), (5.1, 10)], []), ([(0, 5), (5.3, 10)], [(5150, 0.15)]),
        ([(0, 5), (7, 10)], [(6000, 1.0)]), ([(0, 5), (6, 10), (12, 15)], [(5500, 0.5), (11000, 1.0)]),
        ([(6, 10), (0, 5)], [(5500, 0.5)]), ([(0, 5), (4, 10)], []), ([(0, 5)], []),
    ],
)
def test_pauses(spark, rows, want):
    got = signals.speech_pauses(seg(spark, rows)).orderBy("timestamp_ms").collect()
    assert [(r["timestamp_ms"], r["strength"]) for r in got] == want


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(0, 5, "A"), (5.5, 10, "B")], [(5250, 1.0)]), ([(0, 5.5, "A"), (5, 10, "B")], [(5000, 0.7)]),
        ([(0, 3, None), (3, 5, "A"), (6, 10, "B")], [(5500, 1.0)]), ([(0, 5, "A"), (7, 10, "B")], [(6000, 1.0)]),
        ([(0, 5, "A"), (6, 10, "A")], []),
    ],
)
def test_turns(spark, rows, want):
    got = signals.speaker_turns(seg(spark, rows)).collect()
    assert [(r["timestamp_ms"], r["strength"]) for r in got] == want


@pytest.mark.parametrize(
    "segments, turns, want",
    [
        ([(0, 1), (2, 3)], [], [None, None]), ([(0, 1), (2, 3)], [(0, 1.5, "A"), (1.5, 3.5, "B")], ["A", "B"]),
        ([(0.5, 2.5)], [(0, 1, "A"), (1, 3, "B")], ["B"]), ([(1, 2)], [(0, 1.5, "A"), (1.5, 3, "B")], ["A"]),
        ([(5, 6)], [(0, 1, "A")], [None]), ([(1, 2)], [(0, 1, "A"), (1, 3, "B")], ["B"]),
        ([(0.5, 1.5), (1.5, 2.5)], [(0, 1, "A"), (0.8, 2, "B"), (1.8, 3, "C")], ["B", "C"]),
    ],
)
def test_attribution(spark, segments, turns, want):
    t = seg(spark, turns) if turns else seg(spark, [(0, 1, "A")]).limit(0)
    got = signals.attribute_speakers(seg(spark, segments), t).orderBy("ord").collect()
    assert [r["speaker_id"] for r in got] == want


def loop_boundaries(cuts, total, low, high):
    kept = [0]
    for c in sorted({c for c in cuts if 0 < c < total}):
        if c - kept[-1] >= low:
            kept.append(c)
    kept.append(total)
    out = [kept[0]]
    for a, b in zip(kept, kept[1:]):
        while high > 0 and b - a > high:
            a += high
            out.append(a)
        out.append(b)
    return out


def test_boundaries_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(200_000) for _ in range(rng.randint(0, 30))], rng.choice((30_500, 60_000, 120_000, 180_000)), ) for i in range(60)]
    df = spark.createDataFrame(rows, "video_id bigint, cuts array<bigint>, total bigint")
    for low, high in ((500, 45_000), (5_000, 60_000), (500, 0)):
        got = df.select("video_id", scenes.boundaries(F.col("cuts"), F.col("total"), low, high).alias("b")).collect()
        assert {r["video_id"]: r["b"] for r in got} == {i: loop_boundaries(c, t, low, high) for i, c, t in rows}


def test_scene_rows(spark):
    df = spark.createDataFrame([(1, 30_500, [0, 5000, 12_000, 22_000, 30_500]), (2, 5000, [0, 4500, 5000]), (3, 0, [0])], "video_id bigint, total_ms bigint, boundaries array<bigint>")
    got = [(r["scene_id"], r["start_ms"], r["end_ms"], r["keyframe_timestamp_ms"]) for r in scenes.scene_rows(df).orderBy("scene_id").collect()]
    assert got[0] == ("1_scene_000", 0, 5000, 2500) and got[3][2] == 30_500 and got[-1] == ("2_scene_001", 4500, 5000, 4500)
    with pytest.raises(ValueError, match="Unknown preset"):
        scenes.resolve_preset("x")


def test_scene_documents(spark):
    sc = scenes.scene_rows(spark.createDataFrame([(1, 15_000, [0, 5000, 10_000, 15_000]), (2, 5000, [0, 5000])], "video_id bigint, total_ms bigint, boundaries array<bigint>"))
    s = seg(spark, [(0, 2), (2, 4), (6, 9), (10, 12), (12, 14)]).withColumn("text", F.concat(F.lit("Say "), F.col("text")))
    got = {r["scene_id"]: r for r in scenes.scene_documents(sc, s, {"talk": ["say"], "none": ["zzz"]}).collect()}
    assert got["1_scene_000"]["transcript_raw"] == "Say t0 Say t1" and got["1_scene_000"]["transcript_norm"] == "say t0 say t1"
    assert got["1_scene_001"]["speech_segment_count"] == 1 and got["2_scene_000"]["transcript_raw"] == ""
    assert got["1_scene_002"]["keyword_tags"] == ["talk"] and got["2_scene_000"]["keyword_tags"] == []
    split = scenes.scene_documents(sc, s, {"a": ["t0 say"], "b": ["say t1"]}, {"p": ["T0", "zz"], "q": ["say"]}).where("scene_id = '1_scene_000'").first()
    assert split["keyword_tags"] == ["b"] and split["product_tags"] == ["p", "q"] and split["product_entities"] == ["T0", "say"]  # none across segments
    ocr = spark.createDataFrame([("1_scene_000", "sign")], "scene_id string, ocr_text_raw string")
    merged = {r["scene_id"]: r["ocr_char_count"] for r in scenes.merge_ocr(sc, ocr).collect()}
    assert merged["1_scene_000"] == 4 and merged["2_scene_000"] == 0
    assert not scenes.merge_ocr(sc, ocr, max_scenes=2).where("video_id = 1 and ocr_char_count > 0").count()


@pytest.mark.parametrize(
    "raw, want",
    [("a‮b", "ab"), ("<script>x</script>", "x"), ("a & b", "a &amp; b"), ("  it's 　", "it&#x27;s"), ("", "")],
)
def test_sanitize(spark, raw, want):
    assert one(spark, text.sanitize_ocr(F.col("t")), t=raw) == want


@pytest.mark.parametrize(
    "raw, redacted, kinds",
    [
        ("id 900101-1234567.", "id [KR_RRN].", ["kr_rrn"]), ("4111111111111111", "[CREDIT_CARD]", ["credit_card"]),
        ("tel 010-1234-5678", "tel [KR_PHONE]", ["kr_phone"]), ("tel 010.1234.5678", "tel [KR_PHONE]", ["kr_phone"]),
        ("a.b+c@x.co", "[EMAIL]", ["email"]), ("서울12가 3456", "[KR_LICENSE_PLATE]", ["kr_license_plate"]), ("clean", "clean", []),
    ],
)
def test_pii(spark, raw, redacted, kinds):
    assert one(spark, text.redact_pii(F.col("t")), t=raw) == redacted
    found = one(spark, text.find_pii(F.col("t")), t=raw)
    assert [f["category"] for f in found] == kinds and all(raw[f["start"] : f["end"]] == f["match"] for f in found)


@pytest.mark.parametrize(
    "raw, want",
    [
        ('"이 장면은 사람이 걷는다."', "사람이 걷는다"), ("길을 걷는 中国 사람", "길을 걷는 사람"), ("가방 (leather bag) 소개", "가방 소개"),
        ("가방\n- 하나", "가방"), ("가방이다 #tag", "가방이다"), ("**", ""), ("첫 문장입니다. 둘째 문장입니다. 셋", "첫 문장입니다. 둘째 문장입니다."), ("", ""),
    ],
)
def test_caption(spark, raw, want):
    assert one(spark, text.clean_caption(F.col("t")), t=raw) == want


def test_small_text_functions(spark):
    assert one(spark, text.parse_version(F.col("t")), t="v3.10-rc2") == [3, 10, 2] and one(spark, text.parse_version(F.col("t")), t="2") == [2, 0, 0]
    assert one(spark, text.split_options(F.col("t")), t=" a, ,b ") == ["a", "b"]
    assert one(spark, text.hex_to_rgba(F.col("t")), t="#ff8000") == [255, 128, 0, 255]
    assert one(spark, text.keyframe_path("/d/", F.col("t")), t="v_scene_001") == "/d/v_scene_001.jpg"
    assert one(spark, text.keyframe_path("/d/", F.col("t")), t="../x_scene_1") is None
    assert one(spark, text.gate_text(F.col("t")), t="!!") == "" and one(spark, text.gate_text(F.col("t")), t="세럼") == "세럼"
    assert one(spark, text.fuzzy_contains(F.col("t"), F.lit("hello")), t="say HELO now") is True
    assert one(spark, text.fuzzy_contains(F.col("t"), F.lit("hello")), t="zzzz") is False
    assert one(spark, blur.label_category(F.col("t")), t="  Passport ") == "card_object" and one(spark, blur.label_category(F.col("t")), t="x") == "object"
    prompt = one(spark, text.tag_prompt(F.col("t"), F.lit("k"), ["E1", "E2"], ["b", "a"], ["c"]), t="  자막 ")
    assert "What is said:\n자막\n" in prompt and "content: a, b" in prompt and ("E1" in prompt) != ("E2" in prompt)
    assert one(spark, text.tag_prompt(F.col("t"), F.lit("k"), ["E"], [], [], layout="<{transcript}|{example}>"), t=" ") == "<|E>"
    for label in ("\tPassport\n", "　passport "):
        assert one(spark, blur.label_category(F.col("t")), t=label) == "card_object"
    failed = lambda n, s, c, m: one(spark, text.api_error_text(*map(F.lit, (n, s, c, m))))
    assert failed("X", 401, "", "").startswith("authentication") and failed("RateLimitError", 0, "", "").startswith("rate")
    assert "too large" in failed("BadRequestError", 400, "", "over 25 MB") and "size limits" in failed("E", 400, "", "File size") and failed("E", 500, "", "x") == "transcription failed: x"


@pytest.mark.parametrize("raw, want", [("30000/1001", 29.97), ("25/1", 25.0), ("0/0", 0.0), ("", 0.0), ("x/1", 0.0), ("23.976", 23.976), (None, 0.0)])
def test_frame_rate(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "r string")
    assert df.select(transcode.frame_rate(F.col("r"))).first()[0] == want


@pytest.mark.parametrize(
    "codec, height, kbps, should, cap",
    [("h264", 720, 2500, False, False), ("h264", 720, 2501, True, True), ("hevc", 480, 100, True, False), ("h264", 1080, 9000, True, False), ("h264_qsv", 360, 1, False, False)],
)
def test_decision(spark, codec, height, kbps, should, cap):
    d = one(spark, transcode.decision(F.col("c"), F.lit(100), F.col("h"), F.col("k")), c=codec, h=height, k=kbps)
    assert (d["should_transcode"], d["should_cap_bitrate"]) == (should, cap)


def test_probe(spark):
    doc = '{"streams":[{"codec_type":"audio","codec_name":"aac","bit_rate":"128000"},{"codec_type":"video","codec_name":"h264","width":10,"height":20,"r_frame_rate":"25/1"}],"format":{"bit_rate":"1128000","duration":"45.123456"}}'
    r = transcode.parse_probe(spark.createDataFrame([(doc,)], "probe_json string")).first()
    assert (r["bitrate_kbps"], r["duration_ms"], r["has_audio"], r["audio_bitrate_kbps"], r["frame_rate"]) == (1000, 45123, True, 128, 25.0)


def test_geometry(spark):
    c = lambda *xs: [F.lit(x) for x in xs]
    assert one(spark, geometry.iou(*c(0, 0, 10, 10, 5, 0, 15, 10))) == pytest.approx(1 / 3)
    assert one(spark, geometry.centeredness(*c(450, 450, 100, 100, 1000, 1000))) >= 0.99 and one(spark, geometry.centeredness(*c(0, 0, 10, 10, 1000, 1000))) < 0.4
    assert one(spark, geometry.prominence(*c(200, 100, 1000, 1000))) == pytest.approx(0.02)
    assert one(spark, geometry.valid_picture(*c(1, 1920, 1080))) and not one(spark, geometry.valid_picture(*c(1, 2100, 100))) and not one(spark, geometry.valid_picture(*c(1, 6000, 5000)))
    assert tuple(one(spark, geometry.resize_plan(*c(720, 1280)))) == (252, 448)
    assert one(spark, geometry.shrink_norm(F.array(*c(0.1, 0.1, 0.12, 0.5)), F.lit(0.1), F.lit(0.1))) == pytest.approx([0.12, 0.2, 0.1, 0.4])
    assert one(spark, geometry.blur_kernel(*c(10, 10))) == 31 and one(spark, geometry.blur_kernel(*c(100, 10))) == 41
    assert one(spark, vectors.cosine(F.array(*c(1.0, 0.0)), F.array(*c(0.0, 0.0)))) == 0


def loop_clusters(vecs, frames, threshold):
    groups, out = [], []
    for v, f in zip(vecs, frames):
        best, at = -1.0, None
        for k, (members, held, centre) in enumerate(groups):
            s = float(v @ centre / (np.linalg.norm(v) * np.linalg.norm(centre)))
            if f not in held and s >= threshold and s >= best:
                best, at = s, k
        if at is None:
            groups.append([[v], {f}, v])
            at = len(groups) - 1
        else:
            groups[at][0].append(v)
            groups[at][1].add(f)
            m = np.mean(groups[at][0], axis=0)
            groups[at][2] = m / np.linalg.norm(m)
        out.append(at)
    return out


def test_clusters_against_a_loop(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 8))
    vecs = base[rng.integers(0, 6, 80)] + 0.3 * rng.standard_normal((80, 8))
    frames = [f"f{i // 3}" for i in range(80)]
    rows = [(1, i, f, v.tolist()) for i, (v, f) in enumerate(zip(vecs, frames))]
    df = spark.createDataFrame(rows, "video_id bigint, ord bigint, frame_key string, embedding array<double>")
    got = [r["cluster_id"] for r in products.cluster_detections(df, 0.85).orderBy("ord").collect()]
    assert got == loop_clusters(vecs, frames, 0.85)


def test_subsample_against_a_loop(spark):
    for n, most in ((30, 5), (60, 60), (61, 60), (7, 3), (200, 60)):
        df = spark.range(n).select(F.lit(1).alias("video_id"), F.col("id").alias("ord"))
        got = sorted((r["rank"], r["ord"]) for r in products.subsample(df, most).collect())
        assert got == [(i, int(i * n / most)) for i in range(most)] if n > most else len(got) == n


def test_noise_rules(spark):
    c = lambda *xs: [F.lit(x) for x in xs]
    got = [one(spark, products.noise_reason(*c(*x))) for x in ((1, 0.1, 0.0), (2, 0.5, 0.0), (2, 0.9, 0.01), (2, 0.6, 0.03))]
    assert got == ["single_keyframe", "low_confidence", "low_prominence", None]


def test_throttle():
    rows = [(float(i), "d", p, None) for i, p in enumerate((0, 0.5, 10, 10.2, 11, 15))]
    assert [r[2] for r in progress.throttle(rows, None)[0]] == [0, 10, 11, 15]
    assert [r[2] for r in progress.throttle([(0.0, "d", 0, None), (0.1, "d", 50, None), (1.0, "d", 90, None)], None)[0]] == [0, 90]
    assert len(progress.throttle([(0.0, "a", 0, None), (0.0, "b", 0, None), (0.0, "a", 0, None)], None)[0]) == 3
    assert progress.retry_plan([500, None, 502]) == [2.0, 4.0, 8.0] == progress.retry_plan([500] * 9)
    assert progress.retry_plan([404, 500]) == [] and progress.retry_plan([503, 200]) == [2.0]


def test_throttle_stream_equals_table(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"j{i % 3}", i * 0.3, "detecting" if i < 80 else "finalizing", i * rng.random(), None) for i in range(100)]
    for k in range(4):
        spark.createDataFrame(rows[k * 25 : k * 25 + 25], progress.EVENT).coalesce(1).write.mode("append").json(str(tmp_path / f"in/{k}"))
    whole = spark.createDataFrame(rows, progress.EVENT)
    want = sorted(map(tuple, progress.throttle_table(whole).collect()), key=str)
    stream = spark.readStream.schema(progress.EVENT).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in/*"))
    q = progress.throttle_stream(stream).writeStream.format("memory").queryName("throttled").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("throttled").collect()), key=str) == want


def test_breaker(spark):
    rows = [("j", float(t), False) for t in range(6)] + [("j", 30.0, True), ("j", 64.0, True), ("j", 65.0, False)]
    got = [r["made"] for r in progress.replay_breaker(spark.createDataFrame(rows, "job string, t double, ok boolean")).orderBy("t").collect()]
    assert got == [True] * 5 + [False, False, True, True]


def test_images():
    flat, edge = np.full((20, 20, 1), 90, np.uint8), np.zeros((20, 20, 1), np.uint8)
    edge[:, 10:] = 255
    assert images.laplacian_variance(images.grey(flat)) == 0 < images.laplacian_variance(images.grey(edge))
    assert images.edge_sharpness(np.zeros((9, 9))) == 0 and images.edge_sharpness(images.grey(edge)) > 0  # borders keep their pixels
    out = images.blur_region(edge, 5, 5, 10, 10)
    assert (out[:5] == edge[:5]).all() and 0 < out[10, 10, 0] < 255 and (images.blur_region(edge, 50, 50, 5, 5) == edge).all()


def test_models(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "x string")
    got = models.apply_model(df, "image_embedder", "stub", "x", "array<double>", dim=4).collect()
    assert got[0]["result"] == got[2]["result"] != got[1]["result"] and got[0]["error"] is None
    with pytest.raises(ValueError):
        models.create("caption", "nope")
    with pytest.raises(ValueError):
        blur.validate(["nope"], 1, 0.5)


def test_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"video_id":"v","segments":[{"start_s":1,"end_s":2,"text":"a"},{"start":3,"end":4,"speaker_id":"S","confidence":0.5}]}')
    got = io.read_speech(spark, str(tmp_path / "s.json")).orderBy("ord").collect()
    assert [(r["start"], r["text"], r["confidence"], r["speaker_id"]) for r in got] == [(1.0, "a", 1.0, None), (3.0, "", 0.5, "S")]
    assert io.read_speech(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "b.json").write_text('{"video_id":"v","boundaries":[{"scene_id":"v_scene_000","start_ms":0,"end_ms":5},{"start_ms":5}]}')
    assert [r["end_ms"] for r in io.read_scenes(spark, str(tmp_path / "b.json")).collect()] == [5]
    (tmp_path / "v1.log").write_text("[Parsed_showinfo_1] n:0 pts_time:5.0 x\nother pts_time:9\n[Parsed_showinfo_1] pts_time:0\n")
    cuts = signals.cuts_from_log(io.read_log(spark, str(tmp_path / "v1.log"))).collect()
    assert [(r["video_id"], r["cut_ms"]) for r in cuts] == [("v1", 5000)]


def test_faces_and_manifest(spark):
    b = spark.createDataFrame([(1, 0, 0, 0, 0, 10, 10), (1, 0, 1, 500, 500, 10, 10)], "video_id int, frame_idx int, ord int, x int, y int, w int, h int")
    f = spark.createDataFrame([(1, 0, 0, 0, 0, 10, 10), (1, 0, 1, 0, 0, 10, 10)], "video_id int, frame_idx int, ford int, x1 int, y1 int, x2 int, y2 int")
    got = {r["ord"]: (r["ford"], r["accepted"]) for r in faces.match_boxes(b, f).collect()}
    assert got == {0: (0, True), 1: (None, False)}
    d = spark.createDataFrame([(1, 0.87654, [0.1234567], "face"), (1, 0.5, [0.5], "face"), (1, 0.9, [0.1], "license_plate")], "video_id int, confidence double, bbox_norm array<double>, category string")
    r = blur.manifest_records(d).first()
    assert r["confidence"] == 0.8765 and r["bbox_norm"] == [0.12346]
    s = blur.summary(d).first()
    assert (s["face"], s["license_plate"], s["logo"]) == (2, 1, 0) and blur.summary_map(d).first()["summary"] == {"face": 2, "license_plate": 1}
    doc = records.envelope(d.select("video_id", "category", "confidence"), "detections", "video_id", "confidence").first()["document"]
    assert doc.startswith('{"schema_version":"1.0"')


@pytest.mark.parametrize("cell", [faces.CELL, 7])
def test_match_boxes_brute_force(spark, cell):
    """All pairs against the operator, with ties, repeated ords, nulls, flat boxes, and frames of many cells and blocks."""
    rnd = random.Random(3)
    b, f = [], []
    for k in range(900):
        frame = 0 if k < 500 else rnd.randrange(1, 40)
        x, y, w, h = (rnd.choice([None, 0]) if rnd.random() < 0.02 else rnd.randrange(n) for n in (60, 40, 12, 12))
        b.append((None if k == 7 else k % 3, None if k == 8 else frame, k - k % 2 if k < 40 else None if k == 50 else k, x, y, w, h))
        x, y = rnd.randrange(60), rnd.randrange(40)
        f.append((k % 3, frame, 1000 - k, None if k % 60 == 9 else x, y, x + rnd.randrange(12), None if k % 50 == 9 else y + rnd.randrange(12)))
    boxes = spark.createDataFrame(b, "video_id int, frame_idx int, ord bigint, x int, y int, w int, h int")
    found = spark.createDataFrame(f, "video_id int, frame_idx int, ford int, x1 int, y1 int, x2 int, y2 int")
    pairs = boxes.join(found, ["video_id", "frame_idx"])
    pairs = pairs.withColumn("iou", geometry.iou(*(F.col(c) for c in ("x", "y", "w", "h", "x1", "y1", "x2", "y2")))).where("iou > 0")
    best = {}
    for r in pairs.collect():
        at = (r["video_id"], r["frame_idx"], r["ord"])
        best[at] = min(best.get(at, (0.0, 0)), (-r["iou"], r["ford"]))
    want = sorted((*map(str, x), *((best[x[:3]][1], -best[x[:3]][0]) if x[:3] in best and x[2] is not None else (None, 0.0))) for x in b)
    got = sorted((*map(str, r[:7]), r["ford"], r["iou"]) for r in faces.match_boxes(boxes, found, cell=cell).collect())
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_match_boxes_sorts_no_pairs(spark):
    """300 boxes on 300 faces of one frame: no operator gives out more rows than there are boxes and faces."""
    n = spark.range(300)
    b = n.select(F.lit(1).alias("video_id"), F.lit(0).alias("frame_idx"), F.col("id").alias("ord"), *(F.lit(9).alias(c) for c in "xywh"))
    f = n.select(F.lit(1).alias("video_id"), F.lit(0).alias("frame_idx"), F.col("id").alias("ford"), *(F.lit(9 + 9 * k).alias(c) for k, c in zip((0, 0, 1, 1), ("x1", "y1", "x2", "y2"))))
    out = faces.match_boxes(b, f)
    assert {(r["ford"], r["iou"]) for r in out.collect()} == {(0, 1.0)}
    todo, rows = [out._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if p.metrics().contains("numOutputRows"):
            rows.append(p.metrics().apply("numOutputRows").value())
        inner = p.executedPlan() if name == "AdaptiveSparkPlan" else p.plan() if name.endswith("QueryStage") else None
        todo += [inner] if inner is not None else [p.children().apply(i) for i in range(p.children().size())]
    assert rows and max(rows) <= 600


def test_plans_have_no_cartesian(spark, sf_dir):
    import __spark_entry__ as e

    for name in ("speaker_attribution", "scene_documents", "iou_match", "blur_carry_forward"):
        plan = e.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan
    assert e.entry(spark).count() > 0
