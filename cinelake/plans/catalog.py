"""The registered queries over the driver's tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions import geometry, text, vectors
from cinelake.operators import blur, faces, products, records, scenes, signals, transcode
from cinelake.plans import tables
from cinelake.plans.tables import BOX_SQL, PROBE_SQL, SPEECH_SQL, read
from cinelake.streaming import progress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def r6(c):
    """Rounded half to even: sums in another order compare alike."""
    return F.bround(c, 6)


# --- scenes -----------------------------------------------------------------------------------------------------------

_PAUSES = f"""WITH {SPEECH_SQL}, g AS (
  SELECT video_id, trunc("end" * 1000)::BIGINT AS end_ms,
    lead(trunc("start" * 1000)::BIGINT) OVER (PARTITION BY video_id ORDER BY "start", ord) - trunc("end" * 1000)::BIGINT AS gap FROM speech)
SELECT video_id, (end_ms + floor(gap / 2.0))::BIGINT AS timestamp_ms, least(1.0, gap / 2000.0)::DOUBLE AS strength, 'speech_pause' AS source
FROM g WHERE gap >= 300"""


@query(_PAUSES)
def speech_pauses(spark, sf_dir):
    return signals.speech_pauses(tables.speech(spark, sf_dir))


@query(f"""WITH {SPEECH_SQL}, k AS (SELECT * FROM speech WHERE speaker_id IS NOT NULL), g AS (
  SELECT video_id, speaker_id, lead(speaker_id) OVER w AS nxt, trunc("end" * 1000)::BIGINT AS end_ms,
    lead(trunc("start" * 1000)::BIGINT) OVER w AS next_ms FROM k WINDOW w AS (PARTITION BY video_id ORDER BY "start", ord))
SELECT video_id, CASE WHEN next_ms >= end_ms THEN (end_ms + floor((next_ms - end_ms) / 2.0))::BIGINT ELSE next_ms END AS timestamp_ms,
  CASE WHEN next_ms >= end_ms THEN 1.0 ELSE 0.7 END::DOUBLE AS strength, 'speaker_turn' AS source
FROM g WHERE nxt <> speaker_id""")
def speaker_turns(spark, sf_dir):
    return signals.speaker_turns(tables.speech(spark, sf_dir))


def _totals(spark, sf_dir):
    """Recordings with their length and cuts: the starts of error events, every hour of the table a second."""
    s = tables.speech(spark, sf_dir).withColumn("cut_ms", F.floor(F.col("start") / 3.6).cast("long"))
    cuts = F.collect_set(F.when(F.col("speaker_id").isNull() & (F.col("cut_ms") > 0), F.col("cut_ms")))
    return s.groupBy("video_id").agg((F.max("cut_ms") + 1000).alias("total_ms"), cuts.alias("cuts"))


_TOTALS = f"""{SPEECH_SQL}, totals AS (
  SELECT video_id, max(floor("start" / 3.6::DOUBLE)::BIGINT) + 1000 AS total_ms FROM speech GROUP BY 1),
cuts AS (SELECT DISTINCT s.video_id, floor("start" / 3.6::DOUBLE)::BIGINT AS cut_ms FROM speech s JOIN totals t USING (video_id)
  WHERE speaker_id IS NULL AND floor("start" / 3.6::DOUBLE)::BIGINT > 0 AND floor("start" / 3.6::DOUBLE)::BIGINT < total_ms),
ranked AS (SELECT video_id, cut_ms, row_number() OVER (PARTITION BY video_id ORDER BY cut_ms) AS k FROM cuts),
kept AS (
  WITH RECURSIVE fold(video_id, k, last) AS (
    SELECT video_id, 0::BIGINT, 0::BIGINT FROM totals
    UNION ALL
    SELECT f.video_id, r.k, CASE WHEN r.cut_ms - f.last >= 500 THEN r.cut_ms ELSE f.last END
    FROM fold f JOIN ranked r ON r.video_id = f.video_id AND r.k = f.k + 1)
  SELECT DISTINCT video_id, last AS b FROM fold),
bounds AS (SELECT video_id, b, coalesce(lead(b) OVER (PARTITION BY video_id ORDER BY b), (SELECT total_ms FROM totals t WHERE t.video_id = kept.video_id)) AS e FROM kept),
pieces AS (SELECT video_id, unnest(range(b, e, 45000)) AS start_ms, e FROM bounds),
scene AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY start_ms) - 1 AS idx, start_ms,
    coalesce(lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms), e) AS end_ms FROM pieces)"""
_SCENES = """sc AS (SELECT s.video_id, s.video_id::VARCHAR || '_scene_' || lpad(idx::VARCHAR, greatest(3, length(idx::VARCHAR))::INT, '0') AS scene_id, idx AS "index", start_ms, end_ms,
  least(start_ms + floor((end_ms - start_ms) / 2.0)::BIGINT, greatest(start_ms, greatest(t.total_ms - 500, 0))) AS keyframe_timestamp_ms
  FROM scene s JOIN totals t ON t.video_id = s.video_id)"""


@query(f"WITH {_TOTALS} SELECT video_id, b AS boundary_ms FROM kept")
def scene_cuts_min_gap(spark, sf_dir):
    t = _totals(spark, sf_dir)
    kept = scenes.min_gap(F.col("cuts"), F.col("total_ms"), 500)
    return t.select("video_id", F.explode(F.slice(kept, F.lit(1), F.size(kept) - 1)).alias("boundary_ms"))


def _scenes(spark, sf_dir):
    t = _totals(spark, sf_dir)
    return scenes.scene_rows(t.select("video_id", "total_ms", scenes.boundaries(F.col("cuts"), F.col("total_ms")).alias("boundaries")))


@query(f"WITH {_TOTALS}, {_SCENES} SELECT * FROM sc")
def scene_boundaries(spark, sf_dir):
    return _scenes(spark, sf_dir).withColumn("index", F.col("index").cast("long"))


def _scaled_speech(spark, sf_dir):
    """Segments on the recordings' own time: an hour of the table is a second."""
    s = tables.speech(spark, sf_dir)
    s = s.withColumn("start", F.floor(F.col("start") / 3.6) / 1000.0)
    return s.withColumn("end", F.col("start") + F.floor((F.col("ord") % 90 + 1) * 20) / 1000.0)


_SCALED = """seg AS (SELECT video_id, ord, text, floor("start" / 3.6::DOUBLE)::BIGINT AS s_ms,
  trunc((floor("start" / 3.6::DOUBLE) / 1000.0::DOUBLE + floor((ord % 90 + 1) * 20) / 1000.0::DOUBLE) * 1000)::BIGINT AS e_ms,
  trunc(floor("start" / 3.6::DOUBLE) / 1000.0::DOUBLE * 1000)::BIGINT AS b_ms FROM speech),
met AS (SELECT g.video_id, g.ord, g.text, g.s_ms, c.scene_id, c."index" AS i, least(e_ms, end_ms) - greatest(b_ms, start_ms) AS over
  FROM seg g JOIN sc c ON c.video_id = g.video_id AND b_ms < end_ms AND start_ms < e_ms),
assigned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, ord ORDER BY over DESC, i) AS rn FROM met) WHERE rn = 1)"""


@query(f"WITH {_TOTALS}, {_SCENES}, {_SCALED} SELECT video_id, ord, scene_id FROM assigned")
def scene_assignment(spark, sf_dir):
    return signals_assigned(spark, sf_dir).select("video_id", "ord", "scene_id")


def signals_assigned(spark, sf_dir):
    return scenes.assign_segments(_scaled_speech(spark, sf_dir), _scenes(spark, sf_dir))


def _terms_sql(dictionary, col):
    cats = ", ".join(f"CASE WHEN {' OR '.join(f'contains(lower({col}), {chr(39)}{t.lower()}{chr(39)})' for t in ts)} THEN '{c}' END" for c, ts in sorted(dictionary.items()))
    terms = ", ".join(f"CASE WHEN contains(lower({col}), '{t.lower()}') THEN '{t}' END" for t in sorted({t for ts in dictionary.values() for t in ts}))
    return f"concat_ws(',', {cats})", f"concat_ws(',', {terms})"


_CATS, _TERMS = _terms_sql(tables.DICTIONARY, "a.text")


def _union_sql(found):
    """Sorted distinct entries over the rows of a group, comma-joined; found: entries of one row, comma-joined."""
    return f"array_to_string(list_sort(list_distinct(string_split(coalesce(string_agg(nullif({found}, ''), ','), ''), ','))), ',')"


@query(f"""WITH {_TOTALS}, {_SCENES}, {_SCALED}, docs AS (
  SELECT c.video_id, c.scene_id, start_ms, end_ms, keyframe_timestamp_ms, coalesce(string_agg(a.text, ' ' ORDER BY s_ms, ord), '') AS transcript_raw, count(a.ord) AS speech_segment_count,
    {_union_sql(_CATS)} AS keyword_tags, {_union_sql(_CATS)} AS product_tags, {_union_sql(_TERMS)} AS product_entities
  FROM sc c LEFT JOIN assigned a ON a.scene_id = c.scene_id GROUP BY c.video_id, c.scene_id, start_ms, end_ms, keyframe_timestamp_ms)
SELECT *, lower(transcript_raw) AS transcript_norm, length(transcript_raw)::BIGINT AS transcript_char_count FROM docs""")
def scene_documents(spark, sf_dir):
    d = scenes.scene_documents(_scenes(spark, sf_dir), _scaled_speech(spark, sf_dir), tables.DICTIONARY)
    for c in ("keyword_tags", "product_tags", "product_entities"):
        d = d.withColumn(c, F.array_join(c, ","))
    return d.drop("people_cluster_ids", "index")


def _fold_sql(ranked, name):
    """Cuts kept at a distance of 500 from the last kept one, as {name}(video_id, last)."""
    return f"""{name} AS (
  WITH RECURSIVE fold(video_id, k, last) AS (
    SELECT video_id, 0::BIGINT, 0::BIGINT FROM totals
    UNION ALL
    SELECT f.video_id, r.k, CASE WHEN r.cut_ms - f.last >= 500 THEN r.cut_ms ELSE f.last END
    FROM fold f JOIN {ranked} r ON r.video_id = f.video_id AND r.k = f.k + 1)
  SELECT DISTINCT video_id, last AS b FROM fold)"""


@query(f"""WITH {_TOTALS}, sp AS (SELECT video_id, ord, speaker_id, floor("start" / 3.6::DOUBLE) / 1000.0::DOUBLE AS st,
    floor("start" / 3.6::DOUBLE) / 1000.0::DOUBLE + floor((ord % 90 + 1) * 20) / 1000.0::DOUBLE AS en FROM speech),
g AS (SELECT video_id, trunc(en * 1000)::BIGINT AS e, lead(trunc(st * 1000)::BIGINT) OVER (PARTITION BY video_id ORDER BY st, ord) - trunc(en * 1000)::BIGINT AS gap FROM sp),
k AS (SELECT video_id, speaker_id, lead(speaker_id) OVER w AS nxt, trunc(en * 1000)::BIGINT AS e, lead(trunc(st * 1000)::BIGINT) OVER w AS n
  FROM sp WHERE speaker_id IS NOT NULL WINDOW w AS (PARTITION BY video_id ORDER BY st, ord)),
found AS (SELECT video_id, (e + floor(gap / 2.0))::BIGINT AS ts, least(1.0, gap / 2000.0)::DOUBLE AS strength FROM g WHERE gap >= 300
  UNION ALL SELECT video_id, CASE WHEN n >= e THEN (e + floor((n - e) / 2.0))::BIGINT ELSE n END, CASE WHEN n >= e THEN 1.0 ELSE 0.7 END::DOUBLE FROM k WHERE nxt <> speaker_id),
best AS (SELECT p.video_id, f.ts, row_number() OVER (PARTITION BY p.video_id, p.b ORDER BY strength DESC, abs(ts - b - 30000), ts) AS rn
  FROM bounds p JOIN found f ON f.video_id = p.video_id AND ts > b AND ts < e WHERE e - b > 30000),
every AS (SELECT video_id, cut_ms FROM cuts UNION SELECT video_id, ts FROM best WHERE rn = 1),
ranked2 AS (SELECT video_id, cut_ms, row_number() OVER (PARTITION BY video_id ORDER BY cut_ms) AS k FROM every),
{_fold_sql("ranked2", "kept2")},
bounds2 AS (SELECT x.video_id, b, coalesce(lead(b) OVER (PARTITION BY x.video_id ORDER BY b), total_ms) AS e FROM kept2 x JOIN totals t ON t.video_id = x.video_id)
SELECT video_id, unnest(range(b, e, 45000)) AS boundary_ms FROM bounds2 UNION ALL SELECT video_id, total_ms FROM totals""")
def combined_boundaries(spark, sf_dir):
    return _combined(spark, sf_dir, "default")


def _combined(spark, sf_dir, preset):
    t = _totals(spark, sf_dir)
    cuts = t.select("video_id", F.explode("cuts").alias("cut_ms"))
    target = scenes.resolve_preset(preset)
    found = signals.speech_pauses(_scaled_speech(spark, sf_dir)).unionByName(signals.speaker_turns(_scaled_speech(spark, sf_dir)))
    if target is None:
        found = found.limit(0)
    out = signals.combine_signals(cuts, found, t.select("video_id", "total_ms"), target or 0)
    return out.select("video_id", F.explode("boundaries").alias("boundary_ms"))


@query(f"""WITH {_TOTALS} SELECT video_id, unnest(range(b, e, 45000)) AS boundary_ms FROM bounds UNION ALL SELECT video_id, total_ms FROM totals""")
def scene_max_split(spark, sf_dir):
    """The splitter of long spans alone: visual cuts, none of the speech signals."""
    return _combined(spark, sf_dir, "visual_only")


# --- speakers, transcripts --------------------------------------------------------------------------------------------


@query(f"""WITH {SPEECH_SQL}, t AS (SELECT video_id, ord AS tord, "start" AS ts, "end" + 120 AS te, speaker_id AS who FROM speech WHERE speaker_id IS NOT NULL),
each AS (SELECT s.video_id, s.ord, who, sum(least("end", te) - greatest("start", ts)) AS total, min(ts) AS first, min(tord) AS tord
  FROM speech s JOIN t ON t.video_id = s.video_id AND "start" < te AND ts < "end" GROUP BY 1, 2, 3),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, ord ORDER BY total DESC, first, tord) AS rn FROM each WHERE total > 0) WHERE rn = 1)
SELECT s.video_id, s.ord, b.who AS speaker_id FROM speech s LEFT JOIN best b ON b.video_id = s.video_id AND b.ord = s.ord""")
def speaker_attribution(spark, sf_dir):
    out = signals.attribute_speakers(tables.speech(spark, sf_dir), tables.turns(spark, sf_dir))
    return out.select("video_id", "ord", "speaker_id")


@query(f"""WITH {SPEECH_SQL} SELECT video_id, count(*) AS total_segments, round_even(max("end"), 6)::DOUBLE AS total_duration_s, round_even(sum("end" - "start"), 3)::DOUBLE AS spoken_s,
  count(DISTINCT speaker_id) AS n_speakers FROM speech GROUP BY 1""")
def transcript_summary(spark, sf_dir):
    out = records.transcript_summary(tables.speech(spark, sf_dir))
    return out.withColumn("total_duration_s", r6("total_duration_s")).withColumn("spoken_s", F.bround("spoken_s", 3))


_RCATS = {c: " OR ".join(f"contains(lower(text), '{t}')" for t in ts) for c, ts in sorted(tables.DICTIONARY.items())}
_RHITS = " + ".join(f"CASE WHEN {hit} THEN 1 ELSE 0 END" for hit in _RCATS.values())
_RWEIGHT = " + ".join(f"CASE WHEN {hit} THEN {2.0 if c == 'trouble' else 1.0} ELSE 0 END" for c, hit in _RCATS.items())


@query(f"""WITH {SPEECH_SQL} SELECT video_id, ord, {_terms_sql(tables.DICTIONARY, "text")[0]} AS tags,
  round_even(({_RWEIGHT})::DOUBLE + ({_RHITS})::DOUBLE / greatest("end" - "start", 0.001::DOUBLE), 6)::DOUBLE AS score, 'success' AS status FROM speech""")
def ranked_segments(spark, sf_dir):
    s = tables.speech(spark, sf_dir)
    out = records.rank_segments(s, tables.DICTIONARY, {"trouble": 2.0})
    runs = records.run_results(s).select("video_id", "status")
    return out.join(runs, "video_id").select("video_id", "ord", F.array_join("tags", ",").alias("tags"), r6("score").alias("score"), "status")


# --- text -------------------------------------------------------------------------------------------------------------

_BIDI = "".join(f"\\x{{{x}}}" for x in ("200e", "200f")) + "\\x{202a}-\\x{202e}\\x{2066}-\\x{2069}"


@query(rf"""WITH s AS (SELECT page_id, replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '[{_BIDI}]', '', 'g'), '<[^>]+>', '', 'g'),
  '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS t FROM pages)
SELECT page_id, sha256(trim(t, E' \t\n\r')) AS sha, length(trim(t, E' \t\n\r'))::BIGINT AS n_chars FROM s""")
def ocr_sanitize_pages(spark, sf_dir):
    t = text.sanitize_ocr(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.sha2(t, 256).alias("sha"), F.length(t).cast("long").alias("n_chars"))


_CARD = r"(?:4\d{12}(?:\d{3})?|5[1-5]\d{14}|3[47]\d{13}|6(?:011|5\d{2})\d{12})"
_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query(rf"""SELECT doc_id, len(regexp_extract_all(text, '\b{_CARD}\b'))::BIGINT AS n_cards, len(regexp_extract_all(text, '\b{_MAIL}\b'))::BIGINT AS n_mails FROM documents""")
def pii_counts(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    n = lambda name: F.size(text.pii_matches(F.col("text"), name)).cast("long")
    return d.select("doc_id", n("credit_card").alias("n_cards"), n("email").alias("n_mails"))


def _redact_sql(t):
    """Redaction without look-around, which that dialect lacks: a neighbour that must be none of its kind is matched and put
    back, twice over since two findings may share one."""

    def edged(t, pattern, name, inside):
        for _ in range(2):
            t = f"regexp_replace({t}, '(^|[^{inside}]){pattern}($|[^{inside}])', '\\1[{name}]\\2', 'g')"
        return t

    word = r"\p{L}\p{N}_"
    t = edged(t, r"\d{6}[-–]\d{7}", "KR_RRN", word)
    t = edged(t, _CARD, "CREDIT_CARD", word)
    t = edged(t, r"(?:\+82[\s)\-–.]*0?|0)(?:2|1[016789]|[3-6]\d)[-–.\s]?\d{3,4}[-–.\s]?\d{4}", "KR_PHONE", r"\d")
    t = f"regexp_replace({t}, '{_MAIL}', '[EMAIL]', 'g')"
    return f"regexp_replace({t}, '(?:[가-힣]{{2}}\\s*)?\\d{{2,3}}\\s*[가-힣]\\s*\\d{{4}}', '[KR_LICENSE_PLATE]', 'g')"


@query(f"WITH r AS (SELECT doc_id, {_redact_sql('text')} AS t FROM documents) SELECT doc_id, sha256(t) AS sha, length(t)::INT AS n_chars FROM r")
def pii_redact(spark, sf_dir):
    t = text.redact_pii(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(t, 256).alias("sha"), F.length(t).alias("n_chars"))


@query()
def pii_spans(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.explode(text.find_pii(F.col("text"))).alias("f"))
    return d.select("doc_id", "f.*")


_DCATS, _DTERMS = _terms_sql(tables.DOC_DICTIONARY, "text")


@query(f"SELECT doc_id, {_DCATS} AS categories, {_DTERMS} AS terms FROM documents")
def keyword_tags(spark, sf_dir):
    c, d = F.col("text"), tables.DOC_DICTIONARY
    terms = [t for ts in d.values() for t in ts]
    return read(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(text.matched_categories(c, d), ",").alias("categories"), F.array_join(text.matched_terms(c, terms), ",").alias("terms")
    )


@query()
def caption_clean(spark, sf_dir):
    c = text.clean_caption(text.cap_reply(F.col("text")))
    return read(spark, sf_dir, "documents").select("doc_id", c.alias("caption"))


@query("""SELECT item_id, contains(lower(text), 'thand') OR len(list_filter(range(1, greatest(length(text) - 3, 1)), lambda s:
  1 - levenshtein(substr(lower(text), s::INT, 4), 'thand') / 5.0 >= 0.8 OR 1 - levenshtein(substr(lower(text), s::INT, 5), 'thand') / 5.0 >= 0.8
  OR 1 - levenshtein(substr(lower(text), s::INT, 6), 'thand') / 6.0 >= 0.8)) > 0 AS found FROM benchmark""")
def fuzzy_contains(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select("item_id", text.fuzzy_contains(F.col("text"), F.lit("thand"), 0.8).alias("found"))


@query(f"""WITH {BOX_SQL} SELECT ord, label, CASE WHEN lower(trim(label)) IN ('brand logo', 'logo on tin can') THEN 'logo' WHEN lower(trim(label)) IN ('credit card', 'passport') THEN 'card_object'
  WHEN lower(trim(label)) = 'car license plate' THEN 'license_plate' ELSE 'object' END AS category FROM boxes""")
def label_category(spark, sf_dir):
    return tables.lineitem_boxes(spark, sf_dir).select("ord", "label", blur.label_category(F.col("label")).alias("category"))


# --- transcoding ------------------------------------------------------------------------------------------------------


@query(f"""WITH {PROBE_SQL}, f AS (SELECT *, codec_name IN ('h264', 'h264_qsv', 'h264_nvenc') AS c, height <= 720 AS h, bitrate_kbps <= 2500 AS b FROM probes)
SELECT video_id, NOT (c AND h AND b) AS should_transcode, c AND h AND NOT b AS should_cap_bitrate,
  CASE WHEN c AND h AND b THEN 'Already H.264 ' || width || 'x' || height || ' @ ' || bitrate_kbps || 'kbps (within 2500kbps cap)'
       WHEN c AND h THEN 'H.264 ' || width || 'x' || height || ' but bitrate ' || bitrate_kbps || 'kbps exceeds 2500kbps cap'
       ELSE 'Requires transcode: ' || concat_ws(', ', CASE WHEN NOT c THEN 'codec=' || codec_name END, CASE WHEN NOT h THEN 'height=' || height || ' > 720' END,
         CASE WHEN NOT b THEN 'bitrate=' || bitrate_kbps || 'kbps > 2500kbps' END) END AS reason FROM f""")
def transcode_decision(spark, sf_dir):
    p = tables.probes(spark, sf_dir)
    d = transcode.decision(F.col("codec_name"), F.col("width"), F.col("height"), F.col("bitrate_kbps"))
    return p.select("video_id", d.alias("d")).select("video_id", "d.*")


@query("""WITH r AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN (p_size * 1000)::VARCHAR || '/1001' WHEN 1 THEN p_size::VARCHAR || '/1' WHEN 2 THEN '0/0' WHEN 3 THEN p_size::VARCHAR || '.5' ELSE p_name END AS rate FROM part)
SELECT p_partkey, rate, coalesce(CASE WHEN contains(rate, '/') THEN round_even(try_cast(split_part(rate, '/', 1) AS DOUBLE) / nullif(try_cast(split_part(rate, '/', 2) AS DOUBLE), 0), 3)
  ELSE round_even(try_cast(rate AS DOUBLE), 3) END, 0)::DOUBLE AS fps FROM r""")
def frame_rate_parse(spark, sf_dir):
    k, s = F.col("p_size") % 5, F.col("p_size").cast("string")
    rate = F.when(k == 0, F.concat((F.col("p_size") * 1000).cast("string"), F.lit("/1001"))).when(k == 1, F.concat(s, F.lit("/1")))
    rate = rate.when(k == 2, "0/0").when(k == 3, F.concat(s, F.lit(".5"))).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", rate.alias("rate")).withColumn("fps", transcode.frame_rate(F.col("rate")))


@query(f"""WITH {PROBE_SQL} SELECT video_id, CASE WHEN bitrate_kbps * 10000::BIGINT > 26214400 THEN 'mp3_64k' ELSE 'wav_16k_mono' END AS route,
  CASE WHEN greatest(width, height) <= 448 THEN width WHEN width >= height THEN 448 ELSE floor(width * 448 / height)::INT END AS w,
  CASE WHEN greatest(width, height) <= 448 THEN height WHEN width >= height THEN floor(height * 448.0 / width)::INT ELSE 448 END AS h,
  width::BIGINT * height <= 25000000 AND greatest(width, height)::DOUBLE / greatest(least(width, height), 1) <= 20 AS valid FROM probes""")
def encode_plans(spark, sf_dir):
    p = tables.probes(spark, sf_dir)
    w, h = F.col("width"), F.col("height")
    plan = geometry.resize_plan(w, h)
    return p.select("video_id", transcode.audio_route(F.col("bitrate_kbps") * F.lit(10000).cast("long")).alias("route"), plan["w"].alias("w"), plan["h"].alias("h"),
                    geometry.valid_picture(F.lit(1), w, h).alias("valid"))


# --- faces, boxes, vectors --------------------------------------------------------------------------------------------


@query(f"""WITH {BOX_SQL}, c AS (SELECT ord, confidence, w, greatest(0, least(x, 640)) AS x1, greatest(0, least(y, 360)) AS y1, greatest(0, least(x + w, 640)) AS x2, greatest(0, least(y + h, 360)) AS y2 FROM boxes),
q AS (SELECT ord, (x2 - x1) * (y2 - y1) / (640.0::DOUBLE * 360) AS area, w::DOUBLE AS b, confidence AS conf FROM c WHERE x2 > x1 AND y2 > y1),
s AS (SELECT ord, area, (0.4::DOUBLE * (b / (b + 100)) + 0.3::DOUBLE * greatest(0, least(1, area)) + 0.3::DOUBLE * greatest(0, least(1, conf))) AS quality FROM q)
SELECT ord, round_even(area, 6)::DOUBLE AS bbox_area_ratio, round_even(quality, 6)::DOUBLE AS quality FROM s WHERE quality >= 0.25""")
def face_quality_filter(spark, sf_dir):
    b = tables.lineitem_boxes(spark, sf_dir).withColumn("width", F.lit(640)).withColumn("height", F.lit(360))
    b = b.withColumn("blur", F.col("w").cast("double")).withColumn("det_conf", F.col("confidence"))
    return faces.quality_rows(b).select("ord", r6("bbox_area_ratio").alias("bbox_area_ratio"), r6("quality").alias("quality"))


@query(f"""WITH {BOX_SQL}, f AS (SELECT video_id, frame_idx, ord AS ford, x AS x1, y AS y1, x + w AS x2, y + h AS y2 FROM boxes WHERE ord % 10 % 2 = 0),
m AS (SELECT b.video_id, b.frame_idx, b.ord, ford, greatest(0, least(x + w, x2) - greatest(x, x1))::DOUBLE * greatest(0, least(y + h, y2) - greatest(y, y1)) AS i, w * h + (x2 - x1) * (y2 - y1) AS s
  FROM boxes b JOIN f ON f.video_id = b.video_id AND f.frame_idx = b.frame_idx WHERE b.ord % 10 % 2 = 1),
r AS (SELECT video_id, frame_idx, ord, ford, i / (s - i) AS iou, row_number() OVER (PARTITION BY video_id, frame_idx, ord ORDER BY i / (s - i) DESC, ford) AS rn FROM m WHERE i > 0)
SELECT b.ord, r.ford, round_even(coalesce(r.iou, 0), 6)::DOUBLE AS iou, coalesce(r.iou, 0) >= 0.3 AS accepted FROM boxes b LEFT JOIN r ON r.ord = b.ord AND r.video_id = b.video_id AND r.frame_idx = b.frame_idx AND rn = 1 WHERE b.ord % 10 % 2 = 1""")
def iou_match(spark, sf_dir):
    b = tables.lineitem_boxes(spark, sf_dir)
    odd = F.col("ord") % 10 % 2
    f = b.where(odd == 0).select("video_id", "frame_idx", F.col("ord").alias("ford"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))
    out = faces.match_boxes(b.where(odd == 1), f)
    return out.select("ord", "ford", r6("iou").alias("iou"), "accepted")


_UNIT = """v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM v GROUP BY 1), u AS (SELECT v.vec_id, label, d, CASE WHEN n > 0 THEN x / n ELSE x END AS x FROM v JOIN n USING (vec_id)),
c AS (SELECT label, d, avg(x) AS x FROM u GROUP BY 1, 2), cn AS (SELECT label, sqrt(sum(x * x)) AS n FROM c GROUP BY 1),
s AS (SELECT u.vec_id, u.label, sum(u.x * c.x / cn.n) AS sim FROM u JOIN c ON c.label = u.label AND c.d = u.d JOIN cn ON cn.label = u.label GROUP BY 1, 2)"""


@query(f"""WITH {_UNIT} SELECT label, count(*) AS "count", round_even(avg(sim), 6)::DOUBLE AS mean, round_even(stddev_pop(sim), 6)::DOUBLE AS std, round_even(min(sim), 6)::DOUBLE AS "min", round_even(max(sim), 6)::DOUBLE AS "max" FROM s GROUP BY 1""")
def identity_templates(spark, sf_dir):
    stats, _ = faces.identity_templates(read(spark, sf_dir, "embeddings"), "label", "vec_id")
    return stats.select("label", "count", *(r6(c).alias(c) for c in ("mean", "std", "min", "max")))


@query(f"""WITH {_UNIT}, r AS (SELECT label, vec_id, sim, row_number() OVER (PARTITION BY label ORDER BY round_even(sim, 9) DESC, vec_id) AS rank FROM s)
SELECT label, vec_id, rank, round_even(sim, 6)::DOUBLE AS similarity FROM r WHERE rank <= 5""")
def identity_exemplars_topk(spark, sf_dir):
    _, top = faces.identity_templates(read(spark, sf_dir, "embeddings"), "label", "vec_id", 5)
    return top.select("label", "vec_id", F.col("rank").cast("long").alias("rank"), r6("similarity").alias("similarity"))


@query("""WITH f AS (SELECT user_id AS video_id, event_id AS ts, CASE WHEN event_type = 'error' THEN 0 ELSE (event_id % 4) END AS n FROM events)
SELECT video_id, count(*) AS num_timestamps, count(*) FILTER (WHERE n > 0) AS frames_with_faces, sum(n)::BIGINT AS total_faces FROM f GROUP BY 1""")
def face_frame_stats(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    n = F.when(F.col("event_type") == "error", 0).otherwise(F.col("event_id") % 4).cast("int")
    boxes = F.transform(F.slice(F.sequence(F.lit(0), F.lit(9)), F.lit(1), n), lambda i: F.struct(i.alias("x"), i.alias("y"), (i + 50).alias("w"), (i + 60).alias("h"), F.lit(0.9).alias("det_conf")))
    return faces.frame_stats(faces.keep_faces(e.select(F.col("user_id").alias("video_id"), boxes.alias("bboxes")), 40, 0.5))


# --- products ---------------------------------------------------------------------------------------------------------

_SUB = """k AS (SELECT user_id AS video_id, event_id AS ord, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
pick AS (SELECT video_id, n, unnest(range(0, 60)) AS r FROM (SELECT DISTINCT video_id, n FROM k WHERE n > 60)),
sub AS (SELECT k.video_id, ord, i AS rank FROM k WHERE n <= 60 UNION ALL SELECT k.video_id, k.ord, p.r FROM k JOIN pick p ON p.video_id = k.video_id AND k.i = floor(p.r * (p.n / 60.0::DOUBLE))::BIGINT WHERE k.n > 60)"""


@query(f"WITH {_SUB} SELECT video_id, ord, rank::BIGINT AS rank FROM sub")
def keyframe_subsample(spark, sf_dir):
    return products.subsample(read(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), F.col("event_id").alias("ord")), 60)


@query(f"WITH {_SUB} SELECT video_id, floor(rank / 10)::BIGINT AS batch_id, count(*) AS frames, min(ord) AS first_ord FROM sub GROUP BY 1, 2")
def vlm_batches(spark, sf_dir):
    return products.batches(keyframe_subsample(spark, sf_dir), 10).groupBy("video_id", "batch_id").agg(F.count(F.lit(1)).alias("frames"), F.min("ord").alias("first_ord"))


@query(f"""WITH {BOX_SQL}, kf AS (SELECT o_orderkey % 500 AS video_id, o_custkey % 40 AS frame_idx, max(o_orderkey) AS keyframe_ord FROM orders GROUP BY 1, 2)
SELECT b.ord, k.keyframe_ord FROM boxes b JOIN kf k ON k.video_id = b.video_id AND k.frame_idx = b.frame_idx""")
def hallucination_filter(spark, sf_dir):
    d = tables.lineitem_boxes(spark, sf_dir).withColumn("batch_id", F.lit(0)).withColumn("scene_id", F.lit("s"))
    o = read(spark, sf_dir, "orders").select((F.col("o_orderkey") % 500).alias("video_id"), (F.col("o_custkey") % 40).alias("frame_idx"), F.col("o_orderkey").alias("ord"), F.lit(0).alias("batch_id"), F.lit("s").alias("scene_id"))
    return products.back_map(d, o).select("ord", "keyframe_ord")


def _clusters(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    rows = e.select(F.col("label").cast("long").alias("video_id"), F.col("vec_id").alias("ord"), F.floor(F.col("vec_id") / 20).cast("string").alias("frame_key"), F.col("embedding").cast("array<double>").alias("embedding"))
    return products.cluster_detections(rows, 0.3)


_CLUSTERS = """d AS (SELECT label::BIGINT AS video_id, vec_id AS ord, floor(vec_id / 20)::BIGINT::VARCHAR AS frame, embedding::DOUBLE[] AS v,
    row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings),
fold AS (
  WITH RECURSIVE f(video_id, k, cs, cluster_id) AS (
    SELECT video_id, 0::BIGINT, []::STRUCT(s DOUBLE[], fr VARCHAR[])[], -1::BIGINT FROM (SELECT DISTINCT video_id FROM d)
    UNION ALL
    SELECT video_id, k, CASE WHEN cid = len(cs) THEN list_append(cs, {'s': v, 'fr': [frame]})
        ELSE list_transform(cs, lambda c, i: CASE WHEN i - 1 = cid THEN {'s': list_transform(c.s, lambda x, n: x + v[n]), 'fr': list_append(c.fr, frame)} ELSE c END) END, cid
    FROM (SELECT *, coalesce(list_max(list_filter(range(0, len(sims)), lambda n: sims[n + 1] = list_max(sims) AND sims[n + 1] >= 0.3)), len(cs)) AS cid FROM (
      SELECT f.video_id, d.k, f.cs, d.v, d.frame, list_transform(f.cs, lambda c: CASE WHEN list_contains(c.fr, d.frame) THEN -2.0::DOUBLE
        ELSE round(coalesce(list_cosine_similarity(c.s, d.v), 0), 12) END) AS sims
      FROM f JOIN d ON d.video_id = f.video_id AND d.k = f.k + 1)))
  SELECT video_id, k, cluster_id FROM f WHERE k > 0),
cl AS (SELECT d.video_id, d.ord, cluster_id, count(*) OVER (PARTITION BY d.video_id, cluster_id) AS cluster_size FROM d JOIN fold ON fold.video_id = d.video_id AND fold.k = d.k)"""


@query(f"WITH {_CLUSTERS} SELECT * FROM cl")
def product_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir)


@query(f"""WITH {_CLUSTERS}, g AS (SELECT *, ord % 37 * 10 AS x, ord % 23 * 10 AS y, ord % 29 * 8 + 8 AS w, ord % 31 * 6 + 6 AS h, (ord % 10 + 1) / 10.0::DOUBLE AS conf, (ord % 7) / 7.0::DOUBLE AS sharp FROM cl),
p AS (SELECT *, least(1.0, greatest(0.0, w * h / (640.0::DOUBLE * 360)))::DOUBLE AS prominence,
  greatest(0.0, 1 - sqrt(pow(x + w / 2.0::DOUBLE - 320, 2) + pow(y + h / 2.0::DOUBLE - 180, 2)) / sqrt(320.0::DOUBLE * 320 + 180 * 180))::DOUBLE AS centre FROM g),
q AS (SELECT *, 0.35::DOUBLE * prominence + 0.25::DOUBLE * sharp + 0.10::DOUBLE * centre + 0.15::DOUBLE * least(1.0, cluster_size / 5.0::DOUBLE) AS composite FROM p),
b AS (SELECT *, row_number() OVER (PARTITION BY video_id, cluster_id ORDER BY round(composite, 12) DESC, ord) AS rn FROM q)
SELECT video_id, cluster_id, ord, cluster_size, round_even(composite, 6)::DOUBLE AS composite, round_even(prominence, 6)::DOUBLE AS prominence,
  CASE WHEN cluster_size < 2 THEN 'single_keyframe' WHEN conf < 0.6 THEN 'low_confidence' WHEN prominence < 0.03 THEN 'low_prominence' END AS rejected_reason FROM b WHERE rn = 1""")
def product_catalog(spark, sf_dir):
    c = _clusters(spark, sf_dir)
    i = lambda f: f.cast("int")
    c = c.withColumn("x", i(F.col("ord") % 37 * 10)).withColumn("y", i(F.col("ord") % 23 * 10)).withColumn("w", i(F.col("ord") % 29 * 8 + 8)).withColumn("h", i(F.col("ord") % 31 * 6 + 6))
    c = c.withColumn("confidence", (F.col("ord") % 10 + 1) / 10.0).withColumn("sharp", (F.col("ord") % 7) / 7.0)
    w, h = F.lit(640), F.lit(360)
    c = c.withColumn("prominence", geometry.prominence(F.col("w"), F.col("h"), w, h))
    centre = geometry.centeredness(F.col("x"), F.col("y"), F.col("w"), F.col("h"), w, h)
    c = c.withColumn("composite", geometry.reference_quality(F.col("prominence"), F.col("sharp"), centre, F.lit(0.0), F.col("cluster_size")))
    best = products.pick_reference(c)
    return best.select("video_id", "cluster_id", "ord", "cluster_size", r6("composite").alias("composite"), r6("prominence").alias("prominence"),
                       products.noise_reason(F.col("cluster_size"), F.col("confidence"), F.col("prominence")).alias("rejected_reason"))


# --- blur -------------------------------------------------------------------------------------------------------------

_FRESH = f"""{BOX_SQL}, fresh AS (SELECT video_id, frame_idx, ord, confidence, CASE WHEN lower(trim(label)) IN ('brand logo', 'logo on tin can') THEN 'logo' WHEN lower(trim(label)) IN ('credit card', 'passport') THEN 'card_object'
  WHEN lower(trim(label)) = 'car license plate' THEN 'license_plate' ELSE 'object' END AS category FROM boxes WHERE frame_idx % 5 = 0 AND confidence >= 0.3)"""


def _fresh(spark, sf_dir):
    b = tables.lineitem_boxes(spark, sf_dir).withColumn("category", blur.label_category(F.col("label")))
    return blur.fresh_detections(b, 5, 0.3).select("video_id", "frame_idx", "ord", "confidence", "category")


@query(f"WITH {_FRESH} SELECT * FROM fresh")
def blur_stride_detections(spark, sf_dir):
    return _fresh(spark, sf_dir)


@query(f"""WITH {_FRESH}, fr AS (SELECT v.video_id, f.frame_idx FROM (SELECT DISTINCT video_id FROM boxes) v, (SELECT unnest(range(0, 40)) AS frame_idx) f)
SELECT fr.video_id, fr.frame_idx, ord, category, fr.frame_idx % 5 <> 0 AS from_cache FROM fr JOIN fresh d ON d.video_id = fr.video_id AND d.frame_idx = fr.frame_idx - fr.frame_idx % 5""")
def blur_carry_forward(spark, sf_dir):
    return blur.carried_detections(_frames(spark, sf_dir), _fresh(spark, sf_dir), 5).select("video_id", "frame_idx", "ord", "category", "from_cache")


def _frames(spark, sf_dir):
    v = tables.lineitem_boxes(spark, sf_dir).select("video_id").distinct()
    return v.select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(39).cast("long"))).alias("frame_idx"))


@query(f"WITH {_FRESH} SELECT video_id, " + ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in blur.CATEGORIES) + " FROM fresh GROUP BY 1")
def blur_manifest_summary(spark, sf_dir):
    return blur.summary(_fresh(spark, sf_dir))


@query(f"WITH {_FRESH} SELECT video_id, category, count(*) AS n FROM fresh GROUP BY ROLLUP (video_id, category)")
def blur_summary_rollup(spark, sf_dir):
    return blur.summary_rollup(_fresh(spark, sf_dir))


@query(f"""WITH {_FRESH}, fr AS (SELECT v.video_id, f.frame_idx, c.category FROM (SELECT DISTINCT video_id FROM boxes) v, (SELECT unnest(range(0, 40)) AS frame_idx) f, (SELECT unnest(['license_plate', 'logo']) AS category) c)
SELECT fr.video_id, fr.frame_idx, fr.category, count(d.ord) AS n_rects FROM fr LEFT JOIN fresh d ON d.video_id = fr.video_id AND d.frame_idx = fr.frame_idx AND d.category = fr.category GROUP BY ALL""")
def mask_grid(spark, sf_dir):
    rects = _fresh(spark, sf_dir).select("video_id", "frame_idx", "category", F.col("ord").alias("rect"))
    return blur.mask_grid(_frames(spark, sf_dir), rects, ("license_plate", "logo")).select("video_id", "frame_idx", "category", F.col("n_rects").cast("long"))


@query("""WITH f AS (SELECT vec_id, unnest(range(0, 10)) AS i FROM embeddings)
SELECT vec_id, i, round_even(i * 1000.0 / 29.97, 0)::BIGINT AS t_ms, least(2.0::DOUBLE + i / 10.0::DOUBLE * 93, 95)::DOUBLE AS pct FROM f""")
def frame_clock(spark, sf_dir):
    f = read(spark, sf_dir, "embeddings").select("vec_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("i"))
    return f.select("vec_id", "i", geometry.frame_ms(F.col("i"), F.lit(29.97)).alias("t_ms"), blur.progress_pct(F.col("i"), F.lit(10.0)).alias("pct"))


# --- OCR, composition, progress ---------------------------------------------------------------------------------------


@query("""WITH b AS (SELECT conv_id, turn, (turn * 37 + conv_id) % 100 / 100.0::DOUBLE AS conf FROM conversations)
SELECT conv_id, count(*) FILTER (WHERE conf >= 0.5) AS n_blocks, round_even(coalesce(avg(conf) FILTER (WHERE conf >= 0.5), 0), 6)::DOUBLE AS avg_confidence FROM b GROUP BY 1""")
def ocr_perf_summary(spark, sf_dir):
    out = records.ocr_scene_text(_blocks(spark, sf_dir))
    return out.select(F.col("scene_id").alias("conv_id"), "n_blocks", r6("avg_confidence").alias("avg_confidence"))


def _blocks(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("scene_id"), F.col("turn").alias("ord"), "text", ((F.col("turn") * 37 + F.col("conv_id")) % 100 / 100.0).alias("confidence"))


def _ocr_sql():
    """Scene text by SQL."""
    t = "coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (WHERE conf >= 0.5), '')"
    t = f"regexp_replace(regexp_replace({t}, '[{_BIDI}]', '', 'g'), '<[^>]+>', '', 'g')"
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        t = f"replace({t}, '{plain}', '{escaped}')"
    return _redact_sql(f"trim({t}, E' \\t\\n\\r')")


_OCR = f"""WITH b AS (SELECT conv_id, turn, text, (turn * 37 + conv_id) % 100 / 100.0::DOUBLE AS conf FROM conversations),
s AS (SELECT conv_id AS scene_id, {_ocr_sql()} AS t, count(*) FILTER (WHERE conf >= 0.5) AS n_blocks, coalesce(avg(conf) FILTER (WHERE conf >= 0.5), 0) AS c FROM b GROUP BY 1),
k AS (SELECT *, CASE WHEN length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g')) >= 2 THEN t ELSE '' END AS kept FROM s)
"""


@query(_OCR + "SELECT scene_id, sha256(kept) AS sha, length(kept)::BIGINT AS ocr_char_count FROM k")
def ocr_scene_text(spark, sf_dir):
    out = records.ocr_scene_text(_blocks(spark, sf_dir))
    return out.select("scene_id", F.sha2("ocr_text_raw", 256).alias("sha"), F.col("ocr_char_count").cast("long"))


@query(_OCR + """SELECT scene_id % 50 AS video_id, count(*) AS scenes, count(*) FILTER (WHERE kept <> '') AS frames_processed, count(*) FILTER (WHERE kept = '') AS frames_skipped,
  round_even(coalesce(sum(c * n_blocks) / nullif(sum(n_blocks), 0), 0), 6)::DOUBLE AS avg_confidence, 'success' AS status FROM k GROUP BY 1""")
def ocr_run_counters(spark, sf_dir):
    """The OCR flow of a recording: frames read and skipped, the mean confidence of all kept blocks, the status."""
    out = records.ocr_counters(records.ocr_scene_text(_blocks(spark, sf_dir)).withColumn("video_id", F.col("scene_id") % 50))
    return out.withColumn("avg_confidence", r6("avg_confidence"))


@query("""SELECT o_custkey % 100 AS spec_id, o_orderkey AS clip, o_orderkey % 5000 AS start_ms, o_orderkey % 5000 + o_custkey % 700 + 1 AS end_ms,
  sum(o_custkey % 700 + 1) OVER (PARTITION BY o_custkey % 100 ORDER BY o_orderkey)::BIGINT AS timeline_end_ms FROM orders""")
def composition_timeline(spark, sf_dir):
    from pyspark.sql import Window

    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("spec_id"), F.col("o_orderkey").alias("clip"), (F.col("o_orderkey") % 5000).alias("start_ms"), (F.col("o_custkey") % 700 + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("spec_id").orderBy("clip").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    o = o.withColumn("end_ms", F.col("start_ms") + F.col("n")).withColumn("timeline_start_ms", before)
    specs = o.groupBy("spec_id").agg(F.array_sort(F.collect_list(F.struct("clip", "start_ms", "end_ms", "timeline_start_ms"))).alias("scene_clips"))
    return transcode.timeline(specs).select("spec_id", "clip", "start_ms", "end_ms", "timeline_end_ms")


def _progress(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    t = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") / 1e7
    phase = F.when(F.col("event_id") % 200 < 180, "detecting").otherwise("finalizing")
    return e.select(F.col("user_id").cast("string").alias("job"), t.alias("t"), phase.alias("phase"), (F.col("event_id") / 250.0).alias("progress_pct"), F.col("event_type").alias("message"))


_JOBS = """p AS (SELECT user_id::VARCHAR AS job, date_diff('millisecond', TIMESTAMP '2024-01-01 00:00:00', date_trunc('millisecond', ts)) / 1e7::DOUBLE AS t,
    CASE WHEN event_id % 200 < 180 THEN 'detecting' ELSE 'finalizing' END AS phase, event_id / 250.0::DOUBLE AS pct, event_type AS message FROM events)"""


@query(f"""WITH RECURSIVE {_JOBS}, r AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY t, pct) AS k FROM p),
fold(job, k, lt, lp, lf, passed) AS (
  SELECT job, 0::BIGINT, 0::DOUBLE, -1::DOUBLE, '', false FROM (SELECT DISTINCT job FROM p)
  UNION ALL
  SELECT f.job, r.k, CASE WHEN go THEN r.t ELSE lt END, CASE WHEN go THEN r.pct ELSE lp END, CASE WHEN go THEN r.phase ELSE lf END, go
  FROM (SELECT f.*, r.k AS rk, r.phase <> lf OR (r.pct - lp >= 1.0 AND r.t - lt >= 0.5) AS go FROM fold f JOIN r ON r.job = f.job AND r.k = f.k + 1) f
  JOIN r ON r.job = f.job AND r.k = f.rk)
SELECT r.job, r.t, r.phase, round_even(r.pct, 2)::DOUBLE AS progress_pct, r.message FROM r JOIN fold f ON f.job = r.job AND f.k = r.k WHERE f.passed""")
def progress_throttle(spark, sf_dir):
    return progress.throttle_table(_progress(spark, sf_dir))


@query(f"""WITH RECURSIVE {_JOBS}, r AS (SELECT job, t * 60 AS t, message <> 'error' AS ok, row_number() OVER (PARTITION BY job ORDER BY t, pct) AS k FROM p),
fold(job, k, until, failed, made) AS (
  SELECT job, 0::BIGINT, '-infinity'::DOUBLE, 0::BIGINT, false FROM (SELECT DISTINCT job FROM p)
  UNION ALL
  SELECT f.job, r.k, CASE WHEN r.t < until THEN until WHEN r.ok THEN '-infinity'::DOUBLE WHEN failed + 1 >= 5 THEN r.t + 60 ELSE until END,
    CASE WHEN r.t < until THEN failed WHEN r.ok THEN 0 ELSE failed + 1 END, r.t >= until
  FROM fold f JOIN r ON r.job = f.job AND r.k = f.k + 1)
SELECT r.job, r.t, r.ok, f.made FROM r JOIN fold f ON f.job = r.job AND f.k = r.k""")
def breaker_replay(spark, sf_dir):
    p = _progress(spark, sf_dir).select("job", (F.col("t") * 60).alias("t"), (F.col("message") != "error").alias("ok"))
    return progress.replay_breaker(p)


@query("""WITH a AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings), q AS (SELECT d, x FROM a WHERE vec_id = 0),
s AS (SELECT a.vec_id, sum(a.x * q.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(q.x * q.x))) AS c FROM a JOIN q ON q.d = a.d GROUP BY 1)
SELECT vec_id, round_even(c, 6)::DOUBLE AS cosine FROM s""")
def vector_cosine(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    q = e.where("vec_id = 0").limit(1).select(F.col("v").alias("q"))  # one row
    return e.crossJoin(F.broadcast(q)).select("vec_id", r6(vectors.cosine(F.col("v"), F.col("q"))).alias("cosine"))
