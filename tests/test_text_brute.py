"""Queries without SQL, held against plain Python: findings of personal data and cleaned captions."""

import re

import __spark_entry__ as e
from cinelake.functions import text
from pyspark.sql import functions as F


def plain_findings(t):
    rules = {
        "kr_rrn": r"\b\d{6}[-–]\d{7}\b",
        "credit_card": r"\b(?:4\d{12}(?:\d{3})?|5[1-5]\d{14}|3[47]\d{13}|6(?:011|5\d{2})\d{12})\b",
        "kr_phone": r"(?<!\d)(?:\+82[\s)\-–.]*0?|0)(?:2|1[016789]|[3-6]\d)[-–.\s]?\d{3,4}[-–.\s]?\d{4}(?!\d)",
        "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
        "kr_license_plate": r"(?:[가-힣]{2}\s*)?\d{2,3}\s*[가-힣]\s*\d{4}",
    }
    found = [(m.start(), k, name, m[0], m.end()) for k, (name, rule) in enumerate(rules.items()) for m in re.finditer(rule, t or "")]
    return [(name, match, start, end) for start, _, name, match, end in sorted(found)]


def plain_caption(t):
    """The steps of the survey, one by one."""
    if t is None:
        return None
    t = t.strip()[:500].strip()
    t = re.sub(r"^'+|'+$", "", re.sub(r'^"+|"+$', "", t)).strip()
    t = "".join(c for c in t if not (0x4E00 <= ord(c) <= 0x9FFF or 0x3040 <= ord(c) <= 0x30FF or 0x3400 <= ord(c) <= 0x4DBF or 0xF900 <= ord(c) <= 0xFAFF or 0x20000 <= ord(c) <= 0x2A6DF))
    t = re.sub(r"\([^)]*[a-zA-Z]{3,}[^)]*\)", "", t)
    t = re.sub("|".join(text.CAPTION_OPENERS), "", t)
    t = re.sub(r"\s{2,}", " ", t).strip()
    for cut in text.CAPTION_CUTS:
        t = re.split(rf"\s*(?:{cut})", t, maxsplit=1)[0]
    t = re.sub(r"\s*[,.]?\s*$", "", t, count=1)
    if t and t[-1] not in ".!?다요죠니까":
        last = max(t.rfind(x) for x in (". ", "다. ", "니다.", "요."))
        if last > len(t) // 3:
            t = t[: last + 1 + (2 if t[last : last + 3] == "다. " else 0)]
    return t.strip()


def test_registered_findings(spark, sf_dir):
    got = {}
    for r in e.queries()["pii_spans"](spark, sf_dir).collect():
        got.setdefault(r["doc_id"], []).append((r["category"], r["match"], r["start"], r["end"]))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {r["doc_id"]: found for r in docs if (found := plain_findings(r["text"]))}
    assert got == want and want


def test_registered_captions(spark, sf_dir):
    got = {r["doc_id"]: r["caption"] for r in e.queries()["caption_clean"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert got == {r["doc_id"]: plain_caption(r["text"]) for r in docs}


def test_direction_controls_and_scripts(spark):
    rows = spark.createDataFrame([("a\u202eb\u2066c\u200f",), ("xあ中豈\U00020000y가",)], "t string")
    got = [tuple(r) for r in rows.select(F.regexp_replace("t", text.BIDI, ""), F.regexp_replace("t", text.HAN_KANA, "")).collect()]
    assert got[0][0] == "abc" and got[1][1] == "xy가"
