"""Every stage of the pipeline against plain Python, each on its own input, and the whole run."""

import math
from collections import Counter, defaultdict

import corpus_pipeline
from cinelake.llm import langid, stages
from pyspark.sql import functions as F
from tests.llm.test_corpus import brute_contamination, check_mix, mixing_words
from tests.llm.test_dedup import brute_classes, distance_one
from tests.llm.util import real_docs


class Ppm:
    """Escape method C over byte contexts of up to three bytes, straight from counts."""

    def __init__(self, texts):
        self.tables = [defaultdict(Counter) for _ in range(4)]
        for t in texts:
            data = b"   " + t.encode()
            for i in range(3, len(data)):
                for n in range(4):
                    self.tables[n][data[i - n : i]][data[i]] += 1
        self.known = {}

    def price(self, run):
        if run not in self.known:
            bits = 0.0
            for n in (3, 2, 1, 0):
                seen = self.tables[n].get(run[3 - n : 3])
                if seen:
                    total = sum(seen.values()) + len(seen)
                    if run[3] in seen:
                        bits -= math.log2(seen[run[3]] / total)
                        break
                    bits -= math.log2(len(seen) / total)
            else:
                bits += 8
            self.known[run] = bits
        return self.known[run]

    def bits(self, text):
        data = b"   " + text.encode()
        return sum(self.price(data[i - 3 : i + 1]) for i in range(3, len(data)))


def brute_language(spark, docs):
    """Ids that stay. The sample and its halves are read off the table, as they are draws of a hash."""
    half = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(2))
    sample = langid.learned(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang").select("text", "lang", half.alias("half")).collect()
    langs = sorted({r["lang"] for r in sample})
    models = {k: {x: Ppm([r["text"] for r in sample if r["lang"] == x and r["half"] in k]) for x in langs} for k in ((0,), (1,), (0, 1))}

    def judge(text, which):
        bits = {x: m.bits(text) for x, m in models[which].items()}
        least = min(bits.values())
        return least, 1 / sum(2.0 ** max(least - b, -1000) for b in bits.values())

    rate = lambda r: (judge(r["text"], (1 - r["half"],))[0] - stages.SLACK_BITS) / len(r["text"].encode())
    most = max([1.0, *(rate(r) for r in sample if any(c.isalpha() for c in r["text"]))])
    kept = set()
    for r in docs.collect():
        if r["text"] and any(c.isalpha() for c in r["text"]):
            bits, score = judge(r["text"], (0, 1))
            if score >= stages.MIN_SCORE and bits <= stages.SLACK_BITS + stages.ALLOWANCE * most * len(r["text"].encode()):
                kept.add(r["doc_id"])
    return kept


def brute_stage_lines(rows):
    """Copies of any line go, lines of 20 characters or more within one edit of an earlier one too."""
    seen, by_length, out = set(), {}, {}
    for i, text in sorted(rows):
        kept = []
        lines = text.split("\n")
        for line in lines:
            s = " ".join(line.lower().split())
            near = len(s) >= 20 and any(distance_one(s, t) for n in (len(s) - 1, len(s), len(s) + 1) for t in by_length.get(n, ()))
            if not s or not (s in seen or near):
                kept.append(line)
            if s and s not in seen:
                seen.add(s)
                if len(s) >= 20:
                    by_length.setdefault(len(s), []).append(s)
        if len(kept) == len(lines) or "".join(kept).strip():
            out[i] = "\n".join(kept)
    return out


def test_stages_brute_force(spark, sf_dir, tmp_path):
    docs = real_docs(spark, sf_dir)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    wants = {
        "language_id": lambda: {i: rows[i] for i in brute_language(spark, docs)},
        "line_dedup": lambda: brute_stage_lines(rows.items()),
        "near_dedup": lambda: {i: rows[i] for i, c in brute_classes(sorted(rows.items())).items() if i == c or not rows[i]},
        "decontamination": lambda: {i: rows[i] for i, x in brute_contamination(rows.items(), bench).items() if not x[1]},
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = wants[name]()
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got = docs.collect()
        assert {r["doc_id"]: r["text"] for r in got} == want and len(got) == len(want), name
        rows = want
    out = corpus_pipeline.run(spark, sf_dir)
    mixed = out.collect()
    assert {r["doc_id"]: r["text"] for r in mixed} == rows and len(mixed) == len(rows)
    check_mix(mixed, {i: {len(mixing_words(t))} for i, t in rows.items()})
    assert all(r["n_chars"] == len(r["text"]) for r in mixed)
