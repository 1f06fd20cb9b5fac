"""Line dedup, near-dedup against brute force."""

import random

import pytest

from cinelake.llm import linededup, neardup, queries, stages
from tests.llm.util import docs_of, odd_rows, real_docs, words_of


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return a == b
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return long[i + 1 :] == short[i:]


def brute_lines(rows, min_chars=20, edits=1):
    """rows: distinct (doc_id, text) in order -> text without lines that an earlier one repeats."""
    seen, out, by_len = set(), {}, {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if text is None:
            out[i] = None
            continue
        kept = []
        for line in text.split("\n"):
            s = linededup.normal(line)
            if len(s) >= min_chars:
                near = edits and any(distance_one(s, t) for n in (len(s) - 1, len(s), len(s) + 1) for t in by_len.get(n, ()))
                if s not in seen and not near:
                    kept.append(line)
                if s not in seen:
                    seen.add(s)
                    by_len.setdefault(len(s), []).append(s)
            else:
                kept.append(line)
        out[i] = "\n".join(kept)
    return out


def planted_lines():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdef ghij") for _ in range(rng.randint(20, 60))).strip() + "x" * 5 for _ in range(40)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 5)):
            s = rng.choice(base)
            how, at = rng.random(), rng.randrange(len(s))
            if how < 0.2:
                s = s[:at] + rng.choice("qz") + s[at + 1 :]
            elif how < 0.4:
                s = s[:at] + rng.choice("qzab") + s[at:]
            elif how < 0.6:
                s = s[:at] + s[at + 1 :]
            elif how < 0.7:
                s = "  " + s.upper() + "  "
            lines.append(s)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("edits", [0, 1])
def test_lines_brute_force(spark, edits):
    rows = planted_lines()
    docs = docs_of(spark, [(i, t, "en", "a", 1, 1, "x", "y") for i, t in rows])
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs, max_edits=edits).collect()}
    assert got == brute_lines(rows, edits=edits)


def test_lines_real(spark, sf_dir):
    docs = real_docs(spark, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}
    assert got == brute_lines(rows)


def test_short_lines_exact_copies(spark, tmp_path):
    """Every non-empty line is compared; those under MIN_CHARS for exact copies only."""
    rows = [(1, "les.\nand ornd.\n\nless."), (2, "  LES.\n\nand  ornd.\nand ornd"), (3, "les."), (4, "a\na\n \n\nb"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {1: "les.\nand ornd.\n\nless.", 2: "\nand ornd", 3: "", 4: "a\n \n\nb", 5: None}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.op4_line_dedup(spark, str(tmp_path)), linededup.dedup_lines(docs, exact_chars=1)):
        assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    staged = stages.line_dedup(spark, docs, "")
    assert {r["doc_id"]: r["text"] for r in staged.collect()} == {k: v for k, v in want.items() if k != 3}


def test_lines_odd_rows(spark):
    got = linededup.dedup_lines(docs_of(spark)).collect()
    assert len(got) == len(odd_rows())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[1] == [""] and by[2] == [None] and len(by[4][0]) > 20
    assert by[5] == ["", ""]  # both rows repeat document 4
    assert by[7] == ["\n\n\t 　"]
    assert linededup.dedup_lines(docs_of(spark, empty=True)).count() == 0


def bag(text):
    w = words_of(text)
    out = {}
    for i in range(max(1, len(w) - 4)) if w else ():
        k = tuple(w[i : i + 5])
        out[k] = out.get(k, 0) + 1
    return out


def jaccard(a, b):
    shared = sum(min(n, b.get(k, 0)) for k, n in a.items())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def brute_classes(rows, threshold=0.8):
    """(id, text) -> class by id, over all pairs that share a shingle."""
    bags = [bag(t) for _, t in rows]
    index, parent = {}, list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, b in enumerate(bags):
        near = {j for k in b for j in index.get(k, ())}
        for j in near:
            if jaccard(b, bags[j]) >= threshold:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
        for k in b:
            index.setdefault(k, []).append(i)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def near_copies(n=60, seed=3):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(500)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(30, 300))]
        for _ in range(rng.choice((1, 2, 5, n if g == 0 else 3))):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 50))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w) + rng.choice(("", "."))))
    rng.shuffle(rows)
    return rows


def test_near_copies_brute_force(spark):
    rows = near_copies()
    docs = docs_of(spark, [(i, t, "en", "a", 1, 1, "x", "y") for i, t in rows])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_classes(sorted(rows))


def spread_copies():
    """A group with similarities from 0.5 to 1, as large buckets hold."""
    rng = random.Random(8)
    base = ["w%d" % rng.randrange(900) for _ in range(120)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "x%d" % rng.randrange(10**6)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("small, block, size", [(32, 384, 1 << 23), (3, 8, 1 << 23), (1, 1, 1 << 23), (3, 384, 9000)])
def test_spread_copies_brute_force(spark, monkeypatch, small, block, size):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", size)
    rows = spread_copies()
    docs = docs_of(spark, [(i, t, "en", "a", 1, 1, "x", "y") for i, t in rows])
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    want = brute_classes(rows)
    assert got == want and 3 < len(set(want.values())) < 140


def test_near_real(spark, sf_dir):
    docs = real_docs(spark, sf_dir)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)
    kept = sorted(r["doc_id"] for r in neardup.keep_first(docs).collect())
    assert kept == sorted(set(got.values()))


def test_near_odd_rows(spark):
    got = {(r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(docs_of(spark)).collect()}
    assert got == {(1, 1), (2, 2), (None, None), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8)}
    kept = [r["doc_id"] for r in neardup.keep_first(docs_of(spark)).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, None, 3, 4, 6, 7, 8], key=str)
    assert neardup.near_duplicates(docs_of(spark, empty=True)).count() == 0


def test_rows_repeated_in_full_keep_one(spark):
    rows = [(1, "one text that is here three times over", "en", "a", 1, 1, "x", "y")] * 3
    assert neardup.keep_first(docs_of(spark, rows)).count() == 1


def test_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 400).astype(np.uint64)
    wa, wb = rng.integers(1, 9, 400), rng.integers(1, 9, 400)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    hits = []
    for salt in range(30):
        x = np.sort(neardup.mix64(h + np.uint64(salt)))
        two = neardup.signatures(np.concatenate([x, x]), np.repeat([0, 1], 400), np.concatenate([wa, wb]), 2)
        hits.append((two[0] == two[1]).mean())
    assert abs(np.mean(hits) - true) < 0.02


def test_components_of_paths(spark, sf_dir):
    from cinelake.llm.scratch import Scratch

    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 300)]
    df = spark.createDataFrame(links, "x bigint, y bigint")
    got = {r["x"]: r["root"] for r in neardup.components(df, Scratch(spark, "t")).collect()}
    want = {i: 0 for i in range(1, 41)} | {101: 100, 102: 100, 300: 200}
    assert got == want
