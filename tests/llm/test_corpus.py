"""Decontamination, mixing, HTML extraction, the pipeline, and the registration."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelake.llm import decontam, html, mixing
from tests.llm.util import docs_of, odd_rows, real_docs, words_of


def brute_contamination(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        names = sorted(str(x) for x in found if x is not None)
        out[doc] = (len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), 0 < len(hit) and 20 * len(hit) >= len(w))
    return out


def contamination_of(docs, bench, **how):
    rows = decontam.decontaminate(docs, bench, **how).collect()
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}


@pytest.mark.parametrize("how", [{}, {"chunk": 3, "segment_bytes": 2000}])
def test_contamination_real(spark, sf_dir, how):
    docs, bench = real_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert contamination_of(docs, bench, **how) == want
    assert any(x[4] for x in want.values())


def test_contamination_random(spark):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 16)))) for i in range(30)]
    items += [(3, "a a a a"), (None, "b b b b"), (40, None), (41, "?!"), (42, "Ünique WORD")]
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(40)] + [(90, "ünique word"), (91, "Ünique, wOrd")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = contamination_of(docs_of(spark, [(i, t, "en", "a", 1, 1, "x", "y") for i, t in docs]), bench, segment_bytes=100)
    assert got == brute_contamination(docs, items)


def test_contamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, "the same words stand here twice in one table of rows")], "item_id bigint, text string")
    rows = decontam.decontaminate(docs_of(spark), bench).collect()
    assert len(rows) == len(odd_rows()) and {r["doc_id"] for r in rows if r["contaminated"]} == {4, 5}
    assert decontam.decontaminate(docs_of(spark, empty=True), bench).count() == 0
    assert not decontam.decontaminate(docs_of(spark), bench.limit(0)).where("n_hit > 0").count()


def brute_near(docs, items, span, size=13):
    out = {}
    for doc, text in docs:
        w, found = words_of(text), set()
        for item, t in items:
            x = words_of(t)
            for i in range(max(1, len(x) - size + 1)) if x else ():
                want = set(x[i : i + size])
                if any(want <= set(w[a : a + span]) for a in range(len(w))):
                    found.add(str(item))
                    break
        out[doc] = (len(w), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out


def test_growing_tables_are_not_broadcast(spark, sf_dir, monkeypatch):
    """The files of postings and hits are a fiftieth of what their rows take in a broadcast: their size must not decide."""
    plans = {}

    def keep(self, df, label="t", old=decontam.Scratch.keep):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return old(self, df, label)

    monkeypatch.setattr(decontam.Scratch, "keep", keep)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") in ("10485760b", "10485760", "10MB")
    out = decontam.decontaminate(real_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    plans["out"] = out._jdf.queryExecution().sparkPlan().toString()
    for label in ("owners", "met", "facts", "out"):
        assert "SortMergeJoin" in plans[label] and "BroadcastHashJoin" not in plans[label], label
    assert plans["hits"].count("BroadcastHashJoin") <= 1 and "SortMergeJoin" in plans["hits"]  # the numbers of lists by segment


@pytest.mark.parametrize("span", [1, 4, 9, 26])
def test_proximity_brute_force(spark, span):
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefgh")
    items = [(i, " ".join(word() for _ in range(rng.choice((1, 2, 3, 5, 15))))) for i in range(12)] + [(50, None), (51, "zz")]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    table = docs_of(spark, [(i, t, "en", "a", 1, 1, "x", "y") for i, t in docs])
    rows = decontam.proximity_matches(table, bench, span, segment_bytes=90).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_near_items"], r["near_items_sha256"]) for r in rows}
    assert got == brute_near(docs, items, span) and any(x[1] for x in got.values())


def test_proximity_holds_exact_hits(spark, sf_dir):
    docs, bench = real_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    near = {r["doc_id"]: r["n_near_items"] for r in decontam.proximity_matches(docs, bench).collect()}
    exact = decontam.decontaminate(docs, bench).collect()
    assert any(r["n_items"] for r in exact) and all(near[r["doc_id"]] >= r["n_items"] for r in exact)


def test_gap_code():
    x = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**32 - 1])
    assert (decontam.decode_gaps(decontam.encode_gaps(x)) == x).all()
    assert len(decontam.decode_gaps(b"")) == 0


def targets_of(sizes, weights=(5, 2, 1), cap=3):
    """The contract's own words: share, cap, reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, fixed = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(cap * sizes[s] for s in fixed)
        free = [s for s in names if s not in fixed]
        out = {s: cap * sizes[s] if s in fixed else left * w[s] / sum(w[x] for x in free) for s in names}
        above = {s for s in free if out[s] > cap * sizes[s]}
        if not above:
            return out
        fixed |= above


def test_mix_targets(spark):
    rng = random.Random(4)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice((0, 1, 10, 500, 100_000)) for i in range(rng.randint(1, 9))} | {None: 7, "é": 3}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = targets_of(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def check_mix(rows, texts):
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    want = targets_of({s: sum(r["size"] for r in x) for s, x in by.items()})
    for s, x in by.items():
        assert {r["source_size"] for r in x} == {sum(r["size"] for r in x)}
        assert abs(x[0]["target"] - want[s]) < 1e-6 * max(1, want[s])
        largest = max(r["size"] for r in x)
        assert abs(sum(r["taken"] for r in x) - want[s]) <= max(largest / 2, 1) + 1e-6
    for r in rows:
        assert r["size"] in texts[r["doc_id"]]


def test_mix_real(spark, sf_dir):
    docs = real_docs(spark, sf_dir)
    rows = mixing.mix_sources(docs).collect()
    check_mix(rows, {r["doc_id"]: {len(mixing_words(r["text"]))} for r in docs.collect()})
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in rows) == sorted((r["doc_id"], r["copies"]) for r in again)


def mixing_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix_odd_rows_and_small_groups(spark):
    rows = mixing.mix_sources(docs_of(spark), fan_in=2).collect()
    assert len(rows) == len(odd_rows())
    texts = {}
    for r in odd_rows():
        texts.setdefault(r[0], set()).add(len(mixing_words(r[1])))
    check_mix(rows, texts)
    many = [(i % 150, "w " * (1 + i % 7), "en", "ab"[i % 2], 1, 1, "x", "y") for i in range(600)]
    rows = mixing.mix_sources(docs_of(spark, many), fan_in=4).collect()
    assert len(rows) == 600
    check_mix(rows, {i: set(range(1, 8)) for i in range(150)})
    assert mixing.mix_sources(docs_of(spark, empty=True)).count() == 0


def test_mix_salted_join_agrees(spark, monkeypatch):
    plain = {(r["doc_id"], r["copies"]) for r in mixing.mix_sources(docs_of(spark)).collect()}
    monkeypatch.setattr(mixing, "MAX_BROADCAST_BYTES", 0)
    assert plain == {(r["doc_id"], r["copies"]) for r in mixing.mix_sources(docs_of(spark)).collect()}


def test_mix_expectations(spark):
    """Over many like sources a document's mean copies come near its source's rate, whatever its size.

    Only the last fraction of a source is rounded to the nearest, so sources have many documents."""
    sizes = (1, 2, 3, 5, 8, 40) * 20
    rows = [(s * 1000 + i, "w " * n, "en", f"{s:04}", 1, 1, "x", "y") for s in range(60) for i, n in enumerate(sizes)]
    got = {}
    for r in mixing.mix_sources(docs_of(spark, rows), fan_in=4).collect():
        got.setdefault((int(r["source"]) % 3, r["size"]), []).append((r["copies"], r["target"] / r["source_size"]))
    for seen in got.values():
        rate = seen[0][1]
        spread = (max(rate % 1 * (1 - rate % 1), 0.01) / len(seen)) ** 0.5
        assert len(seen) == 400 and abs(np.mean([x for x, _ in seen]) - rate) < 4 * spread


def test_mix_repeated_rows_with_other_columns(spark):
    rows = [(1, "some words stand here", "en", "a", i, i, "x", "y") for i in range(5)] + [(2, "w " * 9, "en", "b", 1, 1, "x", "y")]
    runs = [sorted((r["n_chars"], r["copies"]) for r in mixing.mix_sources(docs_of(spark, rows).repartition(n)).collect()) for n in (1, 3)]
    assert runs[0] == runs[1]


def test_mix_uses_no_python(spark, sf_dir):
    plan = mixing.mix_sources(real_docs(spark, sf_dir))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


PAGES = [
    ("<html><head><title>T</title></head><body><nav><ul><li>Home</ul></nav><article><h1>A &amp; B</h1><p><b>One<br>two<p>Three &eacute;&nbsp; x</p></article><footer>f</footer>", "A & B\n\nOne two\n\nThree é x"),
    ("<div id=content><h2>H</h2><p>Body text of the page here</p><div class='comments'><p>nice</p></div></div><aside>s</aside>", "H\n\nBody text of the page here"),
    ("<main><header><h1>T</h1><p>by x</p></header><p>a</p><form><p>f</p></form><ul><li>i<li>j</ul></main>", "T\n\na\n\ni\n\nj"),
    ("<script>var x='<p>no</p>';</script><p>yes<!-- no --></p><style>p{}</style>", "yes"),
    ("<body><div class='sidebar'>s</div><div class='cookie-notice'>c</div><p>t1<p>t2<div role=banner>b</div>tail", "t1\n\nt2\n\ntail"),
    ("<article><p>1 < 2 and a &lt;b&gt; <unclosed", "1 < 2 and a <b> <unclosed"),
    ("<article class=comment><p>reply reply reply reply</p></article><article><p>main</p></article>", "main"),
    ("", ""), (None, ""), ("<p>", ""), ("plain text", "plain text"), ("</p></div><p a='>'>q</p>", "q"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><pre>x\n  y</pre></article>", "a b\n\nc\n\nx y"),
    ("<div class='layout-with-sidebar'><article><p>kept</p></article></div>", "kept"),
    ("<div class='right-sidebar'><main><p>kept too</p></main></div>", "kept too"),
    ("<div class='content page-hidden-nav'><p>a</p><p>b</p></div>", "a\n\nb"),
    ("<div class='post-share'><p>all the text there is</p></div>", "all the text there is"),
    ("<article><div class='notice-period'>n</div><div class=ad-hoc>a</div><p class='social-science'>s</p><div class='related-work'>r</div></article>", "n\n\na\n\ns\n\nr"),
    ("<article><p>t</p><div class='share-buttons'>x</div><div class='site-footer'>y</div><div id=adBanner>z</div><div class='cookie-notice'>c</div></article>", "t"),
    ("<article><p>first</p></article><div>beside</div><article><p>second and longer</p></article>", "first\n\nsecond and longer"),
    ("<main><p>before</p><article><p>inside</p></article><p>after</p></main>", "before\n\ninside\n\nafter"),
    ("<article><p>t</p></article><div class=comments><article>I am a much longer comment than the article is</article></div>", "t"),
    ("<p>t</p><div class=comments><p>" + "a comment " * 50 + "</p></div>", "t"),
    ("<div role=article><p>by role</p></div><p>x</p>", "by role"),
]


def test_main_text(spark):
    rows = [(i, "http://h/", p, "clash", i) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>z</p>", "", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(pages).collect()}
    assert got == {i: t for i, (_, t) in enumerate(PAGES)} | {None: "z"}
    assert html.extract_main_text(pages.limit(0)).count() == 0


def template_pages(n=12):
    rows = []
    for i in range(n):
        rows.append((i, "http://a.net/%d" % i, f"<body><div><p>Site name</p><p>All rights</p></div><div><p>Text number {i} of the site</p></div></body>"))
        rows.append((100 + i, "http://B.net/%d" % i, f"<article><p>Same lead</p><p>Own {i} text is longer than that</p><div>Share this</div><p><a>Read</a> more <a>here too</a></p></article>"))
        rows.append((200 + i, "http://c.net/%d" % i, "<body><p>An article that was copied</p></body>"))
    for i in range(100):  # recurs on 21 of 100 pages, then on 15
        more = "<div>Our notice</div>" * (i < 21) + "<div>Some pages only</div>" * (i < 15)
        rows.append((300 + i, "http://d.net/%d" % i, f"<article><p>Page number {i} with a text of its own</p>{more}</article>"))
    return rows


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_site_templates(spark, monkeypatch, limit):
    monkeypatch.setattr(html, "MAX_BROADCAST_BYTES", limit)
    pages = spark.createDataFrame(template_pages(), "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(pages).collect()}
    for i in range(12):
        assert got[i] == f"Text number {i} of the site"
        assert got[100 + i] == f"Same lead\n\nOwn {i} text is longer than that"
        assert got[200 + i] == "An article that was copied"
    for i in range(100):
        assert got[300 + i] == f"Page number {i} with a text of its own" + "\n\nSome pages only" * (i < 15)


def test_template_counts_brute_force(spark, sf_dir):
    """Against a plain count in Python over fixtures and real pages."""
    real = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    for rows in (template_pages() + template_pages()[:40] + [(1, None, None)], real):
        per, contents = {}, {}
        for _, url, page in rows:
            content, found = html.candidates(page or "")
            host = (url or "").split("://")[-1].split("/")[0].split("?")[0].split("#")[0].lower() if url else ""
            contents.setdefault(host, set()).add(content)
            for d in found:
                per.setdefault((host, d - (1 << 63)), set()).add(content)
        want = {k for k, v in per.items() if len(v) >= max(html.MIN_PAGES, html.SPREAD * len(contents[k[0]]) ** 0.5)}
        pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
        got = html.site_templates(pages).collect()
        assert len(got) == len(want) and {(r["host"], r["subtree"]) for r in got} == want


def test_deep_page_does_not_break():
    assert html.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert html.main_text("<a " * 20_000) == "<a " * 19_999 + "<a"


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = real_docs(spark, sf_dir)
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        assert before // 2 < docs.count() <= before
    out = corpus_pipeline.run(spark, sf_dir)
    assert set(columns) < set(out.columns) and out.count() == docs.count()
    assert out.select(F.sum("taken")).first()[0] > 0


def test_registration():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 11)} == {x.split("_")[0] + "_" for x in names if x.startswith("op")}
