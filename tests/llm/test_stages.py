"""The pipeline's stages on nulls, empty tables, repeated rows and clashing names, and the tables they keep."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cinelake.llm import scratch, stages
from tests.llm.util import docs_of

CLASH = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines string, n_dropped string, lang_pred string, "
    "score string, class_id string, n_hit string, contaminated string, size string, copies string, key string, id string"
)
PROSE = (
    "we walk to the market every morning and buy some fresh bread there",
    "she has written three long letters to her old friend in the north",
    "nobody knows why the old clock in the tower has stopped at noon",
    "they were playing cards in the garden until it began to rain hard",
)


def clashing(spark, texts):
    rows = [(i, t, "en", "ab"[(i or 0) % 2], len(t or ""), *["mine"] * 11) for i, t in texts]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture
def bench_dir(spark, tmp_path):
    rows = [(1, "the quick brown fox jumps over the lazy dog and then it goes to sleep"), (2, None), (None, "  ")]
    spark.createDataFrame(rows, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stage_keeps_columns_that_clash(spark, bench_dir, name, stage):
    docs = clashing(spark, [(i, t) for i, t in enumerate(PROSE)] + [(None, PROSE[0] + " once more then"), (9, None), (10, "")])
    out = stage(spark, docs, bench_dir)
    assert out.schema == docs.schema
    rows = out.collect()
    assert {r["doc_id"] for r in rows} >= set(range(len(PROSE)))
    assert all(r["n_lines"] == r["n_dropped"] == r["score"] == r["lang_pred"] == r["size"] == "mine" for r in rows)
    assert stage(spark, docs.limit(0), bench_dir).count() == 0


def test_mixing_stage_replaces_its_own_columns_only(spark, bench_dir):
    out = stages.mixing_stage(spark, clashing(spark, [(i, t) for i, t in enumerate(PROSE)]), bench_dir)
    assert all(r["lang_pred"] == "mine" and r["size"] == len(r["text"].split()) for r in out.collect())
    assert stages.mixing_stage(spark, docs_of(spark, empty=True), bench_dir).count() == 0


def test_repeated_rows(spark, bench_dir):
    docs = clashing(spark, [(1, PROSE[0]), (1, PROSE[0]), (2, PROSE[1])])
    assert stages.language_id(spark, docs, bench_dir).count() == 3
    assert stages.line_dedup(spark, docs, bench_dir).count() == 3  # rows that agree are one occurrence
    assert [r["doc_id"] for r in stages.near_dedup(spark, docs, bench_dir).orderBy("doc_id").collect()] == [1, 2]
    assert stages.decontamination(spark, docs, bench_dir).count() == 3


def test_language_stage_without_labels(spark, bench_dir):
    """Nothing can be learned: only texts without a letter go."""
    docs = docs_of(spark, [(1, "words", None, "a", 1, 1, "x", "y"), (2, "123", None, "a", 1, 1, "x", "y"), (3, None, None, "a", 1, 1, "x", "y")])
    assert [r["doc_id"] for r in stages.language_id(spark, docs, bench_dir).collect()] == [1]


def test_line_stage_drops_what_is_left_blank(spark, bench_dir):
    docs = clashing(spark, [(1, PROSE[0]), (2, f"\n{PROSE[0]}\n\t\n　"), (3, "\n\n"), (4, f"{PROSE[0]}\nx"), (5, "")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages.line_dedup(spark, docs, bench_dir).collect()}
    assert got == {1: (PROSE[0], len(PROSE[0])), 3: ("\n\n", 2), 4: ("x", 1), 5: ("", 0)}


def test_decontamination_stage_drops_small_shares(spark, bench_dir):
    passage = "The quick brown fox jumps over the lazy dog, and then it goes."
    docs = clashing(spark, [(1, " ".join(PROSE) * 30 + " " + passage + " " + PROSE[1]), (2, " ".join(PROSE) * 30), (3, passage)])
    assert [r["doc_id"] for r in stages.decontamination(spark, docs, bench_dir).collect()] == [2]


def test_near_stage_keeps_first(spark, bench_dir):
    long = " ".join(PROSE) * 3
    docs = clashing(spark, [(4, long + " end"), (2, long), (7, "other words " * 20), (9, None)])
    assert sorted(r["doc_id"] for r in stages.near_dedup(spark, docs, bench_dir).collect()) == [2, 7, 9]


def test_scratch_is_cleared(spark):
    at = scratch.mark()
    s = scratch.Scratch(spark, "t")
    a, b = s.keep(spark.range(3)), s.keep(spark.range(5))
    s.release(b)
    folder = s.base.removeprefix("file://")
    assert len(os.listdir(folder)) == 1 and b.agg(F.count(F.lit(1))).first()[0] == 5
    scratch.clear(spark, at)
    assert not os.path.exists(folder) and scratch.mark() == at


def test_scratch_tables_have_small_row_groups(spark):
    """A row group is a batch of the reader: wide rows, some narrow ones first, must not make one of the whole file."""
    import pyarrow.parquet as pq

    at = scratch.mark()
    s = scratch.Scratch(spark, "t")
    # About 720 KB a row from row 40 on, like a segment of the index; hashes don't compress.
    wide = F.transform(F.sequence(F.lit(1), F.when(F.col("id") < 40, 1).otherwise(90_000)), lambda i: F.xxhash64(i, F.col("id")))
    kept = s.keep(spark.range(0, 160, 1, 1).select("id", wide.alias("terms")))
    assert kept.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first() == (160, 40 + 120 * 90_000)
    folder = s.kept[0][1].removeprefix("file://")
    sizes = []
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            meta = pq.read_metadata(f"{folder}/{f}")
            sizes += [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert sum(sizes) > 80e6 and max(sizes) <= scratch.ROW_GROUP_BYTES + scratch.CHECK_ROWS * 800_000
    scratch.clear(spark, at)
