"""Near-duplicate documents by DartMinHash over weighted word shingles.

Features: runs of five words (see textcore), weighted by how often they occur; similarity is the weighted Jaccard index.
Signature: every element throws hashed darts: in each of its weight regions [0,1), [1,2), [2,4), ... they arrive as a
Poisson process in rank, at the rate of the region's width, each with a weight inside the region and one of K
coordinates. Darts above the element's weight miss. A document looks only at ranks low enough for about K ln K + 2 K
darts, whatever its weight, and doubles that limit while a coordinate has no dart; per coordinate it keeps the earliest.
Two documents agree in a coordinate with a probability equal to their similarity.

Join: coordinates are banded (BANDS x ROWS). The aim is the components of the links, so pairs that are in one component
already need no comparison. Each document is first compared, by exact similarity, with one first member of its buckets;
then with the first members of its other buckets where the components differ. After that a member is in the component of
its bucket's first member or has failed against it. What is left are the pairs of a bucket in different components:
in buckets of at most SMALL they are listed, in larger ones compared in cells of two blocks of bounded bytes, as matrix
products that give rows only for links. So every pair that shares a bucket is compared or connected, whatever the bucket's
size, and no list of pairs grows with the square of a bucket. Components are found by large-star and small-star rounds on
tables. Different texts are told apart by 128 bits and numbered, so that links never mix up two of them.

Defined results: equal texts are one class; a null text, and one without words, is a class of its own row's id; a text of
fewer than five words has one shingle of all its words; repeated rows share a class; null ids come last and get the class
of the group, or null alone; an empty table gives an empty table; extra columns are not read. Texts are read in slices, one
longer than a slice alone, so memory grows with the longest text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.scratch import Scratch
from cinelake.llm.textcore import U64, mix64, shingles, slices, weighted, words

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
K = BANDS * ROWS
DARTS = K * math.log(K) + 2 * K
SMALL = 32  # members of a bucket whose open pairs are listed
BLOCK, BLOCK_BYTES = 384, 8 << 20  # members in a block of a cell, and bytes of their features
CHUNK = 256  # comparisons with one document that go to one task's key


def _uniform(h: np.ndarray) -> np.ndarray:
    """(0, 1] from 64-bit hashes."""
    return ((h >> U64(11)).astype(np.float64) + 1) / float(1 << 53)


def darts(h: np.ndarray, d: np.ndarray, w: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, coordinate, rank, dart) of every dart below the documents' rank limits that hits its element's weight."""
    out = []
    level, low = 0, 0.0
    while len(h):
        width = 1.0 if level == 0 else low
        state = mix64(h ^ U64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        doc, weight, rank = d, w, np.zeros(len(h))
        while len(state):
            rank = rank - np.log(_uniform(state)) / width
            ok = rank < limit[doc]
            state, doc, weight, rank = state[ok], doc[ok], weight[ok], rank[ok]
            body = mix64(state ^ U64(0x5851F42D4C957F2D))
            hit = low + width * _uniform(mix64(body)) <= weight
            out.append((doc[hit], (body[hit] % U64(K)).astype(np.int64), rank[hit], body[hit]))
            state = mix64(state + U64(1))
        low += width
        level += 1
        more = w > low
        h, d, w = h[more], d[more], w[more]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def signatures(h: np.ndarray, d: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """(n, K) dart hashes of n documents; all 0 where a document has no element."""
    sig = np.zeros((n, K), U64)
    best = np.full((n, K), np.inf)
    w = w.astype(np.float64)
    total = np.bincount(d, weights=w, minlength=n)
    limit = np.where(total > 0, DARTS / np.maximum(total, 1), 0.0)
    open_docs = total > 0
    while open_docs.any():
        use = open_docs[d]
        doc, coord, rank, body = darts(h[use], d[use], w[use], limit)
        order = np.argsort(-rank, kind="stable")  # the earliest is written last
        best[doc[order], coord[order]] = rank[order]
        sig[doc[order], coord[order]] = body[order]
        open_docs &= ~np.isfinite(best).all(axis=1)
        limit = limit * 2
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of the bands."""
    parts = sig.reshape(len(sig), BANDS, ROWS)
    key = np.tile(np.arange(BANDS, dtype=U64) + U64(1), (len(sig), 1))
    for r in range(ROWS):
        key = mix64(key.ravel() ^ mix64(parts[:, :, r].ravel())).reshape(key.shape)
    return key


def _signed_docs(docs: DataFrame) -> DataFrame:
    """docs(id, h1, h2, text) -> id, h1, h2, bands (null for a text without words)."""
    out = T.StructType([*docs.schema.fields[:3], T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in slices(b.column(3)):
                hashes, _, upto = words(data, offsets)
                n = end - first
                keys = band_keys(signatures(*weighted(*shingles(hashes, upto, WIDTH)), n)).view(np.int64)
                bands = pa.array([k if some else None for k, some in zip(keys, np.diff(upto) > 0)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(first, n) for c in range(3)), bands], names=[f.name for f in out])

    return docs.mapInArrow(run, out)


def _features(docs: DataFrame) -> DataFrame:
    """docs(x, text) -> x, feature: sorted shingle hashes and their weights, packed."""
    out = T.StructType([docs.schema["x"], T.StructField("feature", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in slices(b.column(1)):
                hashes, _, upto = words(data, offsets)
                h, d, w = weighted(*shingles(hashes, upto, WIDTH))
                at = np.searchsorted(d, np.arange(end - first + 1))
                packed = [
                    h[at[i] : at[i + 1]].tobytes() + w[at[i] : at[i + 1]].astype("<u4").tobytes() for i in range(end - first)
                ]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), pa.array(packed, pa.binary())], names=["x", "feature"])

    return docs.mapInArrow(run, out)


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard index of two packed features."""
    n, m = len(a) // 12, len(b) // 12
    ha, wa = np.frombuffer(a, U64, n), np.frombuffer(a, "<u4", n, 8 * n).astype(np.int64)
    hb, wb = np.frombuffer(b, U64, m), np.frombuffer(b, "<u4", m, 8 * m).astype(np.int64)
    if not n or not m:
        return 0.0
    at = np.searchsorted(hb, ha)
    at[at == m] = 0
    both = hb[at] == ha
    shared = int(np.minimum(wa[both], wb[at[both]]).sum())
    return shared / (int(wa.sum()) + int(wb.sum()) - shared)


def compare(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """pairs(x, y) -> x, y, sim. A y with many partners is met in chunks, each with its own copy of y's feature."""
    # Sort-merge on purpose: a side that is small today would be broadcast and tomorrow not.
    by_x = features.withColumnRenamed("feature", "fx").hint("merge")
    by_y = features.withColumnRenamed("x", "y").withColumnRenamed("feature", "fy").hint("merge")
    chunks = pairs.groupBy("y").agg((F.floor(F.count(F.lit(1)) / CHUNK) + 1).cast("int").alias("chunks"))
    left = pairs.join(chunks, "y").withColumn("chunk", F.pmod(F.xxhash64("x"), F.col("chunks")).cast("int")).drop("chunks")
    left = left.join(by_x, "x")
    right = chunks.select("y", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).join(by_y, "y").hint("merge")
    both = left.join(right, ["y", "chunk"]).select("x", "y", "fx", "fy")
    out = T.StructType([both.schema["x"], both.schema["y"], T.StructField("sim", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sims = [similarity(p.as_py(), q.as_py()) for p, q in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sims, pa.float64())], names=["x", "y", "sim"])

    return both.mapInArrow(run, out)


def _rooted(rows: DataFrame, col: str, roots: DataFrame, out: str) -> DataFrame:
    """rows with the component of col as ``out``; a node without links is its own."""
    r = roots.select(F.col("x").alias("__n"), F.col("root").alias("__r"))
    return rows.join(r, F.col(col) == F.col("__n"), "left").withColumn(out, F.coalesce("__r", col)).drop("__n", "__r")


def bucket_links(members: DataFrame, features: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """members(key, x) of buckets with two or more -> verified links (x, y), enough for the components."""
    firsts = members.groupBy("key").agg(F.min("x").alias("y"), F.count(F.lit(1)).alias("m"))
    star = scratch.keep(members.join(firsts, "key"), "star")
    pairs = scratch.keep(star.where("x != y").select("x", "y").distinct(), "pairs")
    one = pairs.groupBy("x").agg(F.min("y").alias("y"))
    links = scratch.keep(compare(one, features).where(F.col("sim") >= threshold).select("x", "y"), "links")
    roots = components(links, scratch)
    rest = pairs.join(one, ["x", "y"], "left_anti")
    rest = _rooted(_rooted(rest, "x", roots, "cx"), "y", roots, "cy").where("cx != cy").select("x", "y")
    more = compare(scratch.keep(rest, "rest"), features).where(F.col("sim") >= threshold).select("x", "y")
    links = scratch.keep(links.unionByName(more), "links")
    roots = components(links, scratch)
    # Now a member is in its first member's component, or was compared with that and failed.
    star = _rooted(_rooted(star, "x", roots, "c"), "y", roots, "cy").withColumn("out", F.col("c") != F.col("cy"))
    star = scratch.keep(star.select("key", "x", "y", "m", "c", "out"), "star")
    split = star.groupBy("key").agg(F.count_if("out").alias("n_out")).where("n_out > 0")
    star = scratch.keep(star.join(split, "key"), "split")
    small = star.where((F.col("m") <= SMALL) & (F.col("x") != F.col("y")))
    other = small.select("key", F.col("x").alias("x2"), F.col("c").alias("c2"))
    pairs = small.join(other, "key").where("x < x2 and c != c2").select("x", F.col("x2").alias("y")).distinct()
    found = compare(scratch.keep(pairs, "cross"), features).where(F.col("sim") >= threshold).select("x", "y")
    links = links.unionByName(scratch.keep(found, "links"))
    large = star.where(F.col("m") > SMALL)
    if large.limit(1).count():  # else there is no cell to fill
        links = links.unionByName(scratch.keep(block_links(large, features, threshold), "blocks"))
    return links.distinct()


def block_links(large: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """large(key, x, c, out) -> links between different components of a bucket, by cells of two blocks.

    The members outside the first member's component are dealt into blocks of about BLOCK members and BLOCK_BYTES bytes at
    most, and so are the rest. A cell
    compares a block of the former with one of the latter or with another (or the same) of its own kind, so a cell
    holds at most some 2 * BLOCK features and gives at most as many links.
    """
    sizes = features.select("x", F.octet_length("feature").alias("bytes"))
    rows = large.select("key", "x", "c", "out").join(sizes.hint("merge"), "x")

    def blocks(which: Column) -> Column:
        by_bytes = F.sum(F.when(which, F.col("bytes")).otherwise(0)) / BLOCK_BYTES
        return F.greatest(F.ceil(F.greatest(F.count_if(which) / BLOCK, by_bytes)), F.lit(1)).cast("int")

    per = rows.groupBy("key").agg(blocks(F.col("out")).alias("no"), blocks(~F.col("out")).alias("ni"))
    rows = rows.join(per, "key")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("x"), F.when(F.col("out"), F.col("no")).otherwise(F.col("ni"))).cast("int"))
    over = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("left"))
    as_left = F.concat(
        F.transform(over(F.col("ni")), lambda j: cell(F.col("own"), j, True)),
        F.transform(F.sequence(F.col("own"), F.col("no") - 1), lambda j: cell(F.col("own"), F.col("ni") + j, True)),
    )
    as_right = F.filter(F.transform(over(F.col("no")), lambda i: cell(i, F.col("ni") + F.col("own"), False)), lambda c: c["i"] < F.col("own"))
    inside = F.transform(over(F.col("no")), lambda i: cell(i, F.col("own"), False))
    cells = F.when(F.col("out"), F.concat(as_left, as_right)).otherwise(inside)
    rows = rows.select("key", "x", "c", F.explode(cells).alias("cell")).select("key", "cell.i", "cell.j", "cell.left", "x", "c")
    rows = rows.join(features.hint("merge"), "x").select("key", "i", "j", "left", "x", "c", "feature")

    def run(table: pa.Table) -> pa.Table:
        left = np.array(table["left"].to_pylist(), dtype=bool)
        x, c = table["x"].to_numpy(), table["c"].to_numpy()
        packed = [f.as_py() for f in table["feature"]]
        a = np.flatnonzero(left)
        b = np.flatnonzero(~left) if not left.all() else a
        if not len(a):  # blocks are dealt by hash, so one may be empty
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64())})
        sims = cell_similarities([packed[i] for i in a], [packed[i] for i in b])
        sims[c[a][:, None] == c[b][None, :]] = 0
        parent = {}

        def find(u: int) -> int:
            while parent.get(u, u) != u:
                u = parent[u]
            return u

        out = []
        for i, j in zip(*np.nonzero(sims >= threshold)):  # of the cell's links, a spanning forest
            u, v = find(int(c[a[i]])), find(int(c[b[j]]))
            if u != v:
                parent[u] = v
                out.append((int(x[a[i]]), int(x[b[j]])))
        return pa.table({"x": pa.array([u for u, _ in out], pa.int64()), "y": pa.array([v for _, v in out], pa.int64())})

    return rows.groupBy("key", "i", "j").applyInArrow(run, "x bigint, y bigint")


def _units(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, unit element, total weight by row): a shingle that occurs n times is n elements."""
    rows, units, totals = [], [], np.zeros(len(packed))
    for i, f in enumerate(packed):
        n = len(f) // 12
        h, w = np.frombuffer(f, U64, n), np.frombuffer(f, "<u4", n, 8 * n).astype(np.int64)
        copy = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        units.append(mix64(np.repeat(h, w) + copy.astype(U64) * U64(0x9E3779B97F4A7C15)))
        rows.append(np.full(len(copy), i))
        totals[i] = w.sum()
    return np.concatenate(rows), np.concatenate(units), totals


def cell_similarities(left: list[bytes], right: list[bytes], width: int = 8192) -> np.ndarray:
    """Weighted Jaccard index of every left with every right feature: products of 0/1 matrices, some columns at a time."""
    (ra, ua, ta), (rb, ub, tb) = _units(left), _units(right)
    columns = np.intersect1d(ua, ub)
    shared = np.zeros((len(left), len(right)))

    def inside(r: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(columns, u), max(len(columns) - 1, 0))
        ok = columns[at] == u if len(columns) else np.zeros(len(u), dtype=bool)
        order = np.argsort(at[ok], kind="stable")
        return r[ok][order], at[ok][order]

    (ra, ca), (rb, cb) = inside(ra, ua), inside(rb, ub)
    for first in range(0, len(columns), width):
        parts = []
        for n, r, c in ((len(left), ra, ca), (len(right), rb, cb)):
            lo, hi = np.searchsorted(c, [first, first + width])
            m = np.zeros((n, width), np.float32)
            m[r[lo:hi], c[lo:hi] - first] = 1
            parts.append(m)
        shared += parts[0] @ parts[1].T
    return shared / (ta[:, None] + tb[None, :] - shared)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links(x, y) -> (x, root) of every linked node but the roots: large-star and small-star until nothing changes.

    The stars settle after a number of rounds that grows with the logarithm of the nodes.
    """
    edges = scratch.keep(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large-star: larger neighbours of u go to the least of u's neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: u and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = scratch.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("x"), F.col("v").alias("root"))
        before = now


def text_hashes(text_col: str) -> tuple[Column, Column]:
    """128 bits that tell texts apart."""
    return F.xxhash64(F.col(text_col)).alias("h1"), F.xxhash64(F.lit(1), F.col(text_col)).alias("h2")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows: id, h1, h2, bands; texts with words: h1, h2, rep = (nul, id, h1, h2) of the text, root = that of its class)."""
    scratch = Scratch(docs.sparkSession, "neardup")
    src = docs.select(F.col(id_col).alias("id"), *text_hashes(text_col), F.col(text_col).alias("text"))
    signed = scratch.keep(_signed_docs(src), "signed")
    who = F.struct(F.col("id").isNull().alias("nul"), "id", "h1", "h2")
    texts = signed.where("bands is not null").groupBy("h1", "h2").agg(F.min(who).alias("rep"), F.any_value("bands").alias("bands"))
    texts = scratch.keep(texts.withColumn("x", F.monotonically_increasing_id()), "texts")  # written once, so the numbers stay
    entries = texts.select("x", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.min("x").alias("a"), F.max("x").alias("b")).where("a != b").select("key")
    members = scratch.keep(entries.join(shared, "key", "left_semi").select("key", "x"), "buckets")
    wanted = texts.join(members.select("x").distinct(), "x", "left_semi")
    wanted = wanted.select("x", F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("rep.id").alias("wid"))
    same = (F.col("h1") == F.col("w1")) & (F.col("h2") == F.col("w2")) & F.col("id").eqNullSafe(F.col("wid"))
    chosen = src.join(scratch.keep(wanted, "wanted").hint("merge"), same).select("x", "text")
    features = scratch.keep(_features(chosen).dropDuplicates(["x"]), "features")
    links = scratch.keep(bucket_links(members, features, scratch, threshold), "links")
    roots = components(links, scratch)
    nodes = roots.unionByName(roots.select(F.col("root").alias("x"), "root").distinct())
    nodes = texts.select("x", "h1", "h2", "rep").join(nodes, "x")
    least = nodes.groupBy("root").agg(F.min("rep").alias("least"))
    nodes = nodes.join(least, "root").select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), "least")
    texts = texts.select("h1", "h2", "rep").join(nodes, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left")
    texts = texts.select("h1", "h2", "rep", F.coalesce("least", "rep").alias("root"))
    done = scratch.keep(texts, "classes")
    scratch.release(signed, done)
    return signed, done


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: id, class_id (the least id of its class) and is_first (its id is the class's)."""
    rows, texts = classes(docs, id_col, text_col, threshold)
    facts = texts.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "root")
    worded = F.col("bands").isNotNull() & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))
    out = rows.join(facts, worded, "left")
    class_id = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("root.id"))
    return out.select(F.col("id").alias(id_col), class_id.alias("class_id"), F.col("id").eqNullSafe(class_id).alias("is_first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs without the later members of each class; texts without words stay."""
    rows, texts = classes(docs, id_col, text_col, threshold)
    h1, h2 = text_hashes(text_col)
    # A class's first text stays, in the row of its first id; all other texts and rows go.
    facts = texts.select(F.col("h1").alias("__f1"), F.col("h2").alias("__f2"), (F.col("rep") == F.col("root")).alias("__stays"), F.col("rep.id").alias("__rep"))
    keyed = docs.select("*", h1.alias("__h1"), h2.alias("__h2"))
    joined = keyed.join(facts, (F.col("__h1") == F.col("__f1")) & (F.col("__h2") == F.col("__f2")), "left")
    stays = F.col("__f1").isNull() | (F.col("__stays") & F.col(id_col).eqNullSafe(F.col("__rep")))
    kept = joined.where(stays)
    twice = rows.where("bands is not null").groupBy("id", "h1", "h2").count().where("count > 1")
    if twice.limit(1).count():  # rows repeated in full: one stays
        plain = kept.where("__f1 is null")
        kept = kept.where("__f1 is not null").dropDuplicates(["__h1", "__h2"]).unionByName(plain)
    return kept.select(docs.columns)
