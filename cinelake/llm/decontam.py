"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents into segments, each of about ``SEGMENT_BYTES`` of text, and stored as a table: a sorted
dictionary of term hashes, and for each term the ascending word positions in the segment as variable-byte gaps. A segment
never parts a document, holds every token of its documents, and is built and searched by one task without a shuffle.

Search is a join. The benchmark's windows are a table of distinct runs of term hashes. Every window is sought by its rarest
term, the one that the fewest segments hold; a window with a term that no segment holds is gone. The rarest terms are joined
with the dictionaries, so a segment meets only windows whose rarest term it has, in lists of at most some CHUNK windows.
There, lists of positions are intersected from the segment's rarest term on: its list, less the term's offset in the window,
with the next rarest term's offset-adjusted list, and so on; what is left are the exact starts of the phrase. Occurrences
over the end of a document do not count. Proximity search keeps the windows whose distinct words all stand, in any order,
within ``span`` consecutive words of one document. Neither the benchmark nor the hits are ever held by the driver: joins
of tables that grow with either are hinted to merge, since Spark goes by the size of their files, of which the rows of a
broadcast take many times as much. Only the number of lists of each segment may be broadcast.

Defined results: null texts and items have no words; an item of fewer words than a window, but not none, is one window;
items without words and an empty benchmark hit nothing; an item id that occurs in several rows counts once; rows of a
null item id hit words but are not listed. Repeated documents are judged alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.scratch import Scratch
from cinelake.llm.textcore import U64, slices, words

WINDOW = 13
SEGMENT_BYTES = 1 << 20
CHUNK = 8192  # windows that one search of a segment takes
SPAN = 26
INDEX_SCHEMA = "n_words array<int>, terms array<bigint>, sizes binary, gaps binary"


def encode_gaps(x: np.ndarray) -> bytes:
    """Variable-byte code: seven bits a byte, the lowest first, the top bit set on all but the last."""
    x = x.astype(np.uint64)
    size = np.ones(len(x), np.int64)
    for bits in (7, 14, 21, 28):
        size += x >= U64(1 << bits)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(5):
        more = size > k
        out[at[more] + k] = (x[more] >> U64(7 * k) & U64(127)).astype(np.uint8) | ((size[more] > k + 1) << 7).astype(np.uint8)
    return out.tobytes()


def decode_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out = np.zeros(len(last), np.int64)
    for k in range(5):
        at = first + k
        ok = at <= last
        out[ok] |= (raw[at[ok]].astype(np.int64) & 127) << (7 * k)
    return out


def pack_segment(hashes: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """(term dictionary, how often each occurs, position gaps) of the words of a segment."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(first)
    gaps = order.astype(np.int64)
    gaps[1:] -= order[:-1]
    gaps[at] = order[at]
    return h[at], encode_gaps(np.diff(np.append(at, len(h)))), encode_gaps(gaps)


@dataclass
class Segment:
    """Reader of one segment."""

    terms: np.ndarray
    ends: np.ndarray
    gaps: np.ndarray
    upto: np.ndarray  # words up to each document's end
    lists: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def load(cls, n_words: np.ndarray, terms: np.ndarray, sizes: bytes, gaps: bytes) -> Segment:
        return cls(terms.view(U64), np.cumsum(decode_gaps(sizes)), decode_gaps(gaps), np.cumsum(n_words))

    def rank(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term in the dictionary, -1 if absent."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1)

    def size(self, rank: int) -> int:
        return int(self.ends[rank] - (self.ends[rank - 1] if rank else 0))

    def positions(self, rank: int) -> np.ndarray:
        if rank not in self.lists:
            self.lists[rank] = np.cumsum(self.gaps[self.ends[rank - 1] if rank else 0 : self.ends[rank]])
        return self.lists[rank]

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.upto, at, side="right")

    def phrase(self, ranks: np.ndarray) -> np.ndarray:
        """Starts of the exact phrase of these terms within one document."""
        starts = None
        for k in sorted(range(len(ranks)), key=lambda i: self.size(ranks[i])):
            p = self.positions(int(ranks[k]))
            if starts is None:
                starts = p - k
                starts = starts[starts >= 0]
            else:
                at = np.searchsorted(p, starts + k)
                at[at == len(p)] = 0
                starts = starts[p[at] == starts + k]
            if not len(starts):
                return starts
        return starts[starts + len(ranks) <= self.upto[self.document(starts)]]

    def near(self, ranks: np.ndarray, span: int) -> np.ndarray:
        """Documents in which all these terms stand within ``span`` consecutive words."""
        lists = sorted((self.positions(int(r)) for r in np.unique(ranks)), key=len)
        at = lists[0]  # a span holds an occurrence of the rarest, and all others within span - 1 words of it
        doc = self.document(at)
        low = np.maximum(np.where(doc > 0, self.upto[doc - 1], 0), at - span + 1)
        high = np.minimum(self.upto[doc], at + span)
        ok = np.ones(len(at), dtype=bool)
        for p in lists[1:]:
            ok &= np.searchsorted(p, high) > np.searchsorted(p, low)
        found = set()
        for d, a, b in zip(doc[ok].tolist(), low[ok], high[ok]):
            if d not in found:
                places = [p[np.searchsorted(p, a) : np.searchsorted(p, b)] for p in lists]
                # the tightest span that starts at each place: it ends where the last of the terms next occurs
                starts = np.concatenate(places)
                after = [np.append(p, b + span)[np.searchsorted(p, starts)] for p in places]
                if (np.max(after, axis=0) - starts < span).any():
                    found.add(d)
        return np.array(sorted(found), np.int64)


def row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.col(text_col))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The index as rows (ids, keys, n_words, terms, sizes, gaps); keys tell apart rows of one id (see row_key)."""
    src = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    out = T.StructType([
        T.StructField("ids", T.ArrayType(src.schema["id"].dataType)), T.StructField("keys", T.ArrayType(T.LongType())),
        *T._parse_datatype_string(INDEX_SCHEMA).fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        for b in batches:
            for first, end, data, offsets in slices(b.column(2), segment_bytes):
                hashes, _, upto = words(data, offsets)
                terms, sizes, gaps = pack_segment(hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        lists(b.column(0).slice(first, end - first)), lists(b.column(1).slice(first, end - first)),
                        lists(pa.array(np.diff(upto).astype(np.int32))), lists(pa.array(terms.view(np.int64))),
                        pa.array([sizes], pa.binary()), pa.array([gaps], pa.binary()),
                    ],
                    names=[f.name for f in out],
                )

    return src.mapInArrow(run, out)


def benchmark_windows(bench: DataFrame, item_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(grams, item): the runs of term hashes of every item's windows."""
    src = bench.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in slices(b.column(1)):
                hashes, _, upto = words(data, offsets)
                for i, (lo, hi) in enumerate(zip(upto[:-1], upto[1:]), first):
                    width, n = min(window, hi - lo), max(1, hi - lo - window + 1)
                    if width:
                        rows = np.lib.stride_tricks.sliding_window_view(hashes[lo:hi].view(np.int64), width)
                        cut = pa.array(np.arange(n + 1, dtype=np.int32) * width)
                        yield pa.RecordBatch.from_arrays(
                            [pa.ListArray.from_arrays(cut, pa.array(rows.ravel())), b.column(0).take(pa.array([i] * n, pa.int32()))],
                            names=["grams", "item"],
                        )

    return src.mapInArrow(run, "grams array<bigint>, item string")


def search_index(index: DataFrame, windows: DataFrame, scratch: Scratch, span: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """index with seg, windows(wid, grams) -> hits (seg, doc, start, size, wid): exact occurrences, start and size in words;
    with ``span``, (seg, doc, wid) of the windows whose words stand within it, start and size 0. doc: place in the segment."""
    terms = windows.select("wid", F.explode(F.array_distinct("grams")).alias("term"))
    vocabulary = scratch.keep(terms.select("term").distinct(), "vocabulary")
    postings = index.select("seg", F.explode("terms").alias("term")).join(vocabulary, "term", "left_semi")
    postings = scratch.keep(postings, "postings")
    often = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rarest = terms.join(often.hint("merge"), "term").groupBy("wid").agg(F.min(F.struct("n", "term"))["term"].alias("term"), F.count(F.lit(1)).alias("held"))
    rarest = windows.join(rarest.hint("merge"), "wid").where(F.col("held") == F.size(F.array_distinct("grams"))).select("wid", "grams", "term")
    met = scratch.keep(rarest.join(postings.hint("merge"), "term").select("seg", "wid", "grams"), "met")
    parts = met.groupBy("seg").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))
    met = met.join(parts, "seg").withColumn("part", F.pmod(F.xxhash64("wid"), F.col("parts")))
    lists = met.groupBy("seg", "part").agg(F.collect_list(F.struct("wid", "grams")).alias("wanted"))
    src = index.select("seg", "n_words", "terms", "sizes", "gaps").join(lists.hint("merge"), "seg").select("seg", "n_words", "terms", "sizes", "gaps", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n_words, terms = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (1, 2))
                seg = Segment.load(n_words, terms, b.column(3)[i].as_py(), b.column(4)[i].as_py())
                wanted = b.column(5)[i].values
                wids, grams = wanted.field(0).to_numpy(zero_copy_only=False), wanted.field(1)
                cuts = grams.offsets.to_numpy()
                ranks = seg.rank(grams.values.to_numpy(zero_copy_only=False).view(U64))
                rows: list[np.ndarray] = []
                for w, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                    own = ranks[lo:hi]
                    if (own < 0).any():
                        continue
                    if span is None:
                        at = seg.phrase(own)
                        doc, size = seg.document(at), hi - lo
                        at = at - np.where(doc > 0, seg.upto[doc - 1], 0)
                    else:
                        doc, size = seg.near(own, span), 0
                        at = np.zeros(len(doc), np.int64)
                    if len(doc):
                        rows.append(np.stack([doc, at, np.full(len(doc), size), np.full(len(doc), wids[w])]))
                if rows:
                    found = np.concatenate(rows, axis=1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(found.shape[1], b.column(0)[i].as_py(), np.int64)), *map(pa.array, found)],
                        names=["seg", "doc", "start", "size", "wid"],
                    )

    return scratch.keep(src.mapInArrow(run, "seg bigint, doc bigint, start bigint, size bigint, wid bigint"), "hits")


def _indexed(
    docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, segment_bytes: int
) -> tuple[Scratch, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(scratch, index, its documents, windows, (wid, item) of the windows' items), kept."""
    scratch = Scratch(docs.sparkSession, "index")
    index = build_index(docs, id_col, text_col, segment_bytes).withColumn("seg", F.monotonically_increasing_id())
    index = scratch.keep(index, "segments")  # written once, so the numbers stay
    each = F.arrays_zip("ids", "keys", "n_words")
    rows = index.select("seg", F.posexplode(each).alias("doc", "x"))
    rows = rows.select("seg", F.col("doc").cast("long").alias("doc"), F.col("x.ids").alias("id"), F.col("x.keys").alias("key"), F.col("x.n_words").cast("long").alias("n_words"))
    pairs = scratch.keep(benchmark_windows(bench, item_col, item_text_col, window), "pairs")
    windows = scratch.keep(pairs.select("grams").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    owners = pairs.where("item is not null").join(windows.hint("merge"), "grams").select("wid", "item").distinct()
    return scratch, index, rows, windows, scratch.keep(owners, "owners")


def _listed(hits: DataFrame, owners: DataFrame) -> DataFrame:
    """(seg, doc, items): the sorted items of each document's windows."""
    found = hits.select("seg", "doc", "wid").distinct().join(owners.hint("merge"), "wid").select("seg", "doc", "item").distinct()
    return found.groupBy("seg", "doc").agg(F.array_sort(F.collect_list("item")).alias("items"))


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    segment_bytes: int = SEGMENT_BYTES,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: id, key (row_key), n_words, n_hit, n_items, items_sha256, contaminated."""
    scratch, index, rows, windows, owners = _indexed(docs, bench, id_col, text_col, item_col, item_text_col, window, segment_bytes)
    hits = search_index(index, windows, scratch, chunk=chunk)
    # Words covered: what each occurrence, in order, adds past the furthest end before it.
    w = Window.partitionBy("seg", "doc").orderBy("start", "end")
    spans = hits.select("seg", "doc", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    before = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), before), F.lit(0))
    covered = spans.select("seg", "doc", new.alias("new")).groupBy("seg", "doc").agg(F.sum("new").alias("n_hit"))
    facts = scratch.keep(covered.join(_listed(hits, owners).hint("merge"), ["seg", "doc"], "left"), "facts")
    scratch.release(index, facts)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(facts.hint("merge"), ["seg", "doc"], "left").select(
        F.col("id").alias(id_col), "key", "n_words", n_hit.alias("n_hit"),
        F.greatest(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def proximity_matches(
    docs: DataFrame,
    bench: DataFrame,
    span: int = SPAN,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """One row per document: id, n_words, n_near_items and near_items_sha256 of the items with a window whose distinct words all
    stand, in any order, within ``span`` consecutive words. Every exact occurrence is one of them if span >= window."""
    scratch, index, rows, windows, owners = _indexed(docs, bench, id_col, text_col, item_col, item_text_col, window, segment_bytes)
    facts = scratch.keep(_listed(search_index(index, windows, scratch, span), owners), "facts")
    scratch.release(index, facts)
    return rows.join(facts.hint("merge"), ["seg", "doc"], "left").select(
        F.col("id").alias(id_col), "n_words", F.greatest(F.size("items"), F.lit(0)).cast("long").alias("n_near_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("near_items_sha256"),
    )
