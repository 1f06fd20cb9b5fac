"""Language identification by prediction by partial matching over bytes.

Every language has a variable-order context tree (contexts of up to ORDER bytes) with frozen counts. A byte's code
length follows escape method C without exclusion: in the longest context seen in that language the byte costs
-log2(count / (total + distinct)); a byte not seen there pays the escape -log2(distinct / (total + distinct)) and is
tried in the next shorter context, at last uniformly over 256 bytes. A text's exact code length under a language is
the sum over all its bytes; the shortest length wins, ties go to the first language by code point.

Each language keeps sorted tables of only what its sample shows: byte runs with their code length, contexts with their escape.
A text's byte runs are made distinct first, and each is priced once per language. There is no bound on the number of
languages; tables grow with the samples. A text's first bytes are coded after ORDER spaces.

Training: about ``sample`` documents a language, chosen by a hash of the id, counted on the executors with whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no labelled rows every text is
``und``; repeated rows are judged alike; an empty table gives an empty table; extra columns pass through untouched in
``identify`` with keep_columns, else are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.scratch import Scratch
from cinelake.llm.textcore import slices

ORDER = 3
SAMPLE = 300
PAD = b" " * ORDER
CHUNK = 1 << 20  # bytes scored at a time
MAX_BROADCAST_BYTES = 8 << 20  # of the languages' names and counts
_LETTER = re.compile(r"[^\W\d_]")
LETTER = r"\p{L}"  # the same in Java's terms


def _price(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: np.ndarray | float) -> np.ndarray:
    """The values of the wanted keys in a sorted table, ``other`` where it has none."""
    if not len(keys):
        return np.broadcast_to(np.float32(other), wanted.shape) if np.isscalar(other) else other
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], other)


@dataclass(frozen=True)
class Tree:
    """One language's context tree: order 1 and below as a dense table, above it by order (runs, bits, contexts, escapes)."""

    low: np.ndarray
    levels: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]

    @classmethod
    def grow(cls, g: np.ndarray, n: np.ndarray) -> Tree:
        """From byte runs of ORDER + 1 bytes and how often each occurs."""
        low, levels = np.full(256, 8.0, np.float32), []
        for order in range(ORDER + 1):
            runs, inv = np.unique(g & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            often = np.bincount(inv, weights=n, minlength=len(runs))
            contexts, at = np.unique(runs >> 8, return_inverse=True)
            distinct = np.bincount(at, minlength=len(contexts))
            total = np.bincount(at, weights=often, minlength=len(contexts)) + distinct
            bits = -np.log2(often / total[at]).astype(np.float32)
            escapes = -np.log2(distinct / total).astype(np.float32)
            if order < 2:  # dense: a row for each byte before
                low = np.tile(low, (256, 1)) if order else low[None, :].copy()
                low[contexts] += escapes[:, None]
                low[runs >> 8, runs & 255] = bits
                low = low if order else low[0]
            else:
                levels.append((runs.astype(np.uint32), bits, contexts.astype(np.uint32), escapes))
        return cls(low.ravel(), tuple(levels))

    def bits(self, g: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each run."""
        out = self.low[g & np.uint32(0xFFFF)]
        for order, (runs, bits, contexts, escapes) in enumerate(self.levels, 2):
            run = g & np.uint32((1 << 8 * (order + 1)) - 1)
            out = _price(runs, bits, run, out + _price(contexts, escapes, run >> np.uint32(8), 0.0))
        return out


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    trees: tuple[Tree, ...]


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def grams(data: bytes) -> np.ndarray:
    """The byte n-gram that ends at each byte, of ORDER + 1 bytes as one number, after ORDER spaces."""
    padded = np.frombuffer(PAD + data, np.uint8).astype(np.uint32)
    return padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]


def gram_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, gram, n): partial counts per batch, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).fill_null("").cast(pa.binary())):
                by.setdefault(lang, []).append(grams(text.as_py()))
            for lang, parts in by.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    part = docs.select(lang_col, text_col).mapInArrow(run, "lang string, gram bigint, n bigint")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_counts(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """counts: language -> (grams of four bytes, how often)."""
    langs = tuple(sorted(counts, key=lambda s: s.encode("utf-8", "surrogatepass")))
    return Model(langs, tuple(Tree.grow(*counts[x]) for x in langs))


Counts = dict[str, tuple[np.ndarray, np.ndarray]]


def learned(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> DataFrame | None:
    """The hash sample (id, text, language) of about ``sample`` labelled rows a language that ``fit`` counts, kept; null when no
    row has a label."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    scratch = Scratch(docs.sparkSession, "language")
    sizes = scratch.keep(labelled.groupBy(F.col(lang_col).alias("__l")).agg(F.count(F.lit(1)).alias("__n")), "sizes")
    if (sizes.agg(F.sum(F.octet_length("__l") + 24)).first()[0] or 0) <= MAX_BROADCAST_BYTES:
        sizes = F.broadcast(sizes)  # else labels are so many that none is hot
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = labelled.join(sizes, F.col(lang_col) == F.col("__l")).where(draw < F.lit(float(sample)) / F.col("__n"))
    chosen = scratch.keep(chosen.select(*dict.fromkeys((id_col, text_col, lang_col))), "sample")
    if not chosen.isEmpty():
        return chosen
    rest = labelled.select(chosen.columns).orderBy(id_col).limit(sample)
    return None if labelled.isEmpty() else scratch.keep(rest, "sample")


def counted(chosen: DataFrame | None, text_col: str, lang_col: str) -> Counts | None:
    """The n-gram counts of the rows of ``learned``."""
    if chosen is None:
        return None
    got = gram_counts(chosen, lang_col, text_col).toArrow()
    langs = np.array(got["lang"].to_pylist(), dtype=object)
    gram, n = got["gram"].to_numpy(), got["n"].to_numpy().astype(np.float64)
    return {lang: (gram[langs == lang], n[langs == lang]) for lang in set(langs.tolist())}


def merged(parts: list[Counts]) -> Counts:
    """The sum of several counts."""
    out: Counts = {}
    for lang in {x for p in parts for x in p}:
        g, n = (np.concatenate(x) for x in zip(*(p[lang] for p in parts if lang in p)))
        keys, inv = np.unique(g, return_inverse=True)
        out[lang] = (keys, np.bincount(inv, weights=n, minlength=len(keys)))
    return out


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> Counts | None:
    """The n-gram counts of a hash sample of about ``sample`` labelled rows a language; null when no row has a label."""
    return counted(learned(docs, id_col, text_col, lang_col, sample), text_col, lang_col)


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Bits of each text under each language: (texts, languages). Works in chunks of bytes, so long texts need no more memory."""
    out = np.zeros((len(offsets) - 1, len(model.langs)))
    texts = np.flatnonzero(np.diff(offsets))
    starts, ends = offsets[:-1][texts], offsets[1:][texts]
    for first in range(0, len(data), chunk):
        end = min(first + chunk, len(data))
        head = min(ORDER, first)  # bytes before the chunk that are its contexts
        s = data[first - head : end].astype(np.uint32)
        lo, hi = np.searchsorted(ends, first, side="right"), np.searchsorted(starts, end)
        run = s[head:].copy()
        for back in range(1, ORDER + 1):
            p = np.full(end - first, PAD[0], np.uint32)
            skip = max(back - head, 0)
            p[skip:] = s[head - back + skip : max(len(s) - back, 0)]
            for i in range(back):
                at = starts[lo:hi] + i
                p[at[(at >= first) & (at < np.minimum(ends[lo:hi], end))] - first] = PAD[0]
            run |= p << np.uint32(8 * back)
        distinct, place = np.unique(run, return_inverse=True)
        cuts = np.maximum(starts[lo:hi], first) - first
        for k, tree in enumerate(model.trees):
            out[texts[lo:hi], k] += np.add.reduceat(tree.bits(distinct)[place], cuts, dtype=np.float64)
    return out


_LOADED: dict[int, Model | None] = {}


def identify(
    docs: DataFrame,
    counts: Counts | None,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    added: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``keep`` of every row, with the language and the score (the winner's posterior under equal priors).

    A third name in ``added`` adds the winner's code length in bits (0 for an empty text or without a model).
    """
    import uuid

    kept = docs.select(*keep)
    src = kept if text_col in keep else docs.select(*keep, text_col)
    place = src.columns.index(text_col)
    out = T.StructType([*kept.schema.fields, T.StructField(added[0], T.StringType()), *(T.StructField(a, T.DoubleType()) for a in added[1:])])
    token = uuid.uuid4().int
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # each worker tabulates the costs once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _LOADED:
            _LOADED.clear()
            _LOADED[token] = fit_counts(shared.value) if shared.value else None
        m = _LOADED[token]
        for b in batches:
            texts = b.column(place)
            langs: list[str] = []
            scores: list[float] = []
            lengths: list[float] = []
            for first, end, data, offsets in slices(texts):
                bits = code_lengths(m, data, offsets) if m else None
                best = bits.argmin(axis=1) if m else None
                lengths += bits.min(axis=1).tolist() if m else [0.0] * (end - first)
                if m:
                    rest = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                for i in range(end - first):
                    text = texts[first + i].as_py()
                    if m is None or text is None or not has_letter(text):
                        langs.append("und")
                        scores.append(0.0)
                    else:
                        langs.append(m.langs[best[i]])
                        scores.append(float(1 / rest[i]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], pa.array(langs, pa.string()), *(pa.array(x, pa.float64()) for x in (scores, lengths)[: len(added) - 1])],
                names=[f.name for f in out],
            )

    return src.mapInArrow(run, out)


def held_out(id_col: str) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """Train on the rows not held out, predict every row: id, held_out, lang_pred, score."""
    counts = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col, sample)
    return identify(docs, counts, text_col, (id_col,)).select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
