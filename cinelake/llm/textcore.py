"""Vectorised text primitives on Arrow string columns: slices of bytes, words, word hashes, window hashes.

A word is a maximal run of 0-9, a-z (A-Z lower-cased first) and bytes from 0x80 on, which on
UTF-8 text equals the code-point class ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing.
All hashes are 64 bit and depend on content only, never on the process or the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
CHUNK = (1 << 17) - 1  # bytes whose words are hashed at a time

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit words that scatters every bit."""
    x = x.astype(U64, copy=True)
    x += U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SYMBOL = mix64(np.arange(256, dtype=U64) + U64(1))[LOWER]
_BASE = {"byte": 0xD1342543DE82EF95, "word": 0xAF251AF3B0F025B5}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a fixed odd base modulo 2**64, and of its inverse."""
    have = _POWERS.get(kind)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, n.bit_length())  # small on the driver, which only hashes queries
        base = _BASE[kind]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, U64(b))
            p[0] = U64(1)
            out.append(np.multiply.accumulate(p))
        have = _POWERS[kind] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of length n + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``limit`` bytes (a longer text is a slice of its own): first, end, bytes, offsets."""
    data, offsets = column_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, its text's index, and the number of words up to the end of each text (length n + 1)."""
    n = len(data)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    mask = WORD[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    prev = np.empty(n, dtype=bool)
    prev[0] = False
    prev[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~prev | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | cut[1:])) + 1
    hashes = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):  # prefix sums over some words at a time
        at = int(starts[i])
        j = max(int(np.searchsorted(ends, at + CHUNK, side="right")), i + 1)
        part, first, last = data[at : ends[j - 1]], starts[i:j] - at, ends[i:j] - at
        pw, inv = powers("byte", len(part))
        total = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(_SYMBOL[part] * pw, out=total[1:])
        hashes[i:j] = mix64((total[last] - total[first]) * inv[first] + (last - first).astype(U64))
        i = j
    upto = np.searchsorted(starts, offsets, side="left")
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(upto))
    return hashes, doc, upto


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words, by the first word (not minding text ends)."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, U64)
    pw, inv = powers("word", n)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(hashes * pw, out=total[1:])
    return mix64((total[width:] - total[:-width]) * inv[: n - width + 1])


def shingles(hashes: np.ndarray, upto: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of all word shingles; a text of fewer words, but not none, has one of all its words."""
    counts = np.diff(upto)
    out_h, out_d = [], []
    if len(hashes) >= width:
        all_h = windows(hashes, width)
        owner = np.repeat(np.arange(len(counts)), counts)
        ok = owner[: len(all_h)] == owner[width - 1 :]
        out_h.append(all_h[ok])
        out_d.append(owner[: len(all_h)][ok])
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        own = hashes[upto[d] : upto[d + 1]]
        out_h.append(windows(own, len(own)))
        out_d.append(np.array([d]))
    if not out_h:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h, d = np.concatenate(out_h), np.concatenate(out_d)
    order = np.argsort(d, kind="stable")
    return h[order], d[order]


def weighted(h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with how often it occurs, sorted by text, then hash."""
    if not len(h):
        return h, d, np.zeros(0, np.int64)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(first)
    return h[at], d[at], np.diff(np.append(at, len(h)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
