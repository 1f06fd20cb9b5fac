"""Media columns: any payload stored as 8-bit mono WAV, read back by the wave module, short-time Fourier transforms,
and spectral-peak pair fingerprints kept as time-coded arrays.

A frame is ``FRAME`` samples under a Hann window, one every ``HOP``. Each of ``BANDS`` equal bands of a frame's
magnitudes gives its strongest bin as a peak. A peak is paired with the peaks of the next ``FAN`` frames in its own
and the next band; a pair is coded as frame << 32 | bin << 20 | other bin << 8 | frames between.

Every payload is also cut into fine frames, ``FINE_FRAME`` samples every ``FINE_HOP``, with FINE_FRAME / 2 spaces before
it (so that its first bytes stand in the middle of a frame) and less each frame's mean. The smallest payload, of UNIT
bytes, has several of them. Their pairs are coded alike, plus ``FINE``. ``n_frames`` counts the long frames only.
Peaks tell no levels: a payload of one byte throughout has the codes of an empty text, and a few tiny texts agree.

Defined results: a null text counts as empty, whose payload is 192 spaces; equal texts give equal values; an empty
table gives an empty table; extra columns are not read. Transforms work in chunks of samples; what a text needs besides
grows with it, by some eight codes of eight bytes for each FINE_HOP of it.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

UNIT, RATE = 192, 8000
FRAME, HOP, BANDS, FAN = 768, 384, 3, 2
FINE_FRAME, FINE_HOP, FINE = 64, 32, 128
_CHUNK = 512 * FRAME  # samples transformed at a time


def payload_of(text: bytes) -> bytes:
    """Bytes 32 appended up to a positive multiple of UNIT."""
    return text + b" " * (max(-(-len(text) // UNIT), 1) * UNIT - len(text))


def write_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def read_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


@lru_cache(maxsize=4)
def _shape(frame: int) -> tuple[np.ndarray, np.ndarray]:
    """The window, without the zeros at its ends in fine frames, and the edges of the bands."""
    window = np.hanning(frame) if frame == FRAME else np.hanning(frame + 2)[1:-1]
    return window.astype(np.float32), np.linspace(1, frame // 2 + 1, BANDS + 1).astype(int)


def peaks(samples: np.ndarray, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """Strongest bin of each band of each frame: int array (frames, BANDS). Works in chunks of frames."""
    window, edges = _shape(frame)
    n = max(1, -(-max(len(samples) - frame, 0) // hop) + 1)
    padded = np.full((n - 1) * hop + frame, 128, np.uint8)
    padded[: len(samples)] = samples
    frames = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop]
    out = np.empty((n, BANDS), np.int64)
    chunk = _CHUNK // frame
    for at in range(0, n, chunk):
        part = frames[at : at + chunk].astype(np.float32)
        part = (part - (128 if frame == FRAME else part.mean(axis=1, keepdims=True))) * window
        size = np.rint(np.abs(np.fft.rfft(part, axis=1)) * 4)
        for b in range(BANDS):
            out[at : at + chunk, b] = edges[b] + size[:, edges[b] : edges[b + 1]].argmax(axis=1)
    return out


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """Time-coded peak pairs, ascending."""
    codes = []
    for frame, hop, kind in ((FRAME, HOP, 0), (FINE_FRAME, FINE_HOP, FINE)):
        before = np.full(0 if frame == FRAME else frame // 2, 32, np.uint8)
        found = peaks(np.concatenate([before, samples]), frame, hop)
        for gap in range(1, FAN + 1):
            for b in range(BANDS):
                for other in {b, min(b + 1, BANDS - 1)}:
                    first, second = found[:-gap, b], found[gap:, other]
                    time = np.arange(len(first), dtype=np.int64)
                    codes.append(time << 32 | first << 20 | second << 8 | kind | gap)
    return np.sort(np.concatenate(codes))


SCHEMA = (
    "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, "
    "media_sha256 string, n_frames bigint, fingerprint array<bigint>"
)
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64())]


def media_columns(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False
) -> DataFrame:
    """One row per row with digests and the fingerprint; keep_media adds the WAV file itself as ``media``."""
    src = docs.select(id_col, text_col)
    fields = T._parse_datatype_string(SCHEMA + ", feature string" + (", media binary" if keep_media else "")).fields
    out = T.StructType([src.schema[id_col], *fields])
    kinds = KINDS + [pa.string()] + [pa.binary()] * keep_media

    def one(text: bytes) -> tuple:
        media = write_wav(payload_of(text))
        back = read_wav(media)
        codes = fingerprint(np.frombuffer(back, np.uint8))
        frames = max(1, -(-max(len(back) - FRAME, 0) // HOP) + 1)
        feature = f"{len(codes)}:{hashlib.sha256(codes.astype('<i8').tobytes()).hexdigest()}"
        row = (
            len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media),
            hashlib.sha256(media).hexdigest(), frames, codes, feature,
        )
        return (*row, media) if keep_media else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n = b.column(1).fill_null("").cast(pa.binary()), b.num_rows
            for at in range(0, n, 500):  # bounds what is held before it is sent
                rows = [one(t.as_py()) for t in texts.slice(at, 500)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 500), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                    names=[f.name for f in out],
                )

    return src.mapInArrow(run, out)
