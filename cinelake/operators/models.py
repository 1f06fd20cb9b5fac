"""Pluggable model operators: a registry of factories, and the way to run them.

Real engines are registered under their names with the modules that they need (see adapters); deterministic stand-ins only
under the name ``stub``, which no automatic choice ever takes. No model is bundled. A factory gives a function from a list of inputs to a list of results; it is called once in each
Python worker. A failing item gives the empty result and its error, so that one bad item costs no others.
"""

from __future__ import annotations

import hashlib
import importlib.util
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.operators import adapters

Factory = Callable[..., Callable[[list], list]]
KINDS = ("stt", "diarizer", "ocr", "caption", "face_detector", "face_embedder", "object_detector", "vlm", "image_embedder")
_REGISTRY: dict[tuple[str, str], tuple[Factory, tuple[str, ...]]] = {}
# Preference of transcription backends.
STT_ORDER = ("faster-whisper", "whisper", "api")


def register(kind: str, name: str, factory: Factory, needs: tuple[str, ...] = ()) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown kind: {kind}")
    _REGISTRY[kind, name] = (factory, needs)


def available(kind: str) -> list[str]:
    return sorted(n for (k, n), (_, needs) in _REGISTRY.items() if k == kind and not missing(needs))


def missing(needs: tuple[str, ...]) -> list[str]:
    return [m for m in needs if importlib.util.find_spec(m) is None]


def create(kind: str, name: str, **options: Any) -> Callable[[list], list]:
    if (kind, name) not in _REGISTRY:
        raise ValueError(f"unknown {kind}: {name}")
    factory, needs = _REGISTRY[kind, name]
    if lacking := missing(needs):
        raise ImportError(f"{kind} {name} needs {', '.join(lacking)}")
    return factory(**options)


def choose_stt(explicit: str | None = None, configured: str | None = None) -> str:
    """An explicit backend, else the configured one, else the first installed of the preference."""
    wanted = explicit or configured or "auto"
    if wanted != "auto":
        if ("stt", wanted) not in _REGISTRY:
            raise ValueError(f"unknown stt: {wanted}")
        return wanted
    for name in STT_ORDER:
        if name in available("stt"):
            return name
    raise ImportError("no transcription backend is installed")


def check_ocr_version(installed: str, least: str = "2.7.0", below: str = "4.0.0") -> None:
    """Raises RuntimeError for a version of the OCR engine that the adapter does not know."""
    import re

    def parse(version: str) -> tuple[int, ...]:
        return tuple(([int(x) for x in re.findall(r"\d+", version)] + [0, 0, 0])[:3])

    if not parse(least) <= parse(installed) < parse(below):
        raise RuntimeError(f"OCR engine {installed}: needs {least} or later, below {below}")


def dependencies(modules: tuple[str, ...], programs: tuple[str, ...]) -> dict[str, bool]:
    """Which modules and programs are there."""
    import shutil

    return {m: not missing((m,)) for m in modules} | {p: shutil.which(p) is not None for p in programs}


def choose_face_detector(wanted: str = "scrfd") -> str:
    """The wanted detector, or haar where scrfd is not installed."""
    if wanted not in ("scrfd", "haar"):
        raise ValueError(f"unknown face detector: {wanted}")
    return wanted if wanted in available("face_detector") or wanted == "haar" else "haar"


def choose_device(providers: list[str]) -> str:
    """The first of the preference that is offered, else the CPU."""
    return next((p for p in ("CoreML", "CUDA", "DML") if p in providers), "CPU")


def apply_model(rows: DataFrame, kind: str, name: str, col: str, result_type: str, **options: Any) -> DataFrame:
    """rows with ``result`` and ``error`` of the model over a column, loaded once per worker, batch by batch."""

    @F.pandas_udf(f"result {result_type}, error string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = create(kind, name, **options)
        for part in parts:
            items = part.tolist()
            try:
                results, errors = model(items), [None] * len(items)
            except Exception:
                results, errors = [], []
                for item in items:
                    try:
                        results += model([item])
                        errors.append(None)
                    except Exception as e:
                        results.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"result": results, "error": errors})

    return rows.withColumn("__m", run(F.col(col))).select(*rows.columns, "__m.result", "__m.error")


def _seeded(item: Any) -> int:
    return int.from_bytes(hashlib.sha256(repr(item).encode()).digest()[:8], "big")


def stub_embedder(dim: int = 768) -> Callable[[list], list]:
    """Unit vectors that depend on the input alone."""
    import numpy as np

    def run(items: list) -> list:
        out = []
        for item in items:
            v = np.random.default_rng(_seeded(item)).standard_normal(dim)
            out.append((v / np.linalg.norm(v)).tolist())
        return out

    return run


def stub_caption(model: str = "stub") -> Callable[[list], list]:
    return lambda items: [f"caption {_seeded(i) % 1000}" for i in items]


register("image_embedder", "stub", stub_embedder)
register("face_embedder", "stub", stub_embedder)
register("caption", "stub", stub_caption)
register("stt", "faster-whisper", adapters.faster_whisper, ("faster_whisper",))
register("stt", "whisper", adapters.whisper, ("whisper", "torch"))
register("stt", "api", adapters.speech_api, ("openai",))
register("diarizer", "pyannote", adapters.pyannote, ("pyannote",))
register("ocr", "paddle", adapters.paddle, ("paddleocr",))
register("face_detector", "haar", adapters.haar, ("cv2",))
register("face_detector", "scrfd", adapters.insight_faces, ("cv2", "insightface"))
register("face_embedder", "insightface", lambda **o: adapters.insight_faces(embeddings=True, **o), ("cv2", "insightface"))
register("object_detector", "owlv2", adapters.owl, ("torch", "transformers", "PIL"))
register("image_embedder", "siglip2", adapters.siglip, ("torch", "transformers", "PIL"))
register("caption", "http", adapters.http_captions)
