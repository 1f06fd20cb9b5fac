"""Factories of real engines for the model registry.

Every factory imports its engine when it is called, once in each Python worker, and gives a function from a list of inputs to a
list of results of plain values. ``models.apply_model`` gives each failing item an empty result and its error. Engines and
their weights are not bundled; ``needs`` in the registration names the modules.
"""

from __future__ import annotations

import base64
import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from typing import Any

from cinelake.streaming.progress import FAILURES, OPEN_SECONDS, retry_plan

Model = Callable[[list], list]


def _segment(start: float, end: float, text: str, confidence: float = 1.0) -> dict[str, Any]:
    return {"start": round(float(start), 3), "end": round(float(end), 3), "text": (text or "").strip(), "confidence": float(confidence)}


def _spoken(segments: list[dict[str, Any]]) -> list[dict[str, Any]]:
    return [s for s in segments if s["text"]]


def faster_whisper(model: str = "base", language: str | None = None, device: str = "auto", compute_type: str = "auto", beam_size: int = 1) -> Model:
    """Audio paths -> segments."""
    import faster_whisper as engine

    loaded = engine.WhisperModel(model, device=device, compute_type=compute_type)

    def one(path: str) -> list[dict[str, Any]]:
        found, _ = loaded.transcribe(path, language=language, beam_size=beam_size)
        return _spoken([_segment(s.start, s.end, s.text, math.exp(min(0.0, getattr(s, "avg_logprob", 0.0)))) for s in found])

    return lambda paths: [one(p) for p in paths]


def whisper(model: str = "base", language: str | None = None, device: str | None = None) -> Model:
    """Audio paths -> segments."""
    import whisper as engine

    loaded = engine.load_model(model, device=device)

    def one(path: str) -> list[dict[str, Any]]:
        found = loaded.transcribe(path, language=language)["segments"]
        return _spoken([_segment(s["start"], s["end"], s["text"], math.exp(min(0.0, s.get("avg_logprob", 0.0)))) for s in found])

    return lambda paths: [one(p) for p in paths]


def speech_api(model: str = "whisper-1", language: str | None = None, api_key: str | None = None) -> Model:
    """Audio paths -> segments, by a hosted service."""
    import openai

    client = openai.OpenAI(api_key=api_key)

    def one(path: str) -> list[dict[str, Any]]:
        with open(path, "rb") as f:
            options = {"language": language} if language else {}
            told = client.audio.transcriptions.create(model=model, file=f, response_format="verbose_json", **options)
        return _spoken([_segment(s.start, s.end, s.text) for s in told.segments or ()])

    return lambda paths: [one(p) for p in paths]


def pyannote(model: str = "pyannote/speaker-diarization-3.1", token: str | None = None) -> Model:
    """Audio paths -> speaker turns. Errors are the item's."""
    from pyannote.audio import Pipeline

    loaded = Pipeline.from_pretrained(model, use_auth_token=token)

    def one(path: str) -> list[dict[str, Any]]:
        return [{"start": t.start, "end": t.end, "speaker_id": who} for t, _, who in loaded(path).itertracks(yield_label=True)]

    return lambda paths: [one(p) for p in paths]


def paddle(lang: str = "korean", use_gpu: bool = False) -> Model:
    """Picture paths -> text blocks (text, confidence, polygon)."""
    from paddleocr import PaddleOCR

    loaded = PaddleOCR(lang=lang, use_gpu=use_gpu, show_log=False)

    def one(path: str) -> list[dict[str, Any]]:
        page = (loaded.ocr(path) or [None])[0] or []
        return [{"text": text, "confidence": float(conf), "polygon": [[float(x), float(y)] for x, y in points]} for points, (text, conf) in page]

    return lambda paths: [one(p) for p in paths]


def haar(scale: float = 1.1, neighbours: int = 5, min_size: int = 40) -> Model:
    """Picture paths -> face boxes; a picture that cannot be read has none."""
    import cv2

    loaded = cv2.CascadeClassifier(cv2.data.haarcascades + "haarcascade_frontalface_default.xml")

    def one(path: str) -> list[dict[str, Any]]:
        image = cv2.imread(path)
        if image is None:
            return []
        found = loaded.detectMultiScale(cv2.cvtColor(image, cv2.COLOR_BGR2GRAY), scale, neighbours, minSize=(min_size, min_size))
        return [{"x": int(x), "y": int(y), "w": int(w), "h": int(h), "det_conf": 1.0} for x, y, w, h in found]

    return lambda paths: [one(p) for p in paths]


def insight_faces(name: str = "buffalo_l", det_size: int = 640, embeddings: bool = False) -> Model:
    """Picture paths -> faces (box, confidence and, if asked, the vector)."""
    import cv2
    from insightface.app import FaceAnalysis

    loaded = FaceAnalysis(name=name)
    loaded.prepare(ctx_id=0, det_size=(det_size, det_size))

    def one(path: str) -> list[dict[str, Any]]:
        image = cv2.imread(path)
        out = []
        for face in loaded.get(image) if image is not None else ():
            x1, y1, x2, y2 = (int(v) for v in face.bbox)
            out.append({"x": x1, "y": y1, "w": x2 - x1, "h": y2 - y1, "det_conf": float(face.det_score)})
            if embeddings:
                out[-1]["embedding"] = [float(v) for v in face.embedding]
        return out

    return lambda paths: [one(p) for p in paths]


def owl(model: str = "google/owlv2-base-patch16-ensemble", queries: tuple[str, ...] = (), threshold: float = 0.35) -> Model:
    """Picture paths -> objects found by the queries: label, confidence, normalised box."""
    import torch
    from PIL import Image
    from transformers import Owlv2ForObjectDetection, Owlv2Processor

    processor, loaded = Owlv2Processor.from_pretrained(model), Owlv2ForObjectDetection.from_pretrained(model).eval()

    def one(path: str) -> list[dict[str, Any]]:
        image = Image.open(path).convert("RGB")
        given = processor(text=[list(queries)], images=image, return_tensors="pt")
        with torch.no_grad():
            told = loaded(**given)
        size = torch.tensor([image.size[::-1]])
        found = processor.post_process_grounded_object_detection(told, threshold=threshold, target_sizes=size)[0]
        sides = (image.size[0], image.size[1]) * 2
        return [
            {"label": queries[int(k)], "confidence": float(s), "bbox_norm": [min(1.0, max(0.0, float(v) / n)) for v, n in zip(box, sides)]}
            for s, k, box in zip(found["scores"], found["labels"], found["boxes"])
        ]

    return lambda paths: [one(p) for p in paths]


def siglip(model: str = "google/siglip2-base-patch16-224", dim: int = 768, batch: int = 16) -> Model:
    """Picture paths -> unit vectors of ``dim``; another dimension is an error."""
    import torch
    from PIL import Image
    from transformers import AutoModel, AutoProcessor

    processor, loaded = AutoProcessor.from_pretrained(model), AutoModel.from_pretrained(model).eval()

    def run(paths: list) -> list:
        out: list[list[float]] = []
        for at in range(0, len(paths), batch):
            given = processor(images=[Image.open(p).convert("RGB") for p in paths[at : at + batch]], return_tensors="pt")
            with torch.no_grad():
                vectors = torch.nn.functional.normalize(loaded.get_image_features(**given), dim=-1)
            if vectors.shape[-1] != dim:
                raise ValueError(f"vectors of {vectors.shape[-1]} dimensions, not {dim}")
            out += vectors.tolist()
        return out

    return run


class HttpCaptions:
    """Captions from a chat server over HTTP, with retries and a circuit breaker in each worker."""

    def __init__(
        self, base_url: str, prompt: str = "", api_key: str | None = None, most_tokens: int = 128, timeout_s: float = 300.0,
        retries: int = 3, backoff_s: float = 2.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep,
    ):
        self.url, self.prompt, self.most_tokens, self.timeout_s = base_url.rstrip("/") + "/v1/chat/completions", prompt, most_tokens, timeout_s
        self.headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {api_key}"} if api_key else {})
        self.retries, self.backoff_s, self.clock, self.sleep = retries, backoff_s, clock, sleep
        self.failed, self.open_until = 0, -math.inf

    def _once(self, body: bytes) -> tuple[int | None, str | None]:
        """(status or null for a lost connection, text)."""
        try:
            request = urllib.request.Request(self.url, data=body, headers=self.headers, method="POST")
            with urllib.request.urlopen(request, timeout=self.timeout_s) as answer:
                told = json.loads(answer.read().decode("utf-8"))
                return answer.status, str(((told.get("choices") or [{}])[0].get("message") or {}).get("content") or "")
        except urllib.error.HTTPError as e:
            return e.code, None
        except (urllib.error.URLError, TimeoutError):
            return None, None

    def caption(self, picture: bytes) -> str | None:
        """The raw text of an answer; null after a failure, or while the breaker is open."""
        if self.clock() < self.open_until:
            return None
        image = "data:image/jpeg;base64," + base64.b64encode(picture).decode()
        content = [{"type": "text", "text": self.prompt}, {"type": "image_url", "image_url": {"url": image}}]
        body = json.dumps({"messages": [{"role": "user", "content": content}], "max_tokens": self.most_tokens}).encode()
        statuses: list[int | None] = []
        while True:
            status, text = self._once(body)
            if text is not None:
                self.failed, self.open_until = 0, -math.inf
                return text
            statuses.append(status)
            waits = retry_plan(statuses, self.retries, self.backoff_s)
            if len(waits) < len(statuses):
                break
            self.sleep(waits[-1])
        self.failed += 1
        if self.failed >= FAILURES:
            self.open_until = self.clock() + OPEN_SECONDS
        return None


def http_captions(**options: Any) -> Model:
    """Pictures (bytes) -> captions."""
    server = HttpCaptions(**options)
    return lambda pictures: [server.caption(bytes(p)) for p in pictures]
