"""A client of an embedding server that speaks JSON over HTTP; it runs on the executors, a connection per call."""

from __future__ import annotations

import json
import urllib.request


class EmbeddingError(RuntimeError):
    pass


def vectors_of(answer: object, expected: int) -> list[list[float]] | None:
    """The vectors in an answer; for one text also the older form, or the first of more than were asked for."""

    def vector(v: object) -> list[float] | None:
        if isinstance(v, list) and len(v) == 1 and isinstance(v[0], list):
            v = v[0]
        ok = isinstance(v, list) and v and all(isinstance(x, int | float) and not isinstance(x, bool) for x in v)
        return [float(x) for x in v] if ok else None

    if not isinstance(answer, dict):
        return None
    many = answer.get("embeddings")
    if isinstance(many, list) and len(many) == expected:
        found = [vector(v) for v in many]
        return found if all(found) else None
    if expected != 1:
        return None
    one = vector(answer.get("embedding")) or (vector(many[0]) if isinstance(many, list) and many else None)
    return [one] if one else None


class HttpEmbedder:
    def __init__(self, base_url: str = "http://127.0.0.1:11434", model: str = "nomic-embed-text", timeout: float = 120.0, context: int = 2048):
        self.url, self.model, self.timeout, self.context = base_url.rstrip("/") + "/api/embed", model, timeout, context

    def __call__(self, texts: list[str]) -> list[list[float]]:
        stripped = [t.strip() for t in texts]
        if not stripped:
            return []
        if not all(stripped):
            raise ValueError("an empty text can't be embedded")
        body = {"model": self.model, "input": stripped, "keep_alive": -1, "options": {"num_ctx": self.context}}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as response:
            found = vectors_of(json.load(response), len(stripped))
        if found is None:
            raise EmbeddingError("the server's answer holds no vectors")
        return found

    def one(self, text: str) -> list[float]:
        return self([text])[0]


def chat_url(base_url: str) -> str:
    return base_url.rstrip("/") + "/v1/chat/completions"
