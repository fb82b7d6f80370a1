"""Pictures in documents: which are described, by whom, and what text stands for them."""

from __future__ import annotations

import base64
import json
import urllib.request
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from siltmark.embedder import chat_url
from siltmark.functions.text import BLANKS
from siltmark.sources.office import Picture

#: Fixed value: the tokens that a description may have.
MOST_TOKENS = 400


def picture_text(description: str, caption: str = "") -> str:
    """As text.picture_block: empty without a description."""
    description, caption = description.strip(BLANKS), caption.strip(BLANKS)
    return f"[Изображение]\nОписание: {description}" + (f"\nПодпись: {caption}" if caption else "") if description else ""


def answer_text(answer: object) -> str:
    """The content of a chat answer's first choice; empty for any other shape."""
    try:
        content = answer["choices"][0]["message"]["content"]
    except (KeyError, IndexError, TypeError):
        return ""
    return content if isinstance(content, str) else ""


class HttpDescriber:
    """Asks a chat server that takes images for a picture's description."""

    def __init__(self, base_url: str, model: str, prompt: str, timeout: float = 90.0):
        self.url, self.model, self.prompt, self.timeout = chat_url(base_url), model, prompt, timeout

    def __call__(self, data: bytes) -> str:
        kind = "png" if data.startswith(b"\x89PNG") else "gif" if data.startswith(b"GIF8") else "webp" if data[8:12] == b"WEBP" else "jpeg"
        image = {"type": "image_url", "image_url": {"url": f"data:image/{kind};base64,{base64.b64encode(data).decode()}"}}
        body = {"model": self.model, "max_completion_tokens": MOST_TOKENS, "messages": [{"role": "user", "content": [image, {"type": "text", "text": self.prompt}]}]}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as response:
            return answer_text(json.load(response))


@dataclass(frozen=True)
class PictureOptions:
    """What readers do with pictures: nothing without ``describe``; small ones (of known area) are passed over; so many requests of a document run at once."""

    describe: Callable[[bytes], str] | None = None
    area_threshold: float = 0.02
    concurrency: int = 2

    def texts(self, pictures: Sequence[Picture]) -> list[str]:
        """A text for each picture, empty for those without a description; a request that fails gives none."""

        def one(p: Picture) -> str:
            if self.describe is None or (p.area is not None and p.area < self.area_threshold):
                return ""
            try:
                return picture_text(self.describe(p.data), p.caption)
            except Exception:  # noqa: BLE001  the document is worth more than a picture's description
                return ""

        if self.describe is None or not pictures:
            return [""] * len(pictures)
        with ThreadPoolExecutor(max(1, int(self.concurrency))) as pool:
            return list(pool.map(one, pictures))
