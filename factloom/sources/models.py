"""Models behind the protocols Extractor and Embedder: a chat service over HTTP, and local sentence vectors.

Instances hold settings alone and travel to the workers; what is heavy is made there at first use, once a process.
"""

from __future__ import annotations

import json
import sys
import urllib.request
from dataclasses import dataclass

import numpy as np


def once(key, make):
    """make() at the first use of `key` in this process; later uses get the same object."""
    kept = sys.modules.setdefault("_factloom_models", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


@dataclass(frozen=True)
class ChatClient:
    """A chat-completions service; (temperature, max_tokens) of JSON replies and of free texts."""

    base_url: str
    api_key: str
    model: str
    for_json: tuple[float, int] = (0.1, 4096)
    for_text: tuple[float, int] = (0.7, 256)
    timeout: float = 120.0

    def _chat(self, system: str, user: str, how: tuple[float, int], **more) -> str:
        body = {"model": self.model, "temperature": how[0], "max_tokens": how[1], "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], **more}
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"}
        request = urllib.request.Request(f"{self.base_url.rstrip('/')}/chat/completions", json.dumps(body).encode(), head)
        with once("opener", urllib.request.build_opener).open(request, timeout=self.timeout) as reply:
            return json.load(reply)["choices"][0]["message"]["content"] or ""

    def complete_json(self, system: str, user: str) -> str:
        return self._chat(system, user, self.for_json, response_format={"type": "json_object"})

    def complete_text(self, system: str, user: str) -> str:
        return self._chat(system, user, self.for_text)


@dataclass(frozen=True)
class SentenceEmbedder:
    """Vectors of sentence_transformers, where that is installed; the model is loaded at first use in a worker."""

    model: str
    batch: int = 32

    def embed(self, texts: list[str]) -> np.ndarray:
        def load():
            from sentence_transformers import SentenceTransformer

            return SentenceTransformer(self.model)

        made = once(("sentences", self.model), load)
        return np.asarray(made.encode(texts, batch_size=self.batch, normalize_embeddings=True), np.float32)
