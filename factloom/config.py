"""Settings: a frozen dataclass; environment variables of the same names (any case) come before the defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


# The names of the settings and their defaults.
@dataclass(frozen=True)
class Settings:
    llm_api_key: str = ""
    llm_base_url: str = ""
    llm_model: str = ""
    llm_temperature: float = 0.1
    llm_max_tokens: int = 4096
    llm_max_retries: int = 3
    embedding_model: str = "offline-ngram"
    upload_dir: str = "data/upload"
    output_dir: str = "data/output"
    index_dir: str = "data/index"
    db_path: str = "data/facts"
    chunk_size: int = 512
    chunk_overlap: int = 64
    top_k: int = 8
    enable_multi_round: bool = True
    hyde_temperature: float = 0.7
    hyde_max_tokens: int = 256
    log_level: str = "INFO"
    log_dir: str = "data/logs"

    @classmethod
    def load(cls, env: dict[str, str] | None = None) -> Settings:
        env = {k.lower(): v for k, v in (os.environ if env is None else env).items()}
        made = {}
        for f in fields(cls):
            if f.name in env:
                kind = type(f.default)
                made[f.name] = env[f.name].lower() in ("1", "true", "yes") if kind is bool else kind(env[f.name])
        return cls(**made)

    def extractor(self):
        """The language model of llm_base_url, or the offline rules where no key is set."""
        from factloom.operators.extract import RuleExtractor
        from factloom.sources.models import ChatClient

        if not self.llm_api_key:
            return RuleExtractor()
        return ChatClient(self.llm_base_url, self.llm_api_key, self.llm_model, (self.llm_temperature, self.llm_max_tokens), (self.hyde_temperature, self.hyde_max_tokens))

    def embedder(self):
        from factloom.operators.vector import NgramEmbedder
        from factloom.sources.models import SentenceEmbedder

        return NgramEmbedder() if self.embedding_model == "offline-ngram" else SentenceEmbedder(self.embedding_model)
