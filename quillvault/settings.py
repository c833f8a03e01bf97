"""Job parameters with their defaults and the bounds they must respect."""

from __future__ import annotations

from dataclasses import dataclass

from quillvault import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    chunk_size: int = 1000
    chunk_overlap: int = 150
    top_k: int = 4
    sim_threshold: float = 0.35
    injection_threshold: float = 0.5
    seed: int = 42
    embed_dim: int = 768
    embed_model_tag: str = "hash-bow@1"
    source_prefix: str = fv.SOURCE_PREFIX

    def __post_init__(self) -> None:
        if self.embed_dim <= 0:
            raise ValueError("embed_dim must be positive")
        if not 0 < self.chunk_overlap < self.chunk_size:
            raise ValueError("chunk_overlap must lie strictly between 0 and chunk_size")
        if not -1.0 <= self.sim_threshold <= 1.0:
            raise ValueError("sim_threshold is a cosine similarity in [-1, 1]")
        if self.top_k < 1:
            raise ValueError("top_k must be at least 1")
        if not 0.0 <= self.injection_threshold <= 1.0:
            raise ValueError("injection_threshold must lie in [0, 1]")
