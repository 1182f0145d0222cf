"""Settings of a run: defaults, overridden by a YAML or JSON file; unknown keys are errors."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """The defaults of a run."""

    legal_weight: float = 0.40
    enforcement_weight: float = 0.60
    missing_strategy: str = "exclude"
    confidence_weighting: bool = True
    min_criteria_for_ranking: int = 12
    cosine_similarity_threshold: float = 0.35
    max_sections_per_criterion: int = 20
    min_section_chars: int = 100
    min_text_length: int = 200
    min_relevance_score: float = 6.0
    top_urls_per_document: int = 5
    max_results_per_query: int = 10
    cache_ttl_seconds: int = 2_592_000

    def __post_init__(self) -> None:
        if self.missing_strategy not in ("exclude", "penalise_as_1"):
            raise ValueError(f"unknown missing_strategy {self.missing_strategy!r}")


def load(path: str | None = None) -> Config:
    if path is None:
        return Config()
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        given = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs the yaml package; use JSON instead") from e
        given = yaml.safe_load(text)
    flat = {k: v for part in given.values() if isinstance(part, dict) for k, v in part.items()} | {k: v for k, v in given.items() if not isinstance(v, dict)}
    unknown = set(flat) - {f.name for f in fields(Config)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return replace(Config(), **flat)
